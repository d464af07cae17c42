"""Where quotes come from."""
