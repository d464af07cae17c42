"""The reports over a stream of quotes."""
