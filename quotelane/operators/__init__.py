"""DataFrame-to-DataFrame reports."""
