"""Entry points for ``spark-submit``: stream, batch, report."""
