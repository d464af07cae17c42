"""Names derived from a route."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def route_label() -> Column:
    """``ORIG-DEST``."""
    return F.concat_ws("-", "origin", "destination")


def route_topic() -> Column:
    """The topic that carries a route's quotes, e.g. ``jfk_lax_prices``."""
    return F.concat(F.lower("origin"), F.lit("_"), F.lower("destination"), F.lit("_prices"))
