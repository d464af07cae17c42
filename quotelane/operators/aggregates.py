"""Grouped statistics.

Everything here is built from *cells*: one row per group with a minimum, a maximum,
sums and two counts. Cells can be merged further, so a report over few groups can be
computed from the cells of many groups without reading the quotes again.

Spark aggregates before it shuffles, so a group that holds a large share of all
quotes costs one row per task in the shuffle.

Prices are summed exactly. Each is cut into whole numbers of ``BITS`` bits: its cents into
five limbs, and what is left of a cent into three finer ones. Sums of doubles depend on the
order in which tasks finish; sums of whole numbers do not. So averages, and with them ranks
and ties, are the same in every run, in a stream and in a batch.

No sum can overflow: a quote adds at most 2^20 to a limb, so 8e12 quotes of one group fit, and
whenever cells are added up, carries move what a limb holds beyond its bits to the next one.
What the last limbs hold beyond ``TOP_BITS`` more bits (sums from 2e37 on) goes to a sum of
doubles, as do prices from 1e28 on and those that are not finite. That sum never fails either;
only its last digits may depend on the order. Fractions below 2^-67 are dropped, the same for
every order.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelane.functions.measures import ratio
from quotelane.functions.windows import pane
from quotelane.operators.ordering import numbered
from quotelane.schema import CARRIER, ROUTE

BOUNDS = ["window_start", "window_end"]
LIMBS = ["sum_cents", "sum_cents_20", "sum_cents_40", "sum_cents_60", "sum_cents_80"]
FINE = ["sum_finest", "sum_finer", "sum_fine"]
BITS, TOP_BITS = 20, 40
FINEST, REST = 2.0**-67, 2.0**64
_MASK, _HALF = (1 << BITS) - 1, 2.0 ** (3 * BITS)
SUMS = [*LIMBS, *FINE, "sum_rest", "priced_count", "flight_count"]
MEASURES = ["min_price", "max_price", *SUMS]


def window_bounds(df: DataFrame) -> list[str]:
    """The window columns ``df`` has: both or none."""
    return [name for name in BOUNDS if name in df.columns]


def fare_cells(
    quotes: DataFrame,
    keys: list[str] = ROUTE + CARRIER,
    window: str | None = None,
    slide: str | None = None,
) -> DataFrame:
    """Cells per ``keys``, and per event-time window where one is given.

    Overlapping windows are built in two steps: each quote is counted once in a short
    tumbling pane, then the panes are copied into the windows they belong to. The direct
    way would copy every quote (window / slide) times. (In a stream the two steps need
    append mode; the caller asks for panes in other modes.)
    """
    panes = pane(window, slide) if window else None
    if panes and not quotes.isStreaming:
        return merge_cells(fare_cells(quotes, keys, panes), keys, window, slide)
    return _flatten(window_cells(quotes, keys, window, slide), keys)


def window_cells(
    quotes: DataFrame, keys: list[str], window: str | None = None, slide: str | None = None
) -> DataFrame:
    """Cells with their ``window`` as one column, which keeps its event time in a stream."""
    panes = pane(window, slide) if window else None
    if panes and quotes.isStreaming:
        # Panes keep their event time, so that their watermark closes the windows.
        tiles = _count_quotes(quotes, [*keys, F.window("timestamp", panes).alias("pane")])
        windows = F.window(F.window_time("pane"), window, slide).alias("window")
        return _add_cells(tiles, [*keys, windows])
    groups: list = list(keys)
    if window:
        groups.append(F.window("timestamp", window, slide).alias("window"))
    return _count_quotes(quotes, groups)


def _count_quotes(quotes: DataFrame, groups: list) -> DataFrame:
    # Step by step, so that no expression is evaluated twice for a quote.
    price, cents, high, low, left = (F.col(f"_{name}") for name in ("price", "cents", "high", "low", "left"))
    fits = F.abs(price) < 2.0 ** (5 * BITS) / 100  # false for infinities and NaN
    # A price in cents has no more digits, nor has one whose digits all lie before the point.
    whole = (cents / 100.0 == price) | ~fits | (F.abs(cents) >= 2.0**53)
    large = F.abs(cents) >= _HALF
    cut = (
        quotes.withColumn("_price", F.col("price_usd").cast("double"))
        .withColumn("_cents", F.rint(F.when(fits, price * 100).otherwise(0.0)))
        .withColumns({
            "_high": F.when(large, F.floor(cents / _HALF)).otherwise(F.lit(0).cast("bigint")),
            "_left": F.when(whole, 0.0).otherwise(price - cents / 100.0),
        })
        .withColumn("_low", F.when(large, cents - high.cast("double") * _HALF).otherwise(cents).cast("bigint"))
    )
    parts = [
        low.bitwiseAND(_MASK), F.shiftright(low, BITS).bitwiseAND(_MASK), F.shiftright(low, 2 * BITS),
        high.bitwiseAND(_MASK), F.shiftright(high, BITS),
    ]
    fine = F.rint(left * 2.0**27)
    finer = F.rint(left * 2.0**47 - fine * 2.0**20)
    finest = F.rint(left * 2.0**67 - fine * 2.0**40 - finer * 2.0**20)
    parts += [part.cast("bigint") for part in (finest, finer, fine)]
    return cut.groupBy(*groups).agg(
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        *[F.sum(part).alias(name) for name, part in zip([*LIMBS, *FINE], parts)],
        # In a large unit, so that no sum of finite prices becomes infinite.
        F.sum(F.when(fits, 0.0).otherwise(price / REST)).alias("sum_rest"),
        F.count(price).alias("priced_count"),
        F.count("*").alias("flight_count"),
    )


def _carried(limbs: list[str]) -> tuple[list[Column], Column]:
    """The same sum with every limb but the last within its bits, and what the last one
    holds beyond its own."""
    carried, carry = [], F.lit(0).cast("bigint")
    for name in limbs[:-1]:
        total = F.col(name) + carry
        carried.append(total.bitwiseAND(_MASK))
        carry = F.shiftright(total, BITS)
    last, bits = F.col(limbs[-1]), BITS + TOP_BITS
    outside = (last >= 1 << bits) | (last < -(1 << bits))
    beyond = F.when(outside, F.shiftright(last, bits)).otherwise(F.lit(0).cast("bigint"))
    return [*carried, last - F.shiftleft(beyond, bits) + carry], beyond


def merge_cells(
    cells: DataFrame,
    keys: list[str],
    window: str | None = None,
    slide: str | None = None,
) -> DataFrame:
    """Coarser cells: fewer ``keys``, and longer windows where one is given."""
    groups: list = list(keys)
    if window:
        groups.append(F.window("window_start", window, slide).alias("window"))
    else:
        groups.extend(window_bounds(cells))
    return _flatten(_add_cells(cells, groups), keys)


def _add_cells(cells: DataFrame, groups: list) -> DataFrame:
    cents, huge = _carried(LIMBS)
    fine, many = _carried(FINE)
    rest = (
        F.col("sum_rest") + huge.cast("double") * (2.0 ** (TOP_BITS + 5 * BITS) / REST / 100)
        + many.cast("double") * (2.0 ** (TOP_BITS + 3 * BITS) / REST * FINEST)
    )
    within = dict(zip([*LIMBS, *FINE, "sum_rest"], [*cents, *fine, rest]))
    return cells.withColumns(within).groupBy(*groups).agg(
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        *[F.sum(name).alias(name) for name in SUMS],
    )


def average_price() -> Column:
    """Mean of the known prices of a cell, NULL if there are none.

    All cents are put together as one decimal and divided once, so equal means are equal
    doubles, however the cells were merged.
    """
    priced = F.col("priced_count")
    total = F.lit(0).cast("decimal(38,0)")
    for k, name in enumerate(LIMBS[:-1]):
        total = total + F.col(name).cast("decimal(20,0)") * _power(k)
    last = F.col(LIMBS[-1])
    fits = (last < 1 << 44) & (last > -(1 << 44))  # else the sum has no 38 digits
    exact = (total + last.cast("decimal(20,0)") * _power(4)).cast("double")
    cents = F.when(fits, exact).otherwise(total.cast("double") + last * 2.0 ** (4 * BITS))
    (finest, finer, fine), many = _carried(FINE)
    left = (fine * 2.0**40 + (finer * 2.0**20 + finest) + many * 2.0 ** (TOP_BITS + 3 * BITS)) * FINEST
    mean = ratio(cents + left * 100, 100.0 * priced) + ratio(F.col("sum_rest"), priced) * REST
    return mean.alias("avg_price")


def _power(k: int) -> Column:
    unit = 1 << (k * BITS)
    return F.lit(str(unit)).cast(f"decimal({len(str(unit))},0)")


def stats_from_cells(cells: DataFrame) -> DataFrame:
    return cells.select(
        *ROUTE, *window_bounds(cells), "min_price", "max_price", average_price(), "flight_count"
    )


def averages_from_cells(cells: DataFrame) -> DataFrame:
    return cells.select(
        *ROUTE, *window_bounds(cells), *CARRIER, average_price(), "flight_count"
    )


def trend_from_cells(cells: DataFrame) -> DataFrame:
    return cells.select(*ROUTE, *window_bounds(cells), average_price())


def route_stats(
    quotes: DataFrame, window: str | None = None, slide: str | None = None
) -> DataFrame:
    """Lowest, highest and average price and number of quotes per route."""
    return stats_from_cells(fare_cells(quotes, ROUTE, window, slide))


def airline_averages(
    quotes: DataFrame, window: str | None = None, slide: str | None = None
) -> DataFrame:
    """Average price and number of quotes per route and airline."""
    return averages_from_cells(fare_cells(quotes, ROUTE + CARRIER, window, slide))


def price_trend(quotes: DataFrame, window: str, slide: str | None = None) -> DataFrame:
    """Average price per route and window."""
    return trend_from_cells(fare_cells(quotes, ROUTE, window, slide))


def price_trend_daily(quotes: DataFrame, row_numbers: bool = False) -> DataFrame:
    """Average price per route and calendar date, in order; with ``row_numbers`` the order
    is a column too, and the report is written when this is called."""
    dated = quotes.withColumn("date", F.to_date("timestamp"))
    cells = fare_cells(dated, ROUTE + ["date"])
    trend = cells.select(*ROUTE, "date", average_price())
    order = [F.asc(name) for name in (*ROUTE, "date")]
    return numbered(trend, order) if row_numbers else trend.orderBy(*order)


def _flatten(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Replace a ``window`` struct, if there is one, with its two ends."""
    if "window" not in cells.columns:
        return cells.select(*keys, *window_bounds(cells), *MEASURES)
    ends = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    return cells.select(*keys, *ends, *MEASURES)
