"""The registered queries in SQL, for tables of the same names."""

EVENTS = """q AS (
  SELECT event_type AS origin, concat('G', CAST(user_id % 3 AS VARCHAR)) AS destination,
         concat('C', CAST(user_id % 7 AS VARCHAR)) AS airline,
         concat('Carrier ', CAST(user_id % 7 AS VARCHAR)) AS airline_name,
         value AS price_usd, ts AS "timestamp"
  FROM events)"""

# Unknown and extreme values, by the rule of the mapping.
HARSH = """q AS (
  SELECT CASE WHEN second <> 5 THEN origin END AS origin, destination, airline, airline_name,
         CASE WHEN second = 0 OR (airline = 'C3' AND destination = 'G1') THEN NULL
              WHEN airline = 'C0' THEN price_usd * 1e7
              WHEN airline = 'C1' THEN price_usd / 1000 ELSE price_usd END AS price_usd, "timestamp"
  FROM (SELECT event_type AS origin, concat('G', CAST(user_id % 3 AS VARCHAR)) AS destination,
               concat('C', CAST(user_id % 7 AS VARCHAR)) AS airline,
               concat('Carrier ', CAST(user_id % 7 AS VARCHAR)) AS airline_name,
               value AS price_usd, ts AS "timestamp", CAST(floor(epoch(ts)) AS BIGINT) % 11 AS second
        FROM events))"""

# Prices of any size.
VAST = """q AS (
  SELECT origin, destination, airline, airline_name,
         CASE WHEN airline = 'C2' AND second = 0 THEN 1e300
              WHEN airline = 'C0' THEN price_usd * 1e22
              WHEN airline = 'C4' THEN price_usd * 1e12 ELSE price_usd END AS price_usd, "timestamp"
  FROM (SELECT event_type AS origin, concat('G', CAST(user_id % 3 AS VARCHAR)) AS destination,
               concat('C', CAST(user_id % 7 AS VARCHAR)) AS airline,
               concat('Carrier ', CAST(user_id % 7 AS VARCHAR)) AS airline_name,
               value AS price_usd, ts AS "timestamp", CAST(floor(epoch(ts)) AS BIGINT) % 11 AS second
        FROM events))"""

STAR = """q AS (
  SELECT sr.r_name AS origin, cr.r_name AS destination,
         concat('S', CAST(s_suppkey AS VARCHAR)) AS airline, s_name AS airline_name,
         l_extendedprice AS price_usd, l_shipdate AS "timestamp"
  FROM lineitem
  JOIN orders   ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation sn ON sn.n_nationkey = s_nationkey
  JOIN nation cn ON cn.n_nationkey = c_nationkey
  JOIN region sr ON sr.r_regionkey = sn.n_regionkey
  JOIN region cr ON cr.r_regionkey = cn.n_regionkey)"""

METRICS = """m AS (
  SELECT event_type AS query_type, CAST(60 + user_id % 50 AS DOUBLE) AS streaming_execution_time,
         value AS batch_execution_time, user_id AS streaming_result_count,
         user_id % 25 AS batch_result_count, value AS streaming_avg_price,
         value + 1 AS batch_avg_price, value / 8 AS price_diff_percentage,
         ts AS comparison_timestamp
  FROM events)"""

# A source's quotes, the window and the slide: (CTE, window, slide, copies).
E_TUMBLING = (EVENTS, "30 minutes", "30 minutes", 1)
E_SLIDING = (EVENTS, "30 minutes", "10 minutes", 3)
T_TUMBLING = (STAR, "30 days", "30 days", 1)
T_SLIDING = (STAR, "30 days", "10 days", 3)

BOUNDS = "window_start, window_end"

# Prices are money: the average of exact cents, not of binary fractions.
MEAN = "avg(CAST(price_usd AS DECIMAL(18,2)))"


# Of prices with fractions of a cent.
FINE_MEAN = "avg(CAST(price_usd AS DECIMAL(30,10)))"


def harshly(sql: str) -> str:
    """With fine averages, rounded as far as averages of billions are exact."""
    return sql.replace(MEAN, FINE_MEAN).replace(", 6) AS avg_price", ", 3) AS avg_price")


def windowed(source) -> str:
    """CTE ``w``: the quotes, once per window that holds them."""
    quotes, window, slide, copies = source
    first = f"time_bucket(INTERVAL '{slide}', \"timestamp\", TIMESTAMP '1970-01-01')"
    return f"""{quotes}, w AS (
  SELECT q.*, {first} - k * INTERVAL '{slide}' AS window_start,
         {first} - k * INTERVAL '{slide}' + INTERVAL '{window}' AS window_end
  FROM q, range({copies}) r(k))"""


def stats(source, where: str = "") -> str:
    if isinstance(source, str):
        cte, table, keys = source, "q", "origin, destination"
    else:
        cte, table, keys = windowed(source), "w", f"origin, destination, {BOUNDS}"
    return f"""WITH {cte}
SELECT {keys}, min(price_usd) AS min_price, max(price_usd) AS max_price,
       round({MEAN}, 6) AS avg_price, count(*) AS flight_count
FROM {table} {where} GROUP BY {keys}"""


def trend(source, where: str = "") -> str:
    return f"SELECT origin, destination, {BOUNDS}, avg_price FROM ({stats(source, where)})"


def averages(source) -> tuple[str, str]:
    """CTEs up to ``a``, the airline averages, and the columns of a group."""
    if isinstance(source, str):
        cte, table, group = source, "q", "origin, destination"
    else:
        cte, table, group = windowed(source), "w", f"origin, destination, {BOUNDS}"
    keys = f"{group}, airline, airline_name"
    return (
        f"""WITH {cte}, a AS (
  SELECT {keys}, {MEAN} AS ap, count(*) AS flight_count FROM {table} GROUP BY {keys})""",
        group,
    )


def ranks(source, columns: str = "", where: str = "") -> str:
    """Airline averages with their rank, reduced to ``where``."""
    ctes, group = averages(source)
    columns = columns or f"{group}, airline, airline_name, avg_price, flight_count, price_rank"
    return f"""{ctes}, ranked AS (
  SELECT {group}, airline, airline_name, round(ap, 6) AS avg_price, flight_count,
         CAST(rank() OVER (PARTITION BY {group} ORDER BY ap) AS INTEGER) AS price_rank
  FROM a WHERE ap IS NOT NULL)
SELECT {columns} FROM ranked {where}"""


def averages_only(source) -> str:
    _, group = averages(source)
    return ranks(source, f"{group}, airline, airline_name, avg_price, flight_count")


def best(source, where: str = "") -> str:
    _, group = averages(source)
    columns = f"{group}, airline, airline_name, avg_price, flight_count"
    return ranks(source, columns, f"WHERE price_rank = 1 {where}")


def best_ranked(source, where: str = "") -> str:
    return ranks(source, where=f"WHERE price_rank = 1 {where}")


def daily(source: str) -> str:
    return f"""WITH {source}
SELECT origin, destination, CAST("timestamp" AS DATE) AS date, round({MEAN}, 6) AS avg_price
FROM q GROUP BY ALL"""


def listing(source) -> str:
    return f"SELECT origin, destination, window_start, avg_price FROM ({trend(source)})"


def series(source) -> str:
    return f"""SELECT origin, destination, origin || '-' || destination AS route, window_start, avg_price
FROM ({trend(source)})"""


def compared(unwindowed: str, windows: str, query_type: str, as_of: str, within: str) -> str:
    """Both sides from subqueries with an unrounded average ``p``."""
    return f"""WITH s AS (
  SELECT avg(p) AS sp, count(*) AS sn FROM ({windows})
  WHERE window_end > TIMESTAMP '{as_of}' - INTERVAL '{within}'),
b AS (SELECT avg(p) AS bp, count(*) AS bn FROM ({unwindowed}))
SELECT '{query_type}' AS query_type, CAST(1800 AS DOUBLE) AS streaming_execution_time,
       CAST(12.5 AS DOUBLE) AS batch_execution_time, sn AS streaming_result_count,
       bn AS batch_result_count, round(sp, 6) AS streaming_avg_price, round(bp, 6) AS batch_avg_price,
       round(CASE WHEN sp > 0 THEN 100 * abs(sp - bp) / sp ELSE 0 END, 6) AS price_diff_percentage
FROM s, b"""


def compared_stats(source, query_type: str, as_of: str, within: str) -> str:
    unwindowed = f"WITH {source[0]} SELECT {MEAN} AS p FROM q GROUP BY origin, destination"
    windows = f"""WITH {windowed(source)}
  SELECT {BOUNDS}, {MEAN} AS p FROM w GROUP BY origin, destination, {BOUNDS}"""
    return compared(unwindowed, windows, query_type, as_of, within)


def compared_best(source, query_type: str, as_of: str, within: str) -> str:
    def sides(of, columns: str) -> str:
        ctes, group = averages(of)
        return f"""{ctes} SELECT {columns} ap AS p FROM a
  QUALIFY rank() OVER (PARTITION BY {group} ORDER BY ap) = 1"""

    return compared(sides(source[0], ""), sides(source, f"{BOUNDS},"), query_type, as_of, within)


def untimed(comparison: str) -> str:
    columns = "batch_execution_time, streaming_execution_time"
    return f"SELECT * EXCLUDE ({columns}), TRUE AS timed FROM ({comparison})"


LATEST_METRICS = f"""WITH {METRICS}
SELECT query_type, streaming_execution_time, batch_execution_time, streaming_result_count,
       batch_result_count, round(streaming_avg_price, 6) AS streaming_avg_price,
       round(batch_avg_price, 6) AS batch_avg_price,
       round(price_diff_percentage, 6) AS price_diff_percentage, comparison_timestamp
FROM m ORDER BY comparison_timestamp DESC LIMIT 10"""


def summary(source: str) -> str:
    return f"""WITH {METRICS}
SELECT query_type, round(avg(streaming_execution_time), 6) AS streaming,
       round(avg(batch_execution_time), 6) AS batch,
       round(avg(batch_execution_time) / avg(streaming_execution_time), 6) AS speedup,
       round(avg(price_diff_percentage), 6) AS price_diff
FROM {source} GROUP BY query_type"""


def numbered(report: str, *order: str, unknown: str = "LAST") -> str:
    places = ", ".join(f"{name} NULLS {unknown}" for name in order)
    return f"SELECT *, row_number() OVER (ORDER BY {places}) AS row_number FROM ({report})"


def vast(keys: str, columns: str = "") -> str:
    return f"""WITH {VAST}
SELECT {keys}{columns}, printf('%.8e', avg(price_usd)) AS avg_price, count(*) AS flight_count
FROM q GROUP BY {keys}"""


VAST_STATS = vast("origin, destination", ", min(price_usd) AS min_price, max(price_usd) AS max_price")
IN_TIME = ("origin", "destination", "window_start")

TOPIC = "lower(origin) || '_' || lower(destination) || '_prices' AS topic"
ROUTE_ID = "origin || '-' || destination AS route_id"
# Windows that a watermark of one hour closes.
CLOSED = "window_end <= (SELECT max(ts) - INTERVAL '1 hour' FROM events)"

ORACLE: dict[str, str] = {
    "route_stats": stats(EVENTS),
    "route_stats_windowed": stats(E_TUMBLING),
    "route_stats_sliding": stats(E_SLIDING),
    "airline_averages": averages_only(EVENTS),
    "airline_averages_windowed": averages_only(E_TUMBLING),
    "price_rank": ranks(EVENTS),
    "price_rank_windowed": ranks(E_TUMBLING),
    "price_rank_in_slices": ranks(E_TUMBLING),
    "best_airline": best(EVENTS),
    "best_airline_windowed": best(E_TUMBLING),
    "best_airline_sliding": best(E_SLIDING),
    "best_airline_semi": best(EVENTS),
    "best_airline_semi_windowed": best(E_TUMBLING),
    "price_trend_windowed": trend(E_TUMBLING),
    "price_trend_sliding": trend(E_SLIDING),
    "price_trend_daily": daily(EVENTS),
    "registered_view": f"""WITH {EVENTS}
SELECT origin, destination, airline, max(price_usd) AS max_price, count(*) AS flight_count
FROM q GROUP BY origin, destination, airline""",
    "registered_view_tuples": f"""WITH {EVENTS}, a AS (
  SELECT origin, destination, airline, round({MEAN}, 6) AS avg_price, count(*) AS flight_count
  FROM q GROUP BY ALL)
SELECT * FROM a QUALIFY avg_price = min(avg_price) OVER (PARTITION BY origin, destination)""",
    "harsh_route_stats": harshly(stats(HARSH)),
    "harsh_route_stats_sliding": harshly(stats((HARSH, "30 minutes", "10 minutes", 3))),
    "harsh_airline_averages": f"""WITH {HARSH}
SELECT origin, destination, airline, airline_name, round({FINE_MEAN}, 3) AS avg_price,
       count(*) AS flight_count FROM q GROUP BY ALL""",
    "harsh_price_rank": harshly(ranks(HARSH, where="WHERE origin IS NOT NULL")),
    "harsh_archive": harshly(stats(HARSH)),
    "vast_route_stats": VAST_STATS,
    "vast_airline_averages": vast("origin, destination, airline, airline_name"),
    "vast_merged_cells": VAST_STATS,
    "price_trend_daily_numbered": numbered(daily(EVENTS), "origin", "destination", "date", unknown="FIRST"),
    "trend_listing_numbered": numbered(listing(E_TUMBLING), *IN_TIME),
    "trend_series_numbered": numbered(series(E_TUMBLING), *IN_TIME),
    "trend_series_text_stamps": numbered(series(E_TUMBLING), *IN_TIME),
    "best_airline_listing_numbered": numbered(
        ranks(
            E_TUMBLING,
            "origin, destination, airline, airline_name, avg_price, window_start",
            "WHERE price_rank = 1",
        ),
        *IN_TIME, "airline", "airline_name",
    ),
    "trend_listing": listing(E_TUMBLING),
    "trend_series": series(E_TUMBLING),
    "best_airline_listing": ranks(
        E_TUMBLING,
        "origin, destination, airline, airline_name, avg_price, window_start",
        "WHERE price_rank = 1",
    ),
    "latest_best": f"""SELECT origin, destination, airline, arg_max(airline_name, window_start) AS airline_name,
       arg_max(avg_price, window_start) AS avg_price, max(window_start) AS window_start,
       origin || '-' || destination AS route
FROM ({best_ranked(E_TUMBLING)}) GROUP BY origin, destination, airline""",
    "compare_route_stats": compared_stats(E_TUMBLING, "route_stats", "2024-01-31", "15 days"),
    "compare_best_airline": compared_best(E_TUMBLING, "best_airlines", "2024-01-31", "15 days"),
    "latest_metrics": LATEST_METRICS,
    "comparison_summary": summary("m"),
    "comparison_summary_latest": summary("(SELECT * FROM m ORDER BY comparison_timestamp DESC LIMIT 10)"),
    "publish_messages": f"""WITH {EVENTS}
SELECT airline AS key, {TOPIC}, price_usd, strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
       {ROUTE_ID}, round(epoch_us("timestamp") / 1e6, 3) AS producer_timestamp FROM q""",
    "codec_round_trip": f"""WITH {EVENTS}
SELECT origin, destination, airline, airline_name, price_usd, "timestamp", {ROUTE_ID}, {TOPIC},
       "timestamp" + INTERVAL '1 second' AS kafka_timestamp FROM q""",
    "decode_damaged": f"""WITH {EVENTS}
SELECT CASE WHEN airline NOT IN ('C0', 'C1', 'C4') THEN origin END AS origin,
       CASE WHEN airline NOT IN ('C0', 'C1') THEN destination END AS destination,
       CASE WHEN airline NOT IN ('C0', 'C1') THEN airline END AS airline,
       CASE WHEN airline NOT IN ('C0', 'C1') THEN airline_name END AS airline_name,
       CASE WHEN airline NOT IN ('C0', 'C1', 'C2') THEN price_usd END AS price_usd,
       CASE WHEN airline NOT IN ('C0', 'C1', 'C3') THEN "timestamp" END AS "timestamp",
       {TOPIC} FROM q""",
    "raw_archive": f"""WITH {EVENTS}
SELECT origin, destination, airline, airline_name, price_usd,
       "timestamp", {ROUTE_ID}, {TOPIC}, CAST("timestamp" AS DATE) AS date FROM q""",
    "batch_stored": f"""WITH {EVENTS}
SELECT origin, destination, min(price_usd) AS min_price,
       max(price_usd) AS max_price, count(*) AS flight_count,
       TRUE AS timed, TRUE AS stamped FROM q GROUP BY origin, destination""",
    "stream_route_stats": stats(E_TUMBLING),
    "stream_best_airline": best_ranked(E_TUMBLING),
    "stream_price_trend": trend(E_TUMBLING),
    "stream_route_stats_sliding": stats(E_SLIDING),
    "stream_route_stats_append": stats(E_TUMBLING, f"WHERE {CLOSED}"),
    "stream_best_airline_append": best_ranked(E_TUMBLING, f"AND {CLOSED}"),
    "stream_price_trend_append": trend(E_TUMBLING, f"WHERE {CLOSED}"),
    "stream_best_airline_sliding_append": best_ranked(E_SLIDING, f"AND {CLOSED}"),
    "stream_raw_archive": f"""WITH {EVENTS}
SELECT origin, destination, airline, airline_name, price_usd,
       "timestamp", {TOPIC}, "timestamp" + INTERVAL '1 second' AS kafka_timestamp FROM q""",
    "stream_cells_route_stats": stats(E_TUMBLING),
    "stream_cells_best_airline": best_ranked(E_TUMBLING),
    # All windows are stored within the hour.
    "stream_batch_comparison": " UNION ALL ".join(
        untimed(compare(E_TUMBLING, query_type, "2000-01-01", "1 hour"))
        for compare, query_type in ((compared_stats, "route_stats"), (compared_best, "best_airlines"))
    ),
    "batch_without_stream": f"""WITH {EVENTS}
SELECT query_type, CAST(0 AS BIGINT) AS streaming_result_count, n AS batch_result_count,
       CAST(NULL AS DOUBLE) AS streaming_avg_price, CAST(0 AS DOUBLE) AS price_diff_percentage
FROM (SELECT 'route_stats' AS query_type, count(*) AS n FROM (SELECT DISTINCT origin, destination FROM q)
      UNION ALL SELECT 'best_airlines', count(*) FROM ({best(EVENTS)}))""",
    "stream_best_airline_plain": best(E_TUMBLING, f"AND {CLOSED}"),
    "stream_best_airline_plain_sliding": best(E_SLIDING, f"AND {CLOSED}"),
    "stream_unreadable_payloads": f"""WITH {EVENTS}
SELECT CASE WHEN airline = 'C0' THEN 'unreadable payload' ELSE 'unreadable field' END AS reason, {TOPIC},
       "timestamp" + INTERVAL '1 second' AS kafka_timestamp,
       CASE WHEN airline = 'C0' THEN 'not json' END AS no_json,
       CASE WHEN airline <> 'C0' THEN airline_name END AS airline_name,
       CASE WHEN airline = 'C2' THEN price_usd END AS price_was,
       CASE WHEN airline <> 'C0' THEN CASE WHEN airline = 'C3' THEN '?' ELSE '' END
            || strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') END AS stamp
FROM q WHERE airline IN ('C0', 'C2', 'C3')""",
    "stream_new_checkpoint": stats(E_TUMBLING),
    "stream_all_archive": f"WITH {EVENTS} SELECT * FROM q",
    "stream_all_route_stats": stats(E_TUMBLING),
    "stream_all_route_stats_sliding": stats(E_SLIDING),
    "stream_all_best_airline": best_ranked(E_TUMBLING),
    "archive_in_many_batches": stats(EVENTS),
    "star_route_stats": stats(STAR),
    "star_route_stats_windowed": stats(T_TUMBLING),
    "star_route_stats_sliding": stats(T_SLIDING),
    "star_airline_averages": averages_only(STAR),
    "star_price_rank": ranks(STAR),
    "star_price_rank_in_slices": ranks(STAR),
    "star_best_airline": best(STAR),
    "star_best_airline_windowed": best(T_TUMBLING),
    "star_best_airline_semi": best(T_TUMBLING),
    "star_price_trend_windowed": trend(T_TUMBLING),
    "star_price_trend_daily": daily(STAR),
    "star_trend_series": series(T_TUMBLING),
    "star_compare_route_stats": compared_stats(T_TUMBLING, "route_stats", "2001-12-31", "1000 days"),
    "star_compare_best_airline": compared_best(T_TUMBLING, "best_airlines", "2001-12-31", "1000 days"),
    "star_batch_route_stats": stats(STAR),
    "star_batch_best_airlines": best_ranked(STAR),
}
