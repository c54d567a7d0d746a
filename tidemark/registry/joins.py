"""Interval and as-of joins, over static tables and over streams.

The stream forms run over all events as one batch and return what is final by then: the oracle adds
the finality rule to the plain join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.aggregates import keyed
from tidemark.operators.asof import asof_join
from tidemark.operators.asof_stream import asof_stream
from tidemark.operators.joins import interval_join
from tidemark.operators.stateful import kept_state
from tidemark.plans.admission import check_stream_plan
from tidemark.registry.base import event_catalog, query, role
from tidemark.session import workspace
from tidemark.sources.definitions import Source, Stream, read_live
from tidemark.sources.landing import Writer
from tidemark.streaming.journal import Journal
from tidemark.streaming.run import drain, replay

BOUND = "6 hours"
TRADES = "t AS (SELECT event_id AS trade_id, user_id AS t_user, value AS t_price, ts AS t_ts FROM events WHERE event_type = 'purchase')"
ORDERS = "o AS (SELECT event_id AS order_id, user_id AS o_user, value AS o_price, ts AS o_ts FROM events WHERE event_type = 'click')"
QUOTES = "q AS (SELECT event_id AS quote_id, user_id AS q_user, value AS q_price, ts AS q_ts FROM events WHERE event_type = 'view')"
ON = "t_user = o_user AND o_ts BETWEEN t_ts AND t_ts + INTERVAL 6 HOUR"
COLUMNS = "trade_id, t_user, t_price, t_ts, order_id, o_user, o_price, o_ts"


def _mark(t_delay: str = "5 SECOND", o_delay: str = "5 SECOND") -> str:
    """The smaller of the two watermarks, cut to milliseconds."""
    return (f"m AS (SELECT date_trunc('milliseconds', least((SELECT max(t_ts) FROM t) - INTERVAL {t_delay}, "
            f"(SELECT max(o_ts) FROM o) - INTERVAL {o_delay})) AS mark)")


def _sql(how: str, where: str = "", mark: str | None = None) -> str:
    return f"WITH {TRADES}, {ORDERS}, {mark or _mark()} SELECT {COLUMNS} FROM t {how} JOIN o ON {ON} {where}"


LEFT_FINAL = "(t_ts + INTERVAL 6 HOUR < (SELECT mark FROM m))"
RIGHT_FINAL = "(o_ts < (SELECT mark FROM m))"


def _joined(spark: SparkSession, sf_dir: str, how: str, live: bool, salts: tuple[int, int] = (1, 1)) -> DataFrame:
    catalog = event_catalog(spark, sf_dir).add(Stream("matched", ["trades", "orders"], lambda t, o: interval_join(
        t, o, [("t_user", "o_user")], "t_ts", "o_ts", BOUND, how, salts)))
    if not live:
        return catalog.static("matched")
    return replay(catalog.live("matched"), workspace(spark, f"interval_join_{how}"))


@query(_sql("INNER"))
def interval_join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir, "inner", live=True)


@query(_sql("LEFT", f"WHERE order_id IS NOT NULL OR {LEFT_FINAL}"))
def interval_join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir, "left", live=True)


@query(_sql("RIGHT", f"WHERE trade_id IS NOT NULL OR {RIGHT_FINAL}"))
def interval_join_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir, "right", live=True)


@query(_sql("FULL", f"WHERE (trade_id IS NOT NULL AND order_id IS NOT NULL) OR (order_id IS NULL AND {LEFT_FINAL}) "
                    f"OR (trade_id IS NULL AND {RIGHT_FINAL})"))
def interval_join_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir, "full", live=True)


ANTI = f"NOT EXISTS (SELECT 1 FROM o WHERE {ON})"


@query(f"WITH {TRADES}, {ORDERS}, {_mark()} SELECT trade_id, t_user, t_price, t_ts FROM t WHERE {ANTI} AND {LEFT_FINAL}")
def interval_join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir, "anti", live=True)


@query(_sql("LEFT", f"WHERE order_id IS NOT NULL OR {LEFT_FINAL}"))
def interval_join_left_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of a hot key's bucket spread over parts, the side that is not kept too."""
    return _joined(spark, sf_dir, "left", live=True, salts=(2, 2))


@query(_sql("FULL", f"WHERE (trade_id IS NOT NULL AND order_id IS NOT NULL) OR (order_id IS NULL AND {LEFT_FINAL}) "
                    f"OR (trade_id IS NULL AND {RIGHT_FINAL})"))
def interval_join_full_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir, "full", live=True, salts=(2, 2))


@query(f"WITH {TRADES}, {ORDERS}, {_mark()} SELECT trade_id, t_user, t_price, t_ts FROM t WHERE {ANTI} AND {LEFT_FINAL}")
def interval_join_anti_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir, "anti", live=True, salts=(1, 3))


@query(_sql("INNER"))
def interval_join_inner_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir, "inner", live=False)


@query(_sql("LEFT"))
def interval_join_left_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir, "left", live=False)


@query(_sql("RIGHT"))
def interval_join_right_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir, "right", live=False)


@query(_sql("FULL"))
def interval_join_full_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir, "full", live=False)


@query(f"WITH {TRADES}, {ORDERS} SELECT trade_id, t_user, t_price, t_ts FROM t WHERE {ANTI}")
def interval_join_anti_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir, "anti", live=False)


@query(_sql("LEFT", f"WHERE order_id IS NOT NULL OR {LEFT_FINAL}", _mark("5 SECOND", "24 HOUR")))
def wm_multi_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inputs with different delays: rows are final under the smaller watermark."""
    catalog = event_catalog(spark, sf_dir).add(
        Stream("slow_orders", ["all_events"], role("click", "o", "order_id", "24 hours")),
        Stream("matched", ["trades", "slow_orders"], lambda t, o: interval_join(
            t, o, [("t_user", "o_user")], "t_ts", "o_ts", BOUND, "left")))
    return replay(catalog.live("matched"), workspace(spark, "wm_multi_input"))


@query(_sql("LEFT"))
def wm_advance_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both inputs of an outer join moved on by their writers, which makes every row without a partner final."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "wm_advance_join")
    end = catalog.static("all_events").agg(F.unix_millis(F.max("ts").cast("timestamp"))).head()[0]
    for stream, columns, ts in (("trades", "trade_id BIGINT, t_user BIGINT, t_price DOUBLE, t_ts TIMESTAMP", "t_ts"),
                                ("orders", "order_id BIGINT, o_user BIGINT, o_price DOUBLE, o_ts TIMESTAMP", "o_ts")):
        source = Source(f"landed_{stream}", columns, f"{root}/{stream}", watermark=(ts, "5 seconds"))
        catalog.add(source)
        with Writer(catalog.spark, source) as writer:
            writer.write(catalog.static(stream))
            writer.watermark(end + 24 * 3600 * 1000)
    catalog.add(Stream("matched", ["landed_trades", "landed_orders"], lambda t, o: interval_join(
        t, o, [("t_user", "o_user")], "t_ts", "o_ts", BOUND, "left")))
    return replay(catalog.live("matched"), root)


@query(f"""WITH {TRADES}, {ORDERS} SELECT trade_id, order_id, t_band FROM
(SELECT *, CASE WHEN t_price > 50 THEN 'high' ELSE 'low' END AS t_band FROM t) t
JOIN (SELECT *, CASE WHEN o_price > 50 THEN 'high' ELSE 'low' END AS o_band FROM o) o ON t_band = o_band AND {ON}""")
def join_key_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two keys, VARCHAR and BIGINT, whose types are checked position by position."""
    catalog = event_catalog(spark, sf_dir)
    band = lambda price: F.when(F.col(price) > 50, "high").otherwise("low")
    trades = catalog.static("trades").withColumn("t_band", band("t_price"))
    orders = catalog.static("orders").withColumn("o_band", band("o_price"))
    keys = [("t_band", "o_band"), ("t_user", "o_user")]
    return interval_join(trades, orders, keys, "t_ts", "o_ts", BOUND).select("trade_id", "order_id", "t_band")


MATCHED = "trade_id BIGINT, order_id BIGINT, o_user BIGINT, o_ts TIMESTAMP, price_diff DOUBLE"


def _staged_matches(spark: SparkSession, sf_dir: str, root: str):
    """The matched stream as a named source of its own."""
    catalog = event_catalog(spark, sf_dir).add(Stream("matched", ["trades", "orders"], lambda t, o: interval_join(
        t, o, [("t_user", "o_user")], "t_ts", "o_ts", BOUND).select(
            "trade_id", "order_id", "o_user", "o_ts", (F.col("t_price") - F.col("o_price")).alias("price_diff"))))
    drain(catalog.live("matched"), f"{root}/matched", f"{root}/matched_checkpoint")
    return catalog, Source("matched_rows", MATCHED, f"{root}/matched", watermark=("o_ts", "5 seconds"))


@query(f"""WITH {TRADES}, {ORDERS} SELECT o_user AS device, count(*) AS match_count, round(avg(t_price - o_price), 8) AS avg_diff
FROM t JOIN o ON {ON} GROUP BY o_user""")
def staged_join_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A join whose named output a second stream aggregates by key."""
    root = workspace(spark, "staged_join_agg")
    catalog, matched = _staged_matches(spark, sf_dir, root)
    totals = keyed(read_live(catalog.streaming, matched), ["o_user"], match_count=F.count(F.lit(1)),
                   avg_diff=F.avg("price_diff"))
    journal = Journal(catalog.spark, f"{root}/totals", ["o_user"])
    drain(totals, journal, f"{root}/totals_checkpoint", "update")
    return journal.latest(["o_user"]).select(
        F.col("o_user").alias("device"), "match_count", F.round("avg_diff", 8).alias("avg_diff"))


@query(f"""WITH {TRADES}, {ORDERS}, {QUOTES} SELECT trade_id, order_id, quote_id FROM t JOIN o ON {ON}
JOIN q ON o_user = q_user AND q_ts BETWEEN o_ts AND o_ts + INTERVAL 6 HOUR""")
def staged_three_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A three-way join in two stages: the first join is named and joined again."""
    root = workspace(spark, "staged_three_way")
    catalog, matched = _staged_matches(spark, sf_dir, root)
    chained = interval_join(read_live(catalog.streaming, matched), catalog.live("quotes"), [("o_user", "q_user")],
                            "o_ts", "q_ts", BOUND)
    return replay(chained.select("trade_id", "order_id", "quote_id"), root)


@query(f"""WITH {TRADES}, {ORDERS}, {QUOTES}, p AS (SELECT t_user, o_user, o_ts, o_price FROM t JOIN o ON {ON})
SELECT 'bounded join' AS shape, o_user AS device, count(*) AS row_count FROM p GROUP BY o_user
UNION ALL SELECT 'filtered join', o_user, count(*) FROM p WHERE o_price > 50 GROUP BY o_user
UNION ALL SELECT 'three-way join', o_user, count(*) FROM p JOIN q ON o_user = q_user AND q_ts BETWEEN o_ts AND o_ts + INTERVAL 6 HOUR
GROUP BY o_user""")
def admission_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joins of streams that the check before the start admits, each run as one stream: rows by shape and key."""
    catalog, root = event_catalog(spark, sf_dir), workspace(spark, "admission_checks")
    t, o, q = (catalog.live(name) for name in ("trades", "orders", "quotes"))
    pairs = interval_join(t, o, [("t_user", "o_user")], "t_ts", "o_ts", BOUND)
    shapes = {"bounded join": pairs, "filtered join": pairs.filter("o_price > 50"),
              "three-way join": interval_join(pairs, q, [("o_user", "q_user")], "o_ts", "q_ts", BOUND)}
    counted = [replay(check_stream_plan(frame).select("o_user"), f"{root}/{shape.split()[0]}").groupBy(F.col("o_user").alias("device")).agg(
        F.count(F.lit(1)).alias("row_count")).select(F.lit(shape).alias("shape"), "device", "row_count")
        for shape, frame in shapes.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


ASOF = "t ASOF LEFT JOIN q ON t_user = q_user AND t_ts >= q_ts"
ASOF_COLUMNS = "trade_id, t_user, t_price, t_ts, quote_id, q_user, q_price, q_ts"


def _asof_sql(retention: str, final: bool) -> str:
    """The last quote at or before the trade, blanked when older than the retention."""
    kept = ", ".join(f"CASE WHEN q_ts >= t_ts - INTERVAL {retention} THEN {c} END AS {c}" for c in ("quote_id", "q_user", "q_price", "q_ts"))
    where = ("WHERE t_ts < (SELECT date_trunc('milliseconds', least((SELECT max(t_ts) FROM t), (SELECT max(q_ts) FROM q)) "
             "- INTERVAL 5 SECOND))") if final else ""
    return f"WITH {TRADES}, {QUOTES} SELECT trade_id, t_user, t_price, t_ts, {kept} FROM {ASOF} {where}"


@query(f"WITH {TRADES}, {QUOTES} SELECT {ASOF_COLUMNS} FROM {ASOF}")
def asof_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each trade with the latest quote of its key."""
    catalog = event_catalog(spark, sf_dir)
    return asof_join(catalog.static("trades"), catalog.static("quotes"), [("t_user", "q_user")], "t_ts", "q_ts", "quote_id")


@query(_asof_sql("6 HOUR", final=False))
def asof_left_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with quotes forgotten after six hours."""
    catalog = event_catalog(spark, sf_dir)
    return asof_join(catalog.static("trades"), catalog.static("quotes"), [("t_user", "q_user")], "t_ts", "q_ts",
                     "quote_id", retention="6 hours")


SHARED = 256  # groups that the users of a slice are dealt over


def _asof_stream(spark: SparkSession, sf_dir: str, retention: str, label: str, root: str | None = None) -> DataFrame:
    """A user has few events in a slice, so users share groups: as many users as there may be, the groups stay as many."""
    catalog = event_catalog(spark, sf_dir)
    valued = asof_stream(catalog.live("trades"), catalog.live("quotes"), [("t_user", "q_user")], "t_ts", "q_ts", "quote_id", retention, shared=SHARED)
    return replay(valued, root or workspace(spark, label)).filter("NOT _late").drop("_late")


@query(_asof_sql("10 DAY", final=True))
def asof_left_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The as-of join of two streams; a trade appears once the watermark has passed it."""
    return _asof_stream(spark, sf_dir, "10 days", "asof_left_stream")


@query(_asof_sql("12 HOUR", final=True))
def state_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with history kept for twelve hours only."""
    return _asof_stream(spark, sf_dir, "12 hours", "state_retention")


@query(f"""WITH {TRADES}, {QUOTES}, m AS (SELECT epoch_ms(date_trunc('milliseconds', least((SELECT max(t_ts) FROM t), (SELECT max(q_ts) FROM q)) - INTERVAL 5 SECOND)) AS mark),
seen AS (SELECT q_user AS user_id, epoch_ms(q_ts) // 43200000 + visit AS slice FROM q, (VALUES (0), (1)) v(visit) WHERE q_user IS NOT NULL),
open AS (SELECT t_user AS user_id, epoch_ms(t_ts) // 43200000 AS slice, count(*) AS open_trades FROM t WHERE t_ts >= make_timestamp((SELECT mark FROM m) * 1000) GROUP BY ALL),
live AS (SELECT DISTINCT user_id, slice FROM seen WHERE (slice + 1) * 43200000 > (SELECT mark FROM m))
SELECT user_id, slice, live.slice IS NOT NULL AS has_history, coalesce(open_trades, 0) AS open_trades
FROM live FULL JOIN open USING (user_id, slice)""")
def state_retention_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the engine's state still holds after that run: half days that a later trade may fall into, and trades that wait."""
    root = workspace(spark, "state_retention_kept")
    _asof_stream(spark, sf_dir, "12 hours", "state_retention_kept", root)

    def kept(name: str) -> DataFrame:
        rows = kept_state(spark, f"{root}/checkpoint", name).select(F.explode("list_element.keys").alias("keys"), F.col("key._slice").alias("slice"))
        return rows.groupBy(F.from_json("keys", "_key0 bigint")["_key0"].alias("user_id"), "slice")

    history = kept("history").agg(F.lit(True).alias("has_history"))
    waiting = kept("open").agg(F.count(F.lit(1)).alias("open_trades"))
    both = history.join(waiting, ["user_id", "slice"], "full")
    return both.select("user_id", "slice", F.coalesce("has_history", F.lit(False)).alias("has_history"), F.coalesce("open_trades", F.lit(0)).cast("bigint").alias("open_trades"))
