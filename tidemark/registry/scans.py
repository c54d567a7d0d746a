"""Sources, tables, inline rows, projections and predicates."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.aggregates import tumble
from tidemark.operators.joins import interval_join
from tidemark.registry.base import DELAY, EVENT_COLUMNS, event_catalog, land_in_turn, query
from tidemark.session import derive, workspace
from tidemark.sources import conform
from tidemark.sources.definitions import Sink, Source, Stream, Table, read_live, read_static
from tidemark.sources.inline import values
from tidemark.sources.landing import Writer
from tidemark.sources.tables import KeyedTable
from tidemark.streaming.run import Runner, replay


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared source over Parquet files, read as a table."""
    return event_catalog(spark, sf_dir).static("events")


@query("SELECT s_suppkey AS id, s_name AS device, s_acctbal AS reading FROM supplier "
       "UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer")
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SELECT * over two keyed tables."""
    session = derive(spark)
    supplier = Table("supplier", "s_suppkey BIGINT NOT NULL, s_name VARCHAR, s_acctbal DOUBLE",
                     f"{sf_dir}/supplier.parquet", "s_suppkey")
    customer = Table("customer", "c_custkey BIGINT NOT NULL, c_name VARCHAR, c_acctbal DOUBLE",
                     f"{sf_dir}/customer.parquet", "c_custkey")
    names = ["id", "device", "reading"]
    return read_static(session, supplier).toDF(*names).unionByName(read_static(session, customer).toDF(*names))


@query("""SELECT e.event_id, CAST(t.id AS BIGINT) AS id, t.device, CAST(t.value AS DOUBLE) AS value
FROM events e LEFT JOIN (VALUES (11, 'click', 0.25), (12, 'purchase', 7.5), (13, NULL, 99.0)) AS t(id, device, value)
ON e.event_type = t.device""")
def values_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inline VALUES, NULL kept, looked up for each event. The NULL row matches nothing."""
    events = event_catalog(spark, sf_dir).static("events").select("event_id", "event_type")
    inline = values(spark, "(11, 'click', 0.25), (12, 'purchase', 7.5), (13, NULL, 99.0)", ["id", "device", "value"])
    return events.join(F.broadcast(inline), F.col("event_type") == F.col("device"), "left").select(
        "event_id", "id", "device", "value")


@query("SELECT event_id, ts, TIMESTAMP '2024-01-15 10:00:00' AS pivot, "
       "ts >= TIMESTAMP '2024-01-15 10:00:00' AS after_pivot FROM events")
def timestamp_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamp literals are zone-less and read as UTC."""
    pivot = F.expr("TIMESTAMP_NTZ '2024-01-15 10:00:00'")
    events = event_catalog(spark, sf_dir).static("events")
    return events.select("event_id", "ts", pivot.alias("pivot"), (F.col("ts") >= pivot).alias("after_pivot"))


@query("SELECT o_orderkey AS id, o_totalprice AS reading FROM orders")
def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inserts into one keyed table; the second holds other keys, which the insert checks."""
    session = derive(spark)
    table = KeyedTable(session, Table("readings", "id BIGINT NOT NULL, reading DOUBLE",
                                      workspace(spark, "table_append"), "id"))
    orders = session.read.parquet(f"{sf_dir}/orders.parquet")
    finished = F.col("o_orderstatus") == "F"
    for part in (finished, ~finished):
        table.append(orders.filter(part).select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("reading")))
    return table.read()


@query("""WITH latest AS (
  SELECT o_custkey, o_totalprice FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT o_custkey AS id, o_totalprice AS reading FROM latest
UNION ALL
SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM latest)""")
def table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' balances, overwritten by the price of their last order."""
    session = derive(spark)
    table = KeyedTable(session, Table("readings", "id BIGINT NOT NULL, reading DOUBLE",
                                      workspace(spark, "table_upsert"), "id"))
    customer = session.read.parquet(f"{sf_dir}/customer.parquet")
    table.append(customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("reading")))
    orders = session.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("reading"), "o_orderdate", "o_orderkey")
    table.upsert(orders, [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return table.read()


@query("""SELECT event_id,
  CASE WHEN event_type IN ('click', 'purchase') THEN event_id END AS id,
  CASE WHEN event_type IN ('click', 'purchase') THEN event_type END AS kind,
  CASE WHEN event_type IN ('click', 'purchase') THEN value END AS reading,
  CASE WHEN event_type IN ('click', 'purchase') THEN ts END AS seen_at,
  CASE event_type WHEN 'error' THEN 'extra' WHEN 'view' THEN 'kind' WHEN 'signup' THEN 'reading' END AS field,
  CASE WHEN event_type NOT IN ('click', 'purchase') THEN 302 END AS code
FROM events""")
def conform_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON rows, three kinds of which break the declared schema in one way each."""
    return _conformed(spark, sf_dir).checked.drop("raw", "reason")


@query("""SELECT coalesce(field, 'none') AS field, CAST(code AS BIGINT) AS code, count(*) AS row_count FROM (
  SELECT CASE event_type WHEN 'error' THEN 'extra' WHEN 'view' THEN 'kind' WHEN 'signup' THEN 'reading' END AS field,
  CASE WHEN event_type NOT IN ('click', 'purchase') THEN 302 ELSE 0 END AS code FROM events) GROUP BY 1, 2""")
def conform_rows_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows conform, and which fields the others fail on."""
    return _conformed(spark, sf_dir).checked.groupBy(
        F.coalesce("field", F.lit("none")).alias("field"), F.coalesce("code", F.lit(0)).cast("bigint").alias("code")
    ).agg(F.count(F.lit(1)).alias("row_count"))


def _conformed(spark: SparkSession, sf_dir: str):
    declared = Source("incoming", "id BIGINT NOT NULL, kind VARCHAR NOT NULL, reading DOUBLE, seen_at TIMESTAMP", "")
    kind = F.col("event_type")
    piece = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    raw = piece(
        '{"id":', F.col("event_id").cast("string"),
        F.when(kind != "view", piece(',"kind":"', kind, '"')).otherwise(""),
        ',"reading":', F.when(kind == "signup", '"n/a"').otherwise(F.col("value").cast("string")),
        ',"seen_at":"', F.col("ts").cast("string"), '"',
        F.when(kind == "error", ',"extra":true').otherwise(""), "}")
    rows = event_catalog(spark, sf_dir).static("events").select("event_id", raw.alias("raw"))
    return conform.conform_rows(rows, declared, keep=("event_id",))


@query("SELECT event_id AS id, event_type AS label FROM events")
def batch_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed batch appended to a source after its schema is compared with the declared one."""
    catalog = event_catalog(spark, sf_dir)
    target = Source("fast", "id BIGINT NOT NULL, label VARCHAR", workspace(spark, "batch_append"))
    with Writer(catalog.spark, target) as writer:
        writer.write(catalog.static("events").select(F.col("event_id").alias("id"), F.col("event_type").alias("label")))
    return read_static(catalog.spark, target)


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches written, then flushed, into a source's folder and read from there as a stream."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "stream_landing")
    source = land_in_turn(catalog, root, 3, lambda _source: None)
    return replay(read_live(catalog.streaming, source), root)


def _replayed(spark: SparkSession, sf_dir: str, label: str, build) -> DataFrame:
    """A stream derived from all events, run over them."""
    catalog = event_catalog(spark, sf_dir).add(Stream("derived", ["all_events"], build))
    return replay(catalog.live("derived"), workspace(spark, label))


@query("SELECT event_id AS id, user_id AS device, value * 2 AS doubled, ts FROM events")
def stream_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replayed(spark, sf_dir, "stream_project", lambda e: e.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("device"), (F.col("value") * 2).alias("doubled"), "ts"))


@query("SELECT event_type AS kind, value FROM events WHERE value > 100")
def stream_filter_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replayed(spark, sf_dir, "stream_filter_gt",
                     lambda e: e.select(F.col("event_type").alias("kind"), "value").filter("value > 100"))


TRADES_SQL = "(SELECT event_id AS trade_id, user_id AS t_user, value AS t_price, ts AS t_ts FROM events WHERE event_type = 'purchase')"
ORDERS_SQL = "(SELECT event_id AS order_id, user_id AS o_user, value AS o_price, ts AS o_ts FROM events WHERE event_type = 'click')"


@query(f"""SELECT trade_id, order_id, t_price - o_price AS price_diff
FROM {TRADES_SQL} t JOIN {ORDERS_SQL} o ON t_user = o_user AND o_ts BETWEEN t_ts AND t_ts + INTERVAL 6 HOUR""")
def expr_subtract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price difference of matched trades and orders."""
    catalog = event_catalog(spark, sf_dir)
    matched = interval_join(catalog.static("trades"), catalog.static("orders"), [("t_user", "o_user")],
                            "t_ts", "o_ts", "6 hours")
    return matched.select("trade_id", "order_id", (F.col("t_price") - F.col("o_price")).alias("price_diff"))


@query(f"""SELECT trade_id, count(order_id) AS order_count
FROM {TRADES_SQL} t LEFT JOIN {ORDERS_SQL} o ON t_user = o_user AND o_ts BETWEEN t_ts AND t_ts + INTERVAL 6 HOUR
GROUP BY trade_id""")
def pred_between_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders within six hours after each trade, both ends included."""
    catalog = event_catalog(spark, sf_dir)
    matched = interval_join(catalog.static("trades"), catalog.static("orders"), [("t_user", "o_user")],
                            "t_ts", "o_ts", "6 hours", "left")
    return matched.groupBy("trade_id").agg(F.count("order_id").alias("order_count"))


@query("""SELECT event_id, c_custkey AS customer_id FROM
(SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS device FROM events) e
LEFT JOIN (SELECT CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_custkey END AS k, c_custkey FROM customer) c ON device = k""")
def pred_key_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key equality with NULL keys on both sides; none of them match."""
    session = event_catalog(spark, sf_dir)
    events = session.static("events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("user_id")).alias("device"))
    customers = session.spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_custkey")).alias("k"), F.col("c_custkey").alias("customer_id"))
    return events.join(customers, F.col("device") == F.col("k"), "left").select("event_id", "customer_id")


@query("SELECT d.id, d.device FROM (SELECT event_id, user_id FROM events WHERE value > 10) AS d(id, device)")
def derived_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A subquery in FROM with column aliases, as Spark SQL text."""
    session = derive(spark)
    session.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("events")
    return session.sql(
        "SELECT d.id, d.device FROM (SELECT event_id, user_id FROM events WHERE value > 10) AS d(id, device)")


@query("""SELECT 'source' AS kind, 'events' AS name, count(*) AS row_count FROM events
UNION ALL SELECT 'source', 'all_events', count(*) FROM events
UNION ALL SELECT 'stream', 'trades', count(*) FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 'stream', 'orders', count(*) FROM events WHERE event_type = 'click'
UNION ALL SELECT 'stream', 'quotes', count(*) FROM events WHERE event_type = 'view'
UNION ALL SELECT 'table', 'customers', count(*) FROM customer""")
def catalog_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources, tables and streams by kind and name, with the rows each holds now."""
    catalog = event_catalog(spark, sf_dir).add(
        Table("customers", "c_custkey BIGINT NOT NULL, c_name VARCHAR", f"{sf_dir}/customer.parquet", "c_custkey"))
    listing = catalog.listing()
    counts = None
    for name in [r["name"] for r in listing.select("name").collect()]:  # one row per definition
        part = catalog.static(name).agg(F.count(F.lit(1)).alias("row_count")).withColumn("name", F.lit(name))
        counts = part if counts is None else counts.unionByName(part)
    return listing.join(counts, "name").select("kind", "name", "row_count")


@query("""SELECT position, field, type_name, nullable, null_count FROM (VALUES
 (0, 'event_id', 'Int64', false), (1, 'ts', 'Timestamp(us)', false), (2, 'user_id', 'Int64', true),
 (3, 'event_type', 'Utf8', true), (4, 'value', 'Float64', true), (5, 'props', 'Utf8', true))
 f(position, field, type_name, nullable)
JOIN (UNPIVOT (SELECT count(*) - count(event_id) AS event_id, count(*) - count(ts) AS ts, count(*) - count(user_id) AS user_id,
 count(*) - count(event_type) AS event_type, count(*) - count(value) AS value, count(*) - count(props) AS props FROM events)
 ON COLUMNS(*) INTO NAME field VALUE null_count) USING (field)""")
def describe_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared columns with canonical type names and nullability, and the NULLs the files really hold."""
    catalog = event_catalog(spark, sf_dir)
    fields = catalog.describe("events")
    source = catalog.get("events")
    counts = catalog.spark.read.parquet(source.path).agg(
        *[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in source.fields])
    nulls = counts.unpivot([], [f.name for f in source.fields], "field", "null_count")
    return fields.join(nulls, "field").select("position", "field", "type_name", "nullable", "null_count")


@query("""SELECT 'hours_out' AS stream, count(*) AS input_rows,
  epoch_ms(date_trunc('milliseconds', max(ts) - INTERVAL 5 SECOND)) AS watermark_ms FROM events
UNION ALL SELECT 'ids_out', count(*), NULL FROM events""")
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in and watermark of running streams, over more batches than a query itself remembers."""
    catalog = event_catalog(spark, sf_dir)
    root = workspace(spark, "stream_metrics")
    landed = land_in_turn(catalog, root, 4, lambda source: None)
    one_by_one = {"maxFilesPerTrigger": "1"}
    catalog.streaming.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    catalog.add(
        replace(landed, options=one_by_one), Source("plain", EVENT_COLUMNS, landed.path, options=one_by_one),
        Stream("hours", ["landed"], lambda e: tumble(e, [], "ts", "1 hour", event_count=F.count("event_id"))),
        Stream("ids", ["plain"], lambda e: e.select("event_id")),
        Sink("hours_out", "hours", f"{root}/hours"), Sink("ids_out", "ids", f"{root}/ids"))
    runner = Runner(catalog, f"{root}/run")
    runner.drain()
    totals = runner.metrics().select("stream", "input_rows", "watermark_ms")
    runner.shutdown()
    return totals


@query("""SELECT event_id, ts, value FROM events
WHERE ts >= TIMESTAMP '2024-01-10 18:00:00' AND ts < TIMESTAMP '2024-01-12 06:00:00'""")
def landing_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A time range of a source that is kept by day: other days' files are not opened."""
    root = workspace(spark, "landing_by_day")
    catalog = event_catalog(spark, sf_dir)
    catalog.add(Source("daily", EVENT_COLUMNS, f"{root}/daily", watermark=("ts", DELAY), by_day=True),
                Stream("some", ["daily"], lambda e: e.select("event_id", "ts", "value")))
    events = catalog.static("all_events")
    with Writer(catalog.spark, catalog.get("daily")) as writer:
        for turn in range(2):
            writer.write(events.filter(F.col("event_id") % 2 == turn))
    return catalog.static("some", datetime(2024, 1, 10, 18), datetime(2024, 1, 12, 6))


@query("SELECT date_trunc('day', ts) AS day, count(*) AS event_count FROM events GROUP BY 1")
def landing_in_bounded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that is kept by day, streamed in batches bounded by bytes; rows by day of what the batches held."""
    root = workspace(spark, "landing_in_bounded_batches")
    catalog = event_catalog(spark, sf_dir)
    daily = Source("daily", EVENT_COLUMNS, f"{root}/daily", watermark=("ts", DELAY), by_day=True,
                   options={"maxBytesPerTrigger": str(1 << 20)})
    catalog.add(daily, Stream("times", ["daily"], lambda e: e.select("event_id", "ts")), Sink("times_out", "times", f"{root}/times"))
    with Writer(catalog.spark, daily) as writer:
        writer.write(catalog.static("all_events"))
    runner = Runner(catalog, f"{root}/run")
    runner.drain()
    return runner.read("times_out").groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(
        F.count(F.lit(1)).alias("event_count"))


@query("""SELECT 'both_out' AS stream, 'landed' AS source, count(*) AS input_rows FROM events
UNION ALL SELECT 'both_out', 'clicks', count(*) FROM events WHERE event_type = 'click'
UNION ALL SELECT 'ids_out', 'landed', count(*) FROM events""")
def stream_metrics_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in by stream and source, from the second of two runners that each took half of the turns."""
    root = workspace(spark, "stream_metrics_restart")
    clicks = Source("clicks", EVENT_COLUMNS, f"{root}/clicks")
    landing, turns, totals = event_catalog(spark, sf_dir), [], []

    def turn(source):
        turns.append(source)
        click = landing.static("all_events").filter(F.col("event_type") == "click")
        with Writer(landing.spark, clicks) as writer:
            writer.write(click.filter(F.col("event_id") % 4 == len(turns) - 1))
        if len(turns) % 2:
            return
        catalog = event_catalog(spark, sf_dir).add(
            source, clicks,
            Stream("both", ["landed", "clicks"], lambda e, c: e.select("event_id").unionByName(c.select("event_id"))),
            Stream("ids", ["landed"], lambda e: e.select("event_id")),
            Sink("both_out", "both", f"{root}/both"), Sink("ids_out", "ids", f"{root}/ids"))
        runner = Runner(catalog, f"{root}/run")
        runner.drain()
        totals.append(runner.source_metrics())
        runner.shutdown()
    land_in_turn(landing, root, 4, turn)
    return totals[-1]
