"""Tables that follow their sources: growing schemas, snapshots, restores, maintained aggregates, bounded stream joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.cdc import cdc_apply
from tidewell.operators.history import FeedHistory
from tidewell.operators.maintain import GoldView, refresh
from tidewell.plans.common import CUSTOMER_FEED_CTE, with_ctes
from tidewell.plans.registry import query
from tidewell.plans.version_queries import FC, FEED_SQL, V10, V12, V15, V20, customer_change_feed, state_sql
from tidewell.session import scratch_path
from tidewell.sources import shapes
from tidewell.sources.change_feed import NAME as CHANGE_FEED, register_change_feed
from tidewell.sources.tables import read_table
from tidewell.streaming.ingest import RESCUED, GrowingIngest
from tidewell.streaming.joins import bounded_stream_join
from tidewell.streaming.runner import land_files, run_available_now
from tidewell.streaming.store import VersionedTable

D11, D21 = "TIMESTAMP '2024-01-11 00:00:00'", "TIMESTAMP '2024-01-21 00:00:00'"
THIRDS = [f"row_time < {D11}", f"row_time >= {D11} AND row_time < {D21}", f"row_time >= {D21}"]


# ---------------------------------------------------------------------------- growing schema


def _growing_drops(spark, d) -> list[DataFrame]:
    """Three deliveries of JSON lines: the second has a new nested column, and in the third the ``balance`` of
    deleted customers is text."""
    f = shapes.customer_feed(spark, d).withColumn("row_time", F.date_format("row_time", shapes.JSON_TS_FORMAT))
    old, address = ["customer_id", "email", "row_time"], F.struct("city", "country_code").alias("address")
    balance = F.when(F.col("row_status") == "delete", F.lit('"n/a"')).otherwise(F.col("balance").cast("string"))
    one, two, three = (f.filter(c) for c in THIRDS)
    return [one.select(F.to_json(F.struct(*old, "balance")).alias("value")),
            two.select(F.to_json(F.struct(*old, "balance", address)).alias("value")),
            three.select(F.concat(F.lit('{"balance":'), balance, F.lit(","),
                                  F.ltrim(F.to_json(F.struct(*old, address)), F.lit("{"))).alias("value"))]


@query("ingest_growing_schema", with_ctes(CUSTOMER_FEED_CTE) + f"""
SELECT customer_id, email, strftime(row_time, '%Y-%m-%dT%H:%M:%S.%f') AS row_time,
       CASE WHEN row_time < {D21} OR row_status <> 'delete' THEN balance END AS balance,
       CASE WHEN row_time >= {D11} THEN city END AS city,
       CASE WHEN row_time >= {D11} THEN CAST(country_code AS BIGINT) END AS country_code,
       CASE WHEN row_time >= {D21} AND row_status = 'delete' THEN '{{"balance":"n/a"}}' END AS rescued
FROM cf
""")
def q_ingest_growing_schema(spark, d):
    """Each drop lands and is taken in by a run on the same checkpoint; the last run finds nothing new."""
    landing = scratch_path(spark, "landing-growing")
    ingest = GrowingIngest(spark, landing, scratch_path(spark, "growing"), scratch_path(spark, "growing-schema"),
                           scratch_path(spark, "checkpoint-growing"))
    for drop in _growing_drops(spark, d):
        land_files(drop, "text", "landing-growing", path=landing)
        ingest.run()
    out = ingest.run()
    return out.select("customer_id", "email", "row_time", "balance", "address.city", "address.country_code",
                      F.col(RESCUED).alias("rescued"))


@query("ingest_untyped_schema", with_ctes(CUSTOMER_FEED_CTE) + """
SELECT CAST(customer_id AS VARCHAR) AS customer_id, email, CAST(country_code AS VARCHAR) AS country_code, row_status,
       strftime(row_time, '%Y-%m-%dT%H:%M:%S.%f') AS row_time FROM cf
""")
def q_ingest_untyped_schema(spark, d):
    """Without type inference every column is a string."""
    landing = land_files(shapes.customer_feed(spark, d), "json", "landing-untyped", timestampFormat=shapes.JSON_TS_FORMAT)
    ingest = GrowingIngest(spark, landing, scratch_path(spark, "untyped"), scratch_path(spark, "untyped-schema"),
                           scratch_path(spark, "checkpoint-untyped"), infer_types=False)
    return ingest.run().select("customer_id", "email", "country_code", "row_status", "row_time")


# ---------------------------------------------------------------------------- restores and snapshots


def _customers_table(spark, d, after=lambda table, version: None) -> VersionedTable:
    """Customers kept by applying the feed in three commits; ``after`` runs after each."""
    feed = shapes.customer_feed(spark, d)
    table = VersionedTable(spark, scratch_path(spark, "customers"), ["customer_id"])
    table.create(spark.createDataFrame([], feed.schema), 1)
    for i, part in enumerate(THIRDS, 1):
        table.commit(i, feed.filter(part), lambda cur, s: cdc_apply(cur, s, ["customer_id"], "row_time"))
        after(table, i)
    return table


OLD_SQL, NOW_SQL = state_sql("old", "2024-01-11"), state_sql("cur", "2100-01-01")


@query("restore_committed", with_ctes(CUSTOMER_FEED_CTE, OLD_SQL, NOW_SQL) + f"""
SELECT 4 AS version, {FC} FROM old UNION ALL SELECT 3, {FC} FROM cur
""")
def q_restore_committed(spark, d):
    """Version 4 restores version 1; version 3 can still be read."""
    table = _customers_table(spark, d)
    table.restore(1, version=4)
    return table.read().withColumn("version", F.lit(4)).unionByName(table.read(3).withColumn("version", F.lit(3)))


def _prefixed(p: str) -> str:
    return ", ".join(f"{p}.{c.strip()}" for c in FC.split(","))


@query("restore_committed_changes", with_ctes(CUSTOMER_FEED_CTE, OLD_SQL, NOW_SQL) + f"""
SELECT {_prefixed('o')}, 'insert' AS _change_type FROM old o WHERE customer_id NOT IN (SELECT customer_id FROM cur)
UNION ALL SELECT {_prefixed('c')}, 'delete' FROM cur c WHERE customer_id NOT IN (SELECT customer_id FROM old)
UNION ALL SELECT {_prefixed('c')}, 'update_preimage' FROM cur c JOIN old o USING (customer_id) WHERE c.row_time <> o.row_time
UNION ALL SELECT {_prefixed('o')}, 'update_postimage' FROM cur c JOIN old o USING (customer_id) WHERE c.row_time <> o.row_time
""")
def q_restore_committed_changes(spark, d):
    """A stream that follows the table sees the restore's change rows once, though the restore is run twice."""
    seen, ckpt = scratch_path(spark, "followed"), scratch_path(spark, "checkpoint-followed")

    def follow(table, version=None):
        schema = spark.read.parquet(f"{table.path}/changes").schema
        run_available_now(spark.readStream.schema(schema).parquet(f"{table.path}/changes"), "followed", path=seen, checkpoint=ckpt)

    table = _customers_table(spark, d)
    follow(table)
    for _ in range(2):
        table.restore(1, version=4)
        follow(table)
    return spark.read.parquet(seen).filter("_commit_version = 4").drop("_commit_version", "_commit_timestamp")


AS_OF = {V10: "2024-01-11", V12: "2024-01-13", V15: "2024-01-16", V20: "2024-01-21"}


@query("as_of_snapshots", with_ctes(CUSTOMER_FEED_CTE, *[state_sql(f"s{v}", end) for v, end in AS_OF.items()])
       + " UNION ALL ".join(f"SELECT {v} AS as_of, {FC} FROM s{v}" for v in AS_OF))
def q_as_of_snapshots(spark, d):
    """Reads as of four versions, each from the newest snapshot before it."""
    history = FeedHistory(spark, scratch_path(spark, "history"), ["customer_id"])
    history.append(customer_change_feed(spark, d))
    history.snapshot_every(7)
    return reduce(DataFrame.unionByName, [history.as_of(v).withColumn("as_of", F.lit(v)) for v in AS_OF])


# ---------------------------------------------------------------------------- aggregates from change rows

COUNTRY_VIEW = GoldView(
    keys={"country_code": "country_code"}, counts={"customers": "1"}, sums={"cents": "CAST(round(balance * 100) AS BIGINT)"},
    mins={"first_change": "row_time"}, maxs={"last_change": "row_time", "last_city": "city"}, distincts={"cities": "city"})


@query("gold_from_changes", with_ctes(CUSTOMER_FEED_CTE, NOW_SQL) + """
SELECT country_code, count(*) AS customers, CAST(sum(CAST(round(balance * 100) AS BIGINT)) AS BIGINT) AS cents,
       min(row_time) AS first_change, max(row_time) AS last_change, max(city) AS last_city, count(DISTINCT city) AS cities
FROM cur GROUP BY country_code
""")
def q_gold_from_changes(spark, d):
    """The country table follows the customers' change rows (inserts, updates, deletes) as a stream."""
    gold = VersionedTable(spark, scratch_path(spark, "countries"), list(COUNTRY_VIEW.keys))
    ckpt = scratch_path(spark, "checkpoint-countries")

    def follow(table, version):
        changes = f"{table.path}/changes"
        if not gold.exists():
            gold.create(COUNTRY_VIEW.full(table.read(0)), 1)
        run_available_now(spark.readStream.schema(spark.read.parquet(changes).schema).parquet(changes), "countries", checkpoint=ckpt,
                          foreach_batch=lambda batch, epoch: refresh(COUNTRY_VIEW, gold, table, epoch + 1, batch))

    _customers_table(spark, d, follow)
    return COUNTRY_VIEW.read(gold.read())


# ---------------------------------------------------------------------------- bounded stream joins


def _clicks_and_purchases(spark, d, how: str) -> DataFrame:
    """Clicks with the same user's purchases of the next six hours.  Both feeds land in time order in three
    drops; before the last one a copy of the first five days lands again, behind the watermark."""
    e = read_table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "region", F.pmod("user_id", F.lit(25)))
    sides = [e.filter("event_type = 'click'").select("user_id", "region", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts")),
             e.filter("event_type = 'purchase'").select("user_id", "region", F.col("event_id").alias("buy_id"), F.col("ts").alias("buy_ts"),
                                                        "value")]
    times = ("click_ts", "buy_ts")
    landings = [scratch_path(spark, f"landing-{t}") for t in times]
    out, ckpt = scratch_path(spark, "bounded-join"), scratch_path(spark, "checkpoint-bounded-join")
    early = "TIMESTAMP '2024-01-06 00:00:00'"
    for part in (f"{{}} < {D11}", f"{{}} >= {D11} AND {{}} < {D21}", f"{{}} < {early}", f"{{}} >= {D21}"):
        for side, t, landing in zip(sides, times, landings):
            land_files(side.filter(part.replace("{}", t)), "parquet", "landing", path=landing)
        left, right = (spark.readStream.schema(side.schema).parquet(landing) for side, landing in zip(sides, landings))
        joined = bounded_stream_join(left, right, ["user_id", "region"], times, ("10 minutes", "10 minutes"), latest="6 hours", how=how)
        run_available_now(joined, "bounded-join", path=out, checkpoint=ckpt)
    return spark.read.parquet(out)


CLICKS_SQL = """
WITH c AS (SELECT user_id, user_id % 25 AS region, event_id AS click_id, CAST(ts AS TIMESTAMP) AS click_ts FROM events WHERE event_type = 'click'),
b AS (SELECT user_id, event_id AS buy_id, CAST(ts AS TIMESTAMP) AS buy_ts, value FROM events WHERE event_type = 'purchase'),
m AS (SELECT c.user_id, region, click_id, click_ts, buy_id, buy_ts, value FROM c JOIN b ON c.user_id = b.user_id
      AND buy_ts BETWEEN click_ts AND click_ts + INTERVAL 6 HOUR)
"""


@query("stream_join_bounded", CLICKS_SQL + "SELECT * FROM m")
def q_stream_join_bounded(spark, d):
    return _clicks_and_purchases(spark, d, "inner")


@query("stream_left_join_bounded", CLICKS_SQL + """
SELECT * FROM m UNION ALL
SELECT user_id, region, click_id, click_ts, NULL, NULL, NULL FROM c WHERE click_id NOT IN (SELECT click_id FROM m)
  AND click_ts + INTERVAL 6 HOUR < least((SELECT max(click_ts) FROM c), (SELECT max(buy_ts) FROM b)) - INTERVAL 10 MINUTE
""")
def q_stream_left_join_bounded(spark, d):
    """Clicks that nothing can match any more come without a purchase; those still waiting are held back."""
    return _clicks_and_purchases(spark, d, "left_outer")


# ---------------------------------------------------------------------------- change feed as a data source


def _stored_feed(spark, d) -> FeedHistory:
    register_change_feed(spark)
    return FeedHistory(spark, scratch_path(spark, "feed-source"), ["customer_id"])


@query("change_feed_source", FEED_SQL + f"SELECT * FROM feed WHERE _commit_version BETWEEN {V12} AND {V15}")
def q_change_feed_source(spark, d):
    """The stored feed read by format, between two versions."""
    history = _stored_feed(spark, d)
    history.append(customer_change_feed(spark, d))
    return (spark.read.format(CHANGE_FEED).option("startingVersion", V12).option("endingVersion", V15)
            .load(f"{history.path}/feed"))


@query("stream_change_feed_source", FEED_SQL + f"SELECT * FROM feed WHERE _commit_version >= {V12}")
def q_stream_change_feed_source(spark, d):
    """A stream by format from a starting version: one run, later versions arrive, a second run goes on from there."""
    history, feed = _stored_feed(spark, d), customer_change_feed(spark, d)
    out, ckpt = scratch_path(spark, "feed-streamed"), scratch_path(spark, "checkpoint-feed-streamed")
    for part in (f"_commit_version <= {V15}", f"_commit_version > {V15}"):
        history.append(feed.filter(part))
        stream = spark.readStream.format(CHANGE_FEED).option("startingVersion", V12).load(f"{history.path}/feed")
        run_available_now(stream, "feed-streamed", path=out, checkpoint=ckpt)
    return spark.read.parquet(out)
