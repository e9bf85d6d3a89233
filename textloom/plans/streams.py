"""Stream queries over events: the table is fed in several files, taken in as a stream and read from its sink; the SQL is that of the batch forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.plans import ledgers, records, selection
from textloom.sources.folders import shared_folder
from textloom.streaming import stateful as S
from textloom.streaming.ingest import Manifest

MINUTE = 60_000_000


def _events(spark, d) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", "ts", "user_id", "event_type").withColumn("bad", F.col("event_type") == "error")


def _through(spark: SparkSession, table: DataFrame, make) -> DataFrame:
    """What a stream makes of a table that is fed to it."""
    base = shared_folder(spark)
    files = S.fed(table, "ts", f"{base}/feed")
    S.run(make(S.feed(spark, f"{base}/feed", table.schema, files)), f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out")


def stream_fail_rate(spark, d):
    """rolling_fail_rate as a stream."""
    made = _through(spark, _events(spark, d), lambda x: S.in_order(x, ["user_id"], "ts", "event_id", ["bad"], "flags string", "event_id long, rate double, stop boolean", S.rolling_rate))
    return made.select("event_id", "rate", "stop")


def stream_streaks(spark, d):
    """failure_streaks as a stream: of what went out for a user the last counts."""
    made = _through(spark, _events(spark, d), lambda x: S.in_order(x, ["user_id"], "ts", "event_id", ["bad"], "now long, longest long, stop long", "longest long, stop_event long", S.breaker))
    return made.groupBy("user_id").agg(F.max("longest").alias("longest"), F.max("stop_event").alias("stop_event"))


def stream_latest_state(spark, d):
    """latest_state as a stream: of what went out for a user the last counts."""
    made = _through(spark, _events(spark, d), lambda x: S.in_order(x, ["user_id"], "ts", "event_id", ["event_type"], "state string, n long", "state string, n long", S.latest))
    return made.groupBy("user_id").agg(F.max_by("state", "n").alias("state"), F.max("n").alias("n"))


def stream_cooldown(spark, d):
    """cooldown_suppress as a stream; a state goes when its pause is over."""
    pause = F.when(F.col("event_type").startswith("p"), selection.LONG_PAUSE).otherwise(selection.PAUSE).cast("long") * MINUTE
    made = _through(spark, _events(spark, d).withColumn("pause", pause), lambda x: S.in_order(x, ["user_id", "event_type"], "ts", "event_id", ["pause"], "at long, pause long", "event_id long", S.paused, S.pause_over))
    return made.select("event_id", "user_id", "event_type")


def stream_ttl_cache(spark, d):
    """ttl_dedup as a stream; a state goes when its time to live is over."""
    made = _through(spark, _events(spark, d).withColumn("ttl", F.lit(30 * MINUTE)), lambda x: S.in_order(x, ["user_id", "event_type"], "ts", "event_id", ["ttl"], "at long, ttl long", "event_id long, cached boolean", S.cached, S.pause_over))
    return made.select("event_id", "cached")


def stream_heartbeat(spark, d):
    """heartbeat_window as a stream: counts of closed windows go out once, in append mode behind the watermark; rates and flags are drawn from the closed ones."""
    done, bad = F.col("event_type").isin("signup", "purchase"), F.col("event_type") == "error"

    def make(x):
        windows = x.withWatermark("ts", "1 hour").groupBy(F.window("ts", f"{records.BEAT} hours"))
        return windows.agg(F.count_if(done & F.col("event_id").isNotNull()).alias("done"), F.count_if(bad & F.col("event_id").isNotNull()).alias("bad"), F.count("event_id").alias("moved")).select(F.col("window.start").alias("beat"), "done", "bad", "moved")

    return records.beats(_through(spark, _events(spark, d).withColumn("ts", F.col("ts").cast("timestamp")), make).where("moved > 0"))


def manifest_ingest(spark, d):
    """Events as a manifest of fetched files: a user is a paper, an event's type the format, an error a failure. Suppliers are the papers that a list has named."""
    base = shared_folder(spark)
    rows = _events(spark, d).select(F.concat(F.lit("p"), F.col("user_id")).alias("paper"), F.col("event_type").alias("format"), F.col("ts").cast("timestamp").alias("stamp"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("digest"), F.when(F.col("bad"), F.concat(F.lit("error "), F.col("event_id"))).alias("failure"))
    files = S.fed(rows, "stamp", f"{base}/feed", closed=False)
    manifest = Manifest(spark, f"{base}/tables")
    manifest.listed(spark.read.parquet(f"{d}/supplier.parquet").select(F.concat(F.lit("p"), F.col("s_suppkey")).alias("paper")))
    manifest.run(S.feed(spark, f"{base}/feed", rows.schema, files), f"{base}/state")
    failed = manifest.failures.read().groupBy("paper").agg(F.count("*").alias("failures"))
    got = manifest.sources.read().groupBy("paper").agg(F.count("*").alias("formats"), F.max("digest").alias("newest"))
    return manifest.papers.read().join(got, "paper", "left").join(failed, "paper", "left").select("paper", "state", "newest", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("formats", "failures")])


ORACLES = {
    "manifest_ingest": """with e as (select concat('p', user_id) as paper, event_type, event_type = 'error' as bad, ts, lpad(event_id::varchar, 12, '0') as digest from events),
s as (select paper, event_type, max(digest) as digest from e where not bad group by all),
p as (select concat('p', s_suppkey) as paper, 'listed' as state from supplier union all select distinct paper, 'adopted' from e where paper not in (select concat('p', s_suppkey) from supplier))
select paper, state, newest, coalesce(formats, 0) as formats, coalesce(failures, 0) as failures from p left join (select paper, count(*) as formats, max(digest) as newest from s group by 1) using (paper) left join (select paper, count(*) as failures from e where bad group by 1) using (paper)""",
    "stream_fail_rate": ledgers.ORACLES["rolling_fail_rate"],
    "stream_streaks": ledgers.ORACLES["failure_streaks"],
    "stream_latest_state": ledgers.ORACLES["latest_state"],
    "stream_cooldown": selection.ORACLES["cooldown_suppress"],
    "stream_ttl_cache": records.ORACLES["ttl_dedup"],
    "stream_heartbeat": records.ORACLES["heartbeat_window"],
}
QUERIES = {n: globals()[n] for n in ORACLES}
