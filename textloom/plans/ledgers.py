"""Ledgers, joins, ranks and windows over the tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.operators import keyed as K
from textloom.plans.records import ORACLES as RECORDS
from textloom.plans.records import parse_ledger

LEDGER_SQL = RECORDS["parse_ledger"]


def t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def train_filter_earliest(spark, d):
    """The earliest order of a customer is kept; null dates come last."""
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    w = Window.partitionBy("o_custkey").orderBy(F.coalesce("o_orderdate", F.lit("9999-01-01").cast("timestamp")), "o_orderkey")
    return o.select("o_orderkey", (F.row_number().over(w) == 1).cast("int").alias("train_include"))


def dedup_keep_first(spark, d):
    x = t(spark, d, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("h"))
    return x.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


def resume_anti(spark, d):
    return t(spark, d, "documents").select("doc_id", "lang").join(t(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


def upsert_last_wins(spark, d):
    old = t(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    new = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_extendedprice").alias("v"))
    return K.upsert(old, new, ["k"])


def insert_or_ignore(spark, d):
    old = t(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return K.insert_or_ignore(old, t(spark, d, "supplier").select((F.col("s_suppkey") * 3).alias("k"), F.col("s_name").alias("name")), "k")


def export_join(spark, d):
    o, c, n = t(spark, d, "orders"), t(spark, d, "customer"), t(spark, d, "nation")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).where("c_mktsegment <> 'MACHINERY'").select("o_orderkey", "c_name", "n_name", "o_totalprice")


def checkpoint_validate(spark, d):
    """One row a check: rows, unique keys without nulls; ids that two tables share; kinds that are known; failures that have a class."""
    checks = None
    for name, key in (("documents", "doc_id"), ("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_partkey")):
        x = t(spark, d, name).agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys"), F.count_if(F.col(key).isNull()).alias("n_null"))
        x = x.select(F.lit(name).alias("name"), "n_rows", "n_keys", F.when((F.col("n_rows") == F.col("n_keys")) & (F.col("n_null") == 0), "PASS").otherwise("FAIL").alias("verdict"))
        checks = x if checks is None else checks.unionByName(x)
    def check(name, df, ok):  # n_rows: what was looked at; n_keys: what is amiss
        return df.select(F.lit(name).alias("name"), "n_rows", F.col("amiss").alias("n_keys"), F.when(ok, "PASS").otherwise("FAIL").alias("verdict"))

    def ids(name, left, right, key, other):
        both = t(spark, d, left).select(F.col(key).alias("k"), F.lit(1).alias("a")).distinct().join(t(spark, d, right).select(F.col(other).alias("k"), F.lit(1).alias("b")).distinct(), "k", "full")
        return check(name, both.agg(F.count("*").alias("n_rows"), F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("amiss")), F.col("amiss") == 0)

    kinds = t(spark, d, "events").agg(F.count("*").alias("n_rows"), F.count_if(~F.col("event_type").isin("view", "click", "signup", "purchase", "error")).alias("amiss"))
    failures = parse_ledger(spark, d).where("state = 'parsing-failed'").agg(F.count("*").alias("n_rows"), F.count_if(F.col("failure").startswith("other:") | F.col("failure").isin("", "unknown")).alias("amiss"))
    parts = [ids("orders-lineitem", "orders", "lineitem", "o_orderkey", "l_orderkey"), ids("documents-labels", "documents", "labels", "doc_id", "doc_id"), check("known-events", kinds, F.col("amiss") == 0), check("failures-classed", failures, F.col("amiss") == 0)]
    for part in parts:
        checks = checks.unionByName(part)
    return checks


def multiset_diff(spark, d):
    """Lines of each document that the document before it (by id) doesn't have as often."""
    lines = lambda x: x.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    docs = t(spark, d, "documents").select("doc_id", "text")
    return K.multiset_diff(lines(docs), lines(docs.withColumn("doc_id", F.col("doc_id") + 1)), ["doc_id", "line"]).groupBy("doc_id").agg(F.sum("extra").alias("added"))


def sha_verify(spark, d):
    x = t(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("bytes"), (F.length("text") == F.col("n_chars")).alias("length_ok"))
    # The ledger's hashes are of the texts as they were stored; some have changed since, and these are found.
    ledger = t(spark, d, "documents").select("doc_id", F.sha2(F.concat("text", F.when(F.col("doc_id") % 50 == 0, "?").otherwise("")), 256).alias("stored"))
    return x.join(ledger, "doc_id").select("doc_id", "sha256", "bytes", "length_ok", (F.col("sha256") == F.col("stored")).alias("verified"))


def decade_histogram(spark, d):
    y = F.year("o_orderdate")
    return t(spark, d, "orders").groupBy((F.floor(y / 10) * 10).cast("long").alias("decade")).agg(F.count("*").alias("n"))


def group_size_histogram(spark, d):
    g = t(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("size"))
    return g.groupBy("size").agg(F.count("*").alias("keys"))


def top_counter(spark, d):
    x = t(spark, d, "lineitem").join(t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.count("*").alias("n"))
    return x.orderBy(F.desc("n"), "p_brand").limit(25)


def batch_numbering(spark, d):
    return K.numbered_batches(t(spark, d, "customer").select("c_custkey"), "c_custkey", 1000)


def rolling_fail_rate(spark, d):
    """Failures among a user's last 50 events, and whether a full window passes 0.3."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-49, 0)
    bad = (F.col("event_type") == "error").cast("double")
    x = t(spark, d, "events").select("event_id", F.avg(bad).over(w).alias("r"), F.count("*").over(w).alias("seen"))
    return x.select("event_id", F.round("r", 6).alias("rate"), ((F.col("seen") == 50) & (F.col("r") > 0.3)).alias("stop"))


BREAKER = 50  # failures in a row that stop a user's work


def failure_streaks(spark, d):
    """The longest run of failures of each user, and the event at which the run is so long that work stops, if any is."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    bad = F.col("event_type") == "error"
    x = t(spark, d, "events").select("user_id", "event_id", "ts", bad.alias("bad"), F.sum((~bad).cast("long")).over(w).alias("g")).where("bad")
    x = x.withColumn("streak", F.row_number().over(Window.partitionBy("user_id", "g").orderBy("ts", "event_id")))
    return x.groupBy("user_id").agg(F.max("streak").cast("long").alias("longest"), F.min_by("event_id", F.when(F.col("streak") == BREAKER, F.struct("ts", "event_id"))).alias("stop_event"))


def union_feeds(spark, d):
    """Two feeds of one journal united: a paper that both list counts once, as the first feed has it."""
    x = t(spark, d, "documents").select(F.sha2("text", 256).alias("h"), "doc_id", "lang", "source")
    a, b = x.where("doc_id % 3 < 2").withColumn("feed", F.lit(0)), x.where("doc_id % 3 > 0").withColumn("feed", F.lit(1))
    return K.first_by(a.unionByName(b), ["h"], [F.col("feed"), F.col("doc_id")])


def latest_state(spark, d):
    x = t(spark, d, "events").groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type")).alias("m"), F.count("*").alias("n"))
    return x.select("user_id", F.col("m.event_type").alias("state"), "n")


def status_tallies(spark, d):
    return t(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("high"), F.count_distinct("user_id").alias("users"))


def union_top_keys(spark, d):
    """Words of the top 25 of every language in the order first seen, languages by name, 25 of them."""
    words = t(spark, d, "documents").select("lang", F.explode(F.array_remove(F.split(F.lower("text"), "[^a-z0-9]+"), "")).alias("w")).groupBy("lang", "w").agg(F.count("*").alias("n"))
    top = words.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "w"))).where("r <= 25")
    first = top.groupBy("w").agg(F.min(F.struct("lang", "r")).alias("o"))
    return first.orderBy("o").limit(25).select("w", F.col("o.lang").alias("lang"), F.col("o.r").cast("long").alias("o"))


def seeded_sample_sources(spark, d):
    """Five documents of each source by a seeded hash."""
    w = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(42), "doc_id"), "doc_id")
    return t(spark, d, "documents").select("doc_id", "source", F.row_number().over(w).alias("rn")).where("rn <= 5")


ORACLES = {
    "train_filter_earliest": "select o_orderkey, (row_number() over (partition by o_custkey order by coalesce(o_orderdate, timestamp '9999-01-01'), o_orderkey) = 1)::int as train_include from orders",
    "dedup_keep_first": "select sha256(text) as h, min(doc_id) as doc_id, count(*) as copies from documents group by 1",
    "resume_anti": "select doc_id, lang from documents where doc_id not in (select doc_id from labels)",
    "upsert_last_wins": "with n as (select l_orderkey as k, max(l_extendedprice) as v from lineitem group by 1) select * from n union all select o_orderkey, o_totalprice from orders where o_orderkey not in (select k from n)",
    "insert_or_ignore": "select c_custkey as k, c_name as name from customer union all select s_suppkey * 3, s_name from supplier where s_suppkey * 3 not in (select c_custkey from customer)",
    "export_join": "select o_orderkey, c_name, n_name, o_totalprice from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where c_mktsegment <> 'MACHINERY'",
    "checkpoint_validate": " union all ".join(f"select '{n}' as name, count(*) as n_rows, count(distinct {k}) as n_keys, case when count(*) = count(distinct {k}) and count(*) = count({k}) then 'PASS' else 'FAIL' end as verdict from {n}" for n, k in (("documents", "doc_id"), ("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_partkey")))
    + "".join(f" union all select '{n}', count(*), count(*) filter (a is null or b is null), case when count(*) filter (a is null or b is null) = 0 then 'PASS' else 'FAIL' end from (select distinct {k} as k, 1 as a from {l}) full join (select distinct {o} as k, 1 as b from {r}) using (k)" for n, l, r, k, o in (("orders-lineitem", "orders", "lineitem", "o_orderkey", "l_orderkey"), ("documents-labels", "documents", "labels", "doc_id", "doc_id")))
    + " union all select 'known-events', count(*), count(*) filter (event_type not in ('view', 'click', 'signup', 'purchase', 'error')), case when count(*) filter (event_type not in ('view', 'click', 'signup', 'purchase', 'error')) = 0 then 'PASS' else 'FAIL' end from events"
    + f" union all select 'failures-classed', count(*), count(*) filter (starts_with(failure, 'other:') or failure in ('', 'unknown')), case when count(*) filter (starts_with(failure, 'other:') or failure in ('', 'unknown')) = 0 then 'PASS' else 'FAIL' end from ({LEDGER_SQL}) where state = 'parsing-failed'",
    "multiset_diff": "with l as (select doc_id, unnest(string_split(text, chr(10))) as line from documents), a as (select doc_id, line, count(*) as na from l group by all), b as (select doc_id + 1 as doc_id, line, count(*) as nb from l group by all) select doc_id, sum(greatest(na - coalesce(nb, 0), 0))::bigint as added from a left join b using (doc_id, line) group by 1 having added > 0",
    "sha_verify": "select doc_id, sha256(text) as sha256, strlen(text) as bytes, length(text) = n_chars as length_ok, doc_id % 50 <> 0 as verified from documents",
    "decade_histogram": "select (year(o_orderdate) // 10) * 10 as decade, count(*) as n from orders group by 1",
    "group_size_histogram": "select size, count(*) as keys from (select count(*) as size from orders group by o_custkey) group by 1",
    "top_counter": "select p_brand, count(*) as n from lineitem join part on l_partkey = p_partkey group by 1 order by n desc, p_brand limit 25",
    "batch_numbering": "select c_custkey, (row_number() over (order by c_custkey) - 1) // 1000 as batch from customer",
    "rolling_fail_rate": "select event_id, round(avg((event_type = 'error')::int) over w, 6) as rate, count(*) over w = 50 and avg((event_type = 'error')::int) over w > 3e-1 as stop from events window w as (partition by user_id order by ts, event_id rows 49 preceding)",
    "failure_streaks": f"with x as (select user_id, event_id, ts, event_type = 'error' as bad, sum((event_type <> 'error')::int) over (partition by user_id order by ts, event_id) as g from events), s as (select *, row_number() over (partition by user_id, g order by ts, event_id) as streak from x where bad) select user_id, max(streak) as longest, arg_min(event_id, (ts, event_id)) filter (streak = {BREAKER}) as stop_event from s group by 1",
    "union_feeds": "with u as (select sha256(text) as h, doc_id, lang, source, 0 as feed from documents where doc_id % 3 < 2 union all select sha256(text), doc_id, lang, source, 1 from documents where doc_id % 3 > 0) select * from u qualify row_number() over (partition by h order by feed, doc_id) = 1",
    "latest_state": "select user_id, arg_max(event_type, (ts, event_id)) as state, count(*) as n from events group by 1",
    "status_tallies": "select event_type, count(*) as n, count(*) filter (value > 50) as high, count(distinct user_id) as users from events group by 1",
    "union_top_keys": "with w as (select lang, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) as w from documents), c as (select lang, w, count(*) as n from w group by all), r as (select w, lang, row_number() over (partition by lang order by n desc, w) as k from c qualify k <= 25), f as (select w, min(struct_pack(lang := lang, r := k)) as o from r group by 1) select w, o.lang as lang, o.r as o from f order by o.lang, o.r limit 25",
}
QUERIES = {n: globals()[n] for n in [*ORACLES, "seeded_sample_sources"]}
