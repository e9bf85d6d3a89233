"""Every sink and source on the tables: written, read back, compared with what was written."""

from __future__ import annotations

import sqlite3

from pyspark.sql import functions as F

from textloom.operators import lint
from textloom.sources import database, folders, readers, sinks
from textloom.sources.keyed_table import RELOAD, KeyedTable


def t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sum(df, name):
    """Rows and a sum of hashes that tells two frames apart whatever their order."""
    return df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.pmod(F.xxhash64(*sorted(df.columns)), F.lit(1 << 40))), F.lit(0)).alias("h")).select(F.lit(name).alias("sink"), "n", "h")


def sink_roundtrip(spark, d):
    """Each sink with its rows, and whether reading it back gave what was written."""
    base = folders.shared_folder(spark)
    docs = t(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    texts = t(spark, d, "documents").select("doc_id", "text")
    pairs = []
    sinks.append_json(docs.where("doc_id % 2 = 0"), f"{base}/json")
    sinks.append_json(docs.where("doc_id % 2 = 1"), f"{base}/json")
    pairs.append(("json-append", docs, readers.json_lines(spark, f"{base}/json", docs.schema)))
    readers.write_rows(texts, f"{base}/rows", 100)
    pairs.append(("row-shards", texts, spark.read.parquet(f"{base}/rows")))
    sinks.write_slices(docs, "doc_id", 64, f"{base}/slices")
    pairs.append(("slices", docs, spark.read.parquet(f"{base}/slices").drop("slice")))
    docs.write.option("sep", "\t").option("quote", "").csv(f"{base}/tab")
    pairs.append(("tab-rows", docs.select(*[F.col(c).cast("string").alias(c) for c in docs.columns]), readers.tab_rows(spark, f"{base}/tab", docs.columns)))
    texts.select(F.to_json(F.struct("doc_id")).alias("value")).write.text(f"{base}/text")
    pairs.append(("whole-texts", texts.agg(F.count("*").alias("n")), readers.whole_texts(spark, f"{base}/text").select(F.explode(F.split(F.btrim("text", F.lit("\n")), "\n")).alias("x")).where("x <> ''").agg(F.count("*").alias("n"))))
    files = readers.blobs(spark, f"{base}/rows/*.parquet")
    pairs.append(("blobs", files.select("sha256"), files.select(F.sha2("data", 256).alias("sha256"))))
    docs.write.option("rowTag", "record").option("rootTag", "l").format("xml").save(f"{base}/xml")
    pairs.append(("xml-records", docs, readers.records(spark, f"{base}/xml", "record", "doc_id long, lang string, source string, n_chars long")))
    docs.createOrReplaceTempView("textloom_docs")
    pairs.append(("sql", docs.where("lang = 'en'"), spark.sql("select * from textloom_docs where lang = 'en'")))
    old, new = docs.where("doc_id % 3 < 2"), docs.where("doc_id % 3 > 0").withColumn("n_chars", F.col("n_chars") + 1)
    pairs.append(("first-wins", docs.withColumn("n_chars", F.when(F.col("doc_id") % 3 == 2, F.col("n_chars") + 1).otherwise(F.col("n_chars"))), sinks.merged(old, new, "doc_id", False)))
    pairs.append(("last-wins", docs.withColumn("n_chars", F.when(F.col("doc_id") % 3 > 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))), sinks.merged(old, new, "doc_id", True)))
    papers = KeyedTable(spark, f"{base}/papers", docs.schema, ["doc_id"])
    for n, part in enumerate((docs.where("doc_id % 2 = 0").withColumn("n_chars", F.lit(-1).cast("long")), docs, docs.where("doc_id % 5 = 0"), docs.where("doc_id % 5 = 0"))):
        papers.merge(part, n, RELOAD)
    pairs.append(("reload", docs, papers.read()))
    out = None
    for name, want, got in pairs:
        both = _sum(want.select(sorted(want.columns)), name).join(_sum(got.select(sorted(got.columns)), name).withColumnsRenamed({"n": "_n", "h": "_h"}), "sink").select("sink", "n", (F.col("n").eqNullSafe(F.col("_n")) & F.col("h").eqNullSafe(F.col("_h"))).alias("same"))
        out = both if out is None else out.unionByName(both)
    return out


def database_scan(spark, d):
    """Customers as statements of fifty rows, brought into a database file and scanned by partitions with filters on its columns."""
    base = folders.shared_folder(spark)
    rows = t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", F.col("c_acctbal").cast("double").alias("c_acctbal"))
    database.write_statements(rows, f"{base}/sql", "customer")
    path = f"{base}/customer.db"
    with sqlite3.connect(database.local(path)) as db:
        db.execute("create table customer (c_custkey integer primary key, c_name text, c_nationkey int, c_mktsegment text, c_acctbal double)")
    database.applied(f"{base}/sql", path)
    return database.scan(spark, path, "customer").where("c_acctbal > 0 and c_mktsegment in ('BUILDING', 'MACHINERY') and c_nationkey is not null").select("c_custkey", "c_name", "c_acctbal")


def report_table(spark, d):
    """Documents by language and source kind as a Markdown table."""
    g = t(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))
    return sinks.pipe_table(g, ["lang"])


def yaml_rules(spark, d):
    """Rules written from the passages as YAML files of some rules each, and read again."""
    word = lambda i, n: F.array_join(F.slice(F.split(F.regexp_replace("text", r"[:\s]+", " "), " "), i, n), " ")
    rule = F.concat(F.col("item_id").cast("string"), F.lit(":\n  project: x\n  section: results\n  before: p "), word(1, 3), F.lit("\n  after: null\n  judgement: >-\n    j "), word(4, 4), F.lit("\n    "), word(8, 3), F.lit("\n  lesson: \"l "), word(11, 5), F.lit("\"\n"))
    files = t(spark, d, "benchmark").select((F.col("item_id") % 8).alias("file"), rule.alias("rule")).groupBy("file").agg(F.concat(F.lit("# rules\n"), F.array_join(F.array_sort(F.collect_list("rule")), "")).alias("text"))
    return lint.read_rules(files).select("id", "section", "before", "after", "judgement", "lesson", "instruction")


_WORD = lambda i, n: f"array_to_string(string_split(regexp_replace(text, '[:\\s]+', ' ', 'g'), ' ')[{i}:{i + n - 1}], ' ')"
ORACLES = {
    "database_scan": "select c_custkey, c_name, c_acctbal::double as c_acctbal from customer where c_acctbal > 0 and c_mktsegment in ('BUILDING', 'MACHINERY')",
    "yaml_rules": f"with x as (select item_id as id, 'results' as section, trim('p ' || {_WORD(1, 3)}) as before, null::varchar as after, trim('j ' || {_WORD(4, 4)}) || ' ' || {_WORD(8, 3)} as judgement, 'l ' || {_WORD(11, 5)} as lesson from benchmark) select *, concat_ws(chr(10) || chr(10), trim(lesson), 'Learned from the results section.', 'The calibrated edit this rule was distilled from:' || chr(10) || 'Before: ' || before, 'The expert''s comment: ' || trim(judgement)) as instruction from x",
    "report_table": "select concat('| lang | n | chars |', chr(10), '| --- | --- | --- |', chr(10), string_agg(concat('| ', lang, ' | ', n, ' | ', chars, ' |'), chr(10) order by lang)) as \"table\" from (select lang, count(*) as n, sum(n_chars)::bigint as chars from documents group by 1)",
}
QUERIES = {n: globals()[n] for n in [*ORACLES, "sink_roundtrip"]}
