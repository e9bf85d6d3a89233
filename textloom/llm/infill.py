"""Fill-in-middle: a text is cut in prefix, middle and suffix by seeded draws and put in another order behind marks.

Cuts are counted in code points while texts are bytes. A sparse index of the exceptions holds, for each multibyte character of a batch,
its place and the bytes beyond one of all characters so far; searchsorted turns a cut in one unit into the other, and in the
spans of ASCII between exceptions both differ by a constant.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import arrow_schema, by_bytes, documents, keyed_text, slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 1
FORMED = 90  # of 100 texts that are cut
SUFFIX_FIRST = 20  # of 100 cut ones with the suffix first


class Exceptions:
    """The multibyte characters of a buffer of UTF-8: code points to bytes and back."""

    def __init__(self, buf: np.ndarray):
        self.bytes_at = np.flatnonzero(buf >= 0xC0)
        lead = buf[self.bytes_at]
        self.excess = np.concatenate(([0], np.cumsum(1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0))))
        self.points_at = self.bytes_at - self.excess[:-1]

    def points(self, places: np.ndarray) -> np.ndarray:
        """Code points before byte places that begin a character."""
        return places - self.excess[np.searchsorted(self.bytes_at, places)]

    def places(self, points: np.ndarray) -> np.ndarray:
        """Byte places of code points."""
        return points + self.excess[np.searchsorted(self.points_at, points)]


def draws(ids: list[int | None], seed: int = SEED) -> np.ndarray:
    """Four unsigned 32-bit numbers a document from the hash of `seed:doc_id`; a row without an id draws as one with an empty id."""
    digests = b"".join(hashlib.sha256(b"%d:%s" % (seed, b"" if i is None else b"%d" % i)).digest()[:16] for i in ids)
    return np.frombuffer(digests, ">u4").reshape(-1, 4).astype(np.int64)


def formed(ids: list[int | None], blobs: list[bytes], seed: int, share: int, first: int):
    """(n, form, prefix_chars, middle_chars, output) of each text of a batch."""
    whole = b"".join(blobs)
    index = Exceptions(np.frombuffer(whole, np.uint8))
    limits = np.concatenate(([0], np.cumsum([len(b) for b in blobs]))).astype(np.int64)
    starts = index.points(limits)
    n, h = np.diff(starts), draws(ids, seed)
    one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    a, b = index.places(starts[:-1] + low), index.places(starts[:-1] + high)
    for i, blob in enumerate(blobs):
        if not blob or h[i, 2] % 100 >= share or PREFIX in blob or SUFFIX in blob or MIDDLE in blob:
            yield int(n[i]), "plain", None, None, blob
            continue
        x, y = int(a[i] - limits[i]), int(b[i] - limits[i])
        prefix, suffix, middle = PREFIX + blob[:x], SUFFIX + blob[y:], MIDDLE + blob[x:y]
        chars = int(low[i]), int(high[i] - low[i])
        if h[i, 3] % 100 < first:
            yield int(n[i]), "spm", *chars, suffix + prefix + middle
        else:
            yield int(n[i]), "psm", *chars, prefix + suffix + middle


OUT = T.StructType(
    [T.StructField("doc_id", T.LongType())] + [T.StructField(c, t) for c, t in (("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()), ("output", T.BinaryType()))]
)


def transform(docs: DataFrame, text: str = "text", key: str = "doc_id", seed: int = SEED, share: int = FORMED, first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n (code points), form (plain, psm, spm), prefix_chars and middle_chars (null if plain) and the `output` text of each row.

    A null or empty text, and one that contains a mark, is plain: its output is the text. Rows that repeat an id and a text have equal
    results; a row without an id draws as one with an empty id. `share` of 100 texts are cut, `first` of 100 of these with the
    suffix first. An empty frame gives an empty result; other columns are left behind.
    """

    def run(batches):
        schema = arrow_schema(OUT)
        for batch in slices(batches):
            ids, blobs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in by_bytes(blobs):
                columns = zip(*formed(ids[i:j], blobs[i:j], seed, share, first))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids[i:j], *columns), schema)], schema=schema)

    return keyed_text(docs, text, key).mapInArrow(run, OUT).withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text of an output and its form. A text that was cut holds no mark, and no mark can arise where a part ends: its last character ends marks only."""
    parts = F.split(output, "<P>|<S>|<M>")
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: every text in its form, and rebuilt from it."""
    out = transform(documents(spark, sf_dir).select("doc_id", "text")).withColumn("restored", restored(F.col("output"), F.col("form")))
    digest = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digest)


ORACLE = """
with d as (select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n, sha256(concat('1:', doc_id)) as h from documents),
e as (select *, ('0x' || substr(h, 1, 8))::bigint % (n + 1) as u, ('0x' || substr(h, 9, 8))::bigint % (n + 1) as v,
  text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or ('0x' || substr(h, 17, 8))::bigint % 100 >= 90 as plain,
  ('0x' || substr(h, 25, 8))::bigint % 100 < 20 as turned from d),
f as (select doc_id, text, n, case when plain then 'plain' when turned then 'spm' else 'psm' end as form, least(u, v) as a, greatest(u, v) as b from e),
g as (select *, substr(text, 1, a) as p, substr(text, a + 1, b - a) as m, substr(text, b + 1) as s from f)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then concat('<P>', p, '<S>', s, '<M>', m) else concat('<S>', s, '<P>', p, '<M>', m) end) as output_sha256,
  sha256(text) as restored_sha256 from g
"""
