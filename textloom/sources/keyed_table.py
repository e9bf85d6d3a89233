"""A table of keyed rows that is changed batch by batch: each batch takes effect once and as a whole.

Rows are dealt over buckets by their key. A batch writes the buckets that it touches to a folder of its own and then commits by renaming one small
file into the ledger, which names the folders that hold each bucket. A batch whose number the ledger knows is left alone, so a replay changes nothing; one that stopped
before its commit is written anew over what it left. Readers see the last commit. A table has one
writer at a time, as a stream's checkpoint has.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators.keyed import first_by
from textloom.sources.folders import removed

IGNORE, REPLACE, RELOAD = "ignore", "replace", "reload"


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, key: list[str], buckets: int = 16):
        """schema: of the rows, in the order that they are kept in; buckets: as many as the table has from the first batch on."""
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        jvm = spark.sparkContext._jvm
        self._ledger = jvm.org.apache.hadoop.fs.Path(f"{path}/ledger")
        self._fs = self._ledger.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _entries(self) -> dict[int, tuple[int, str]]:
        """Batches that have taken effect, with their place in the ledger and their file. Names say it all; no file is opened."""
        if not self._fs.exists(self._ledger):
            return {}
        names = [s.getPath().getName() for s in self._fs.listStatus(self._ledger)]
        parts = [(n.split("."), n) for n in names if n.endswith(".json") and not n.startswith("_")]
        return {int(batch): (int(place), n) for (place, batch, _), n in parts}

    def commits(self) -> list[int]:
        """Numbers of the batches that have taken effect, in their order."""
        known = self._entries()
        return sorted(known, key=known.get)

    def _state(self) -> tuple[dict, int]:
        """Folders of each bucket after the last commit, and that commit's place (-1 before the first)."""
        known = self._entries()
        if not known:
            return {}, -1
        place, name = max(known.values())
        stream = self._fs.open(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._ledger, name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode()), place
        finally:
            stream.close()

    def _commit(self, batch: int, folders: dict, place: int) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        draft = path(self._ledger, f"_{batch}.draft")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(folders).encode()))
        out.close()
        if not self._fs.rename(draft, path(self._ledger, f"{place:012d}.{batch}.json")):
            raise RuntimeError(f"batch {batch} could not be committed")

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self) -> DataFrame:
        """All rows of the last commit."""
        folders, _ = self._state()
        return self._rows(sorted({f for fs in folders.values() for f in fs}))

    def merge(self, rows: DataFrame, batch: int, how: str = IGNORE, order: list[str] | None = None) -> bool:
        """Brings in a batch: IGNORE keeps the row that a key has, REPLACE takes the new one, RELOAD takes all rows of the batch's keys for all earlier ones.

        Of rows of one key in a batch the first by `order` counts (by all columns where none is named; columns after `-` run down), but for RELOAD.
        False if the batch has taken effect before. Only touched buckets are read, and for IGNORE none is written again. Rows with a null
        in the key are left out.
        """
        if batch in self.commits():
            return False
        folders, place = self._state()
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        new = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]).dropna(subset=self.key)
        if how != RELOAD:
            by = order or [f.name for f in self.schema if f.name not in self.key]
            new = first_by(new, self.key, [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in by] or [F.lit(0)])
        new = new.withColumn("_bucket", bucket)
        home = f"batch-{batch}"
        touched = [r._bucket for r in new.select("_bucket").distinct().collect()]  # at most as many as there are buckets
        old = self._rows(sorted({f for b in touched for f in folders.get(str(b), [])}))
        if how == IGNORE:
            new = new.join(old.select(*self.key), self.key, "left_anti")
        else:
            new = old.join(new.select(*self.key).distinct(), self.key, "left_anti").withColumn("_bucket", bucket).unionByName(new)
        new.select("_bucket", *self.schema.names).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/{home}")
        made = {b: f"{home}/_bucket={b}" for b in touched if self._fs.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{home}/_bucket={b}"))}
        then = dict(folders)
        for b in touched:
            kept = folders.get(str(b), []) if how == IGNORE else []
            then[str(b)] = kept + ([made[b]] if b in made else [])
        self._commit(batch, then, place + 1)
        return True

    def vacuum(self) -> int:
        """Takes away folders that the last commit doesn't name; for a time when nobody reads an earlier state. How many went."""
        folders, _ = self._state()
        used = {f for fs in folders.values() for f in fs}
        gone = 0
        for home in self._fs.listStatus(self._ledger.getParent()):
            name = home.getPath().getName()
            if not name.startswith("batch-"):
                continue
            for part in self._fs.listStatus(home.getPath()):
                if part.isDirectory() and f"{name}/{part.getPath().getName()}" not in used:
                    removed(self.spark, part.getPath().toString())
                    gone += 1
        return gone
