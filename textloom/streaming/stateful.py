"""Streams with state per key: rows are put in time order behind the watermark, then read one by one with a small state in mind."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


GROUPS = 256  # of keys; a checkpoint's state is kept by them, so their number is fixed


def packed(frame: pa.Table) -> bytes:
    with pa.BufferOutputStream() as sink:
        with pa.ipc.new_stream(sink, frame.schema) as writer:
            writer.write_table(frame)
        return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


class InOrder(StatefulProcessor):
    """Holds rows until the watermark has passed them, then gives those of each key in order of (time, tie) to `step`.

    step(state, row) -> (state, outputs), where state is a tuple or None and row a tuple of (micros, tie, *columns). `until(state)` is the time in
    micros from which a state is of no more use, or None if it always is; it is dropped when the watermark has passed that time.

    Spark calls a processor once a group of keys: a call for each key costs more than its rows, where keys are many. A group's rows wait as
    frames, one for each frame that comes, and the states of its keys are one frame, so a batch costs a few calls a group.
    """

    def __init__(self, key: T.StructType, row: T.StructType, state: T.StructType, out: T.StructType, step: Callable, until: Callable | None):
        self.key, self.row, self.state, self.out, self.step, self.until = key.names, row.names, state.names, out, step, until
        self.rows, self.states = to_arrow_schema(T.StructType([*key, *row])), to_arrow_schema(T.StructType([*key, *state]))

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "frame binary")
        self.known = handle.getValueState("known", "frame binary")
        self.done = {}  # a group's timers of a batch have one watermark: the first one does what there is to do

    def wake(self, micros: int) -> None:
        """A timer for the first watermark (it has milliseconds) that has passed a time."""
        self.handle.registerTimer(micros // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues):
        firsts = []
        for frame in rows if key[0] >= 0 else ():
            self.waiting.appendValue((packed(pa.Table.from_pandas(frame[self.rows.names], self.rows, preserve_index=False)),))
            firsts.append(int(frame["micros"].min()))
        if firsts:
            self.wake(min(firsts))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        if self.done.get(key) == passed:
            return
        self.done[key] = passed
        held = pa.concat_tables([self.rows.empty_table(), *(unpacked(r[0]) for r in self.waiting.get())]) if self.waiting.exists() else self.rows.empty_table()
        due, rest = held.filter(pc.field("micros") < passed), held.filter(pc.field("micros") >= passed)
        states = self.states_of(unpacked(self.known.get()[0]) if self.known.exists() else self.states.empty_table())
        out, before = [], len(states)
        for k, row in self.tuples(due.sort_by([("micros", "ascending"), (self.row[1], "ascending")]), self.row):
            states[k], made = self.step(states.get(k), row)
            out += [(*k, *m) for m in made]
        if len(due):
            self.waiting.put([(packed(rest),)]) if len(rest) else self.waiting.clear()
        states = {k: s for k, s in states.items() if s is not None and not self.over(s, passed)}
        if not states:
            self.known.clear()
        elif len(due) or len(states) < before:
            columns = zip(*((*k, *s) for k, s in states.items()))
            self.known.update((packed(pa.table([pa.array(c, f.type) for c, f in zip(columns, self.states)], schema=self.states)),))
        if len(rest):
            self.wake(pc.min(rest["micros"]).as_py())
        ends = [e for s in states.values() if (e := self.until(s)) is not None] if self.until else []
        if ends:
            self.wake(min(ends))
        if out:
            yield pd.DataFrame(dict(zip(self.out.names, (pd.Series(c, dtype=object) for c in zip(*out)))))

    def over(self, state: tuple, passed: int) -> bool:
        ends = self.until(state) if self.until else None
        return ends is not None and ends < passed

    def tuples(self, frame: pa.Table, columns: list[str]):
        """(key, the columns) of a frame's rows, as plain values."""
        return zip(*(zip(*(frame[c].to_pylist() for c in names)) for names in (self.key, columns)))

    def states_of(self, frame: pa.Table) -> dict:
        return dict(self.tuples(frame, self.state))

    def close(self) -> None:
        pass


def in_order(rows: DataFrame, key: list[str], ts: str, tie: str, columns: list[str], state: str, out: str, step: Callable, until: Callable | None = None, delay: str = "1 hour") -> DataFrame:
    """Outputs (key, out) of `step` over a stream's rows, each key's in time order.

    Rows may come late by `delay`; later ones are dropped, as everywhere behind a watermark. What has come but is not yet passed waits in the
    state, so a feed that ends is closed by a row of a later time without a tie (see `ended`). Keys, times and ties are not null.

    Keys are dealt over GROUPS groups by their hash. What a group's rows of one batch and of the delay take has to fit in a task, as do its keys' states.
    """
    types = {f.name: f.dataType for f in rows.schema}
    row = T.StructType([T.StructField("micros", T.LongType()), T.StructField(tie, types[tie]), *[T.StructField(c, types[c]) for c in columns]])
    keys = [T.StructField(k, types[k]) for k in key]
    made = T.StructType([*keys, *T._parse_datatype_string(out).fields])
    mark = F.col(tie).isNull()
    # A mark's whole numbers are filled, as pandas makes a column of them with a null a float; its group is dropped.
    filled = lambda c: (F.when(mark, F.lit(0).cast(types[c])).otherwise(F.col(c)) if isinstance(types[c], T.IntegralType) else F.col(c)).alias(c)
    group = F.when(mark, -1).otherwise(F.pmod(F.xxhash64(*key), F.lit(GROUPS)).cast("int"))
    x = rows.select(group.alias("_group"), *map(filled, key), ts, F.unix_micros(F.col(ts).cast("timestamp")).alias("micros"), *map(filled, [tie, *columns])).withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return x.groupBy("_group").transformWithStateInPandas(InOrder(T.StructType(keys), row, T._parse_datatype_string(state), made, step, until), made, "Append", "eventTime")


def run(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Takes in what is there and ends; each output row is in the files at `out` once, also after a failure and a new run with the same checkpoint."""
    spark = stream.sparkSession
    name, before = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set(name, ROCKS)
    try:
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
    finally:
        spark.conf.set(name, before)


FILE_ROWS = 500_000  # of a feed's file, where a slice has more


def fed(table: DataFrame, ts: str, path: str, slices: int = 3, closed: bool = True) -> int:
    """A table as the files of a feed: appended in slices of even time, oldest first, and closed by the mark of its end. Returns how many files each slice
    has, of whatever times in it, so that many are one batch of `feed`: one, or more where the least slice has FILE_ROWS rows for each; a slice without rows has none then."""
    spark = table.sparkSession
    lo, hi = table.agg(F.min(ts), F.max(ts)).first()
    files = 1
    if lo is not None:
        step = (hi - lo) / slices
        inside = [(F.col(ts) >= F.lit(lo + step * i)) & (F.col(ts) < F.lit(lo + step * (i + 1))) if i < slices - 1 else F.col(ts) >= F.lit(lo + step * i) for i in range(slices)]
        counts = table.agg(*[F.count_if(x).alias(f"n{i}") for i, x in enumerate(inside)]).first()
        files = max(1, min(n for n in counts if n) // FILE_ROWS)
        for x, n in zip(inside, counts):
            if files == 1:
                table.where(x).coalesce(1).write.mode("append").parquet(path)
            elif n:
                table.where(x).repartition(files).write.mode("append").parquet(path)
    if closed:
        ended(spark, table.schema, ts, hi, path)
    return files


def ended(spark: SparkSession, schema: T.StructType, ts: str, last, path: str) -> None:
    """Appends the mark of a feed's end: a row ten thousand days after the last one with nothing but a time."""
    last = last or pd.Timestamp("2000-01-01").to_pydatetime()
    row = spark.range(1).select(*[(F.lit(last) + F.expr("interval 10000 days")).cast(f.dataType).alias(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    row.write.mode("append").parquet(path)


def feed(spark: SparkSession, path: str, schema: T.StructType, files: int = 1) -> DataFrame:
    """The files of a feed as a stream, so many a batch, oldest first."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


# The rules themselves: a state, a row (micros, tie, columns) -> the next state and what goes out.

WINDOW, LIMIT, BREAKER = 50, 0.3, 50


def rolling_rate(state, row):
    """Failures among the last WINDOW rows, and whether a full window passes LIMIT. State: one character a row."""
    flags = ((state[0] if state else "") + ("1" if row[2] else "0"))[-WINDOW:]
    rate = flags.count("1") / len(flags)
    return (flags,), [(row[1], round(rate, 6), len(flags) == WINDOW and rate > LIMIT)]


def breaker(state, row):
    """The run of failures that lasts, the longest one, and the row at which work stops first. Goes out whenever the longest grows."""
    now, longest, stop = state or (0, 0, None)
    now = now + 1 if row[2] else 0
    if now <= longest:
        return (now, longest, stop), []
    stop = row[1] if now == BREAKER and stop is None else stop
    return (now, now, stop), [(now, stop)]


def latest(state, row):
    """The newest state of a key and how many there were; every change goes out."""
    n = (state[1] if state else 0) + 1
    return (row[2], n), [(row[2], n)]


def paused(state, row):
    """Rows let through: not within their pause (micros, the last column) of the last one let through. A row held back renews nothing."""
    if state is not None and row[0] < state[0] + row[-1]:
        return state, []
    return (row[0], row[-1]), [(row[1],)]


def pause_over(state) -> int:
    return state[0] + state[1]


def cached(state, row):
    """Each row with whether it is answered from the cache: its key was stored less than its time to live (micros, the last column) before. An answer renews nothing."""
    hit = state is not None and row[0] < state[0] + row[-1]
    return state if hit else (row[0], row[-1]), [(row[1], hit)]
