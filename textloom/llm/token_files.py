"""Token-ID output: documents in key order as files of range-coded blocks, and reading them back.

A file is a run of frames. A frame holds whole documents: their ids (doc_id and count),
its words of several token ids that are frequent (each is coded as one symbol), the head of its symbols and
their blocks, each block reset and checksummed on its own. The
frames of a range-partitioned, sorted frame of documents are written as binary rows
by Spark, so they reach any store that Spark writes, and a lost task writes its
frames again.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .range_coder import BLOCK, HEAD, LANES, Alphabet, decode_blocks, encode_blocks
from .shared import Scratch, arrow_schema, by_bytes, documents
from .words import piece_hashes

END = 2
FRAME = BLOCK * LANES
SLOTS, KEPT = 1 << 21, 1 << 24  # pieces that a Python worker remembers, and ids of them
MARK = re.compile("[\u0300-\u036f]")
CUT, SIGNS, ALNUM = (np.isin(np.arange(256), list(x)).astype(np.uint8) for x in (b" \n\t", b".,;:!?", b"abcdefghijklmnopqrstuvwxyz0123456789"))
LATIN = "\u0250"
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that vocabularies of bytes write as the character of that number; the others follow from 256 on
BYTES = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
FRONT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
MAGIC = b"TLI3"
OFTEN = 4  # times that a frame holds a word that is one symbol
COUNTERS = 21  # binary digits of a place in the table of a frame's words
_held: dict[str, object] = {}


def united(words: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Symbols of words (where each one's ids stand in `flat`, and how many they are, in one number): an id, or from a first number on a frequent
    word of several ids; those words' lengths and ids, and that first number. Of words that meet at one place of the table one is counted, the others stay ids."""
    start, count = (words >> np.uint64(32)).astype(np.int64), (words & np.uint64(2**32 - 1)).astype(np.int64)
    many = np.flatnonzero(count > 1)
    own = words[many]
    place = (own * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - COUNTERS)).astype(np.int64)
    held = np.zeros(1 << COUNTERS, np.uint64)
    held[place] = own
    same = held[place] == own
    chosen = np.flatnonzero(np.bincount(place[same], minlength=1 << COUNTERS) >= OFTEN)
    number = np.zeros(1 << COUNTERS, np.int32)
    number[chosen] = np.arange(1, len(chosen) + 1)
    unit = number[place] * same
    at = unit > 0
    size = count.copy()
    size[many[at]] = 1
    first = np.cumsum(size)
    total = int(first[-1]) if len(first) else 0
    first -= size
    out = np.zeros(total, np.int64)
    one = np.flatnonzero(count == 1)
    out[first[one]] = flat[start[one]]
    rest = many[~at]
    out[spread(first[rest], count[rest])] = flat[spread(start[rest], count[rest])]
    base = int(out.max()) + 1 if total else 0
    out[first[many[at]]] = unit[at].astype(np.int64) + (base - 1)
    length = (held[chosen] & np.uint64(2**32 - 1)).astype(np.int64)
    return out, length, flat[spread((held[chosen] >> np.uint64(32)).astype(np.int64), length)], base


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All places of the runs that begin at `start` and are `count` long."""
    upto = np.cumsum(count)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(start - upto + count, count)


def apart(symbols: np.ndarray, length: np.ndarray, ids: np.ndarray, base: int) -> np.ndarray:
    """The ids of symbols."""
    unit = np.flatnonzero(symbols >= base)
    size, which = np.ones(len(symbols), np.int64), symbols[unit].astype(np.int64) - base
    size[unit] = length[which]
    first = np.cumsum(size)
    out = np.empty(int(first[-1]) if len(first) else 0, "<u4")
    first -= size
    one = np.flatnonzero(symbols < base)
    out[first[one]] = symbols[one]
    begin = np.cumsum(length) - length
    out[spread(first[unit], size[unit])] = ids[spread(begin[which], size[unit])]
    return out


def pack(keys: list[int | None], sizes: list[int], words: np.ndarray, flat: np.ndarray, block: int = BLOCK) -> bytes:
    """One frame of documents: their keys (a null one is kept by a flag), how many ids each has, and all their words."""
    symbols, length, ids, base = united(words, flat)
    head, blocks = encode_blocks(symbols, block)
    tables = [zlib.compress(x.tobytes() if isinstance(x, np.ndarray) else x, 1) for x in (length.astype("<u4"), ids.astype("<u4"), head)]
    lead = np.array([len(keys), len(blocks), base, *map(len, tables)], "<u4").tobytes() + np.array([k or 0 for k in keys], "<i8").tobytes() + np.array([k is None for k in keys], np.uint8).tobytes()
    return MAGIC + lead + np.array(sizes, "<u4").tobytes() + b"".join(tables) + b"".join(blocks)


def unpack(frame: bytes) -> list[tuple[int | None, np.ndarray]]:
    if frame[:4] != MAGIC:
        raise ValueError("not a frame")
    n, m, base, *tables = map(int, np.frombuffer(frame, "<u4", 6, 4))
    at = 28
    keys, at = np.frombuffer(frame, "<i8", n, at), at + 8 * n
    null, at = np.frombuffer(frame, np.uint8, n, at), at + n
    sizes, at = np.frombuffer(frame, "<u4", n, at), at + 4 * n
    length, ids, head = (zlib.decompress(frame[at + sum(tables[:i]) : at + sum(tables[: i + 1])]) for i in range(3))
    at, blocks = at + sum(tables), []
    for _ in range(m):
        size = HEAD + int(np.frombuffer(frame, "<u4", 1, at + 4)[0])
        blocks.append(frame[at : at + size])
        at += size
    ids = apart(np.concatenate(decode_blocks(head, blocks)), np.frombuffer(length, "<u4").astype(np.int64), np.frombuffer(ids, "<u4"), base) if blocks else np.zeros(0, "<u4")
    cuts = np.cumsum(sizes)[:-1]
    return [(None if z else int(k), x) for k, z, x in zip(keys, null, np.split(ids, cuts))] if n else []


def tokenizer(path: str):
    """One tokenizer a Python worker, without threads of its own."""
    if path not in _held:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _held[path] = Tokenizer.from_file(path)
    return _held[path]


class _Known:
    """Ids of pieces, remembered by hash; one that isn't known is encoded by the library.

    A piece has one place in a table of SLOTS, by its hash, with the hash, its first eight bytes, and where its ids stand in one flat array and how
    many they are; a newer piece takes the place. `tidy` forgets all when half of KEPT ids are held, so a worker's memory has a bound: it is called
    between frames, as the words of one refer to the array.
    """

    def __init__(self, path: str):
        self.coder, self.model = tokenizer(path), tokenizer(path).model
        self.table = np.zeros((SLOTS, 3), np.uint64)
        self.flat, self.used = np.zeros(KEPT, np.uint32), 0

    def tidy(self) -> None:
        if self.used > KEPT // 2:
            self.table[:], self.used = 0, 0

    def put(self, ids: np.ndarray) -> int:
        """Where ids now stand."""
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(len(ids) + KEPT // 2, np.uint32)])
        at = self.used
        self.flat[at : at + len(ids)] = ids
        self.used += len(ids)
        return at

    def words(self, blobs: list[bytes]) -> list[np.ndarray]:
        """Words of texts whose A-Z may be lowered: where each one's ids stand, and how many they are."""
        whole = b"\n".join(blobs).lower() + b"\n" * 9
        buf, eights = np.frombuffer(whole, np.uint8), np.ndarray((len(whole) - 7,), "<u8", whole, strides=(1,))
        solid = CUT[buf] ^ 1
        edge = np.flatnonzero(np.diff(np.concatenate(([np.uint8(0)], solid, [np.uint8(0)]))))
        sign = np.flatnonzero(SIGNS[buf[1:-1]] & ALNUM[buf[:-2]] & CUT[buf[2:]]) + 1
        starts, ends = edge[::2], edge[1::2]
        if len(sign):
            starts, ends = np.sort(np.concatenate([starts, sign])), np.sort(np.concatenate([ends, sign]))
        if not len(starts):
            return [np.zeros(0, np.uint64)] * len(blobs)
        h, size = piece_hashes(eights, starts, ends), ends - starts
        front = eights[starts] & FRONT[np.minimum(size, 8)]
        at = (h & np.uint64(SLOTS - 1)).astype(np.int64)
        found = self.table[at]
        place, new = found[:, 2].copy(), np.flatnonzero((found[:, 0] != h) | (found[:, 1] != front))
        if len(new):
            _, first, back = np.unique(h[new], return_index=True, return_inverse=True)
            first = new[first]
            own = self.learn([whole[a : a + n].decode() for a, n in zip(starts[first].tolist(), size[first].tolist())])
            place[new] = own[back]
            self.table[at[first]] = np.stack([h[first], front[first], own], 1)
        return np.split(place, np.searchsorted(starts, np.cumsum([len(b) + 1 for b in blobs[:-1]])))

    def learn(self, pieces: list[str]) -> np.ndarray:
        """Where the ids of new pieces now stand, and how many they are, in one number each."""
        # Lower letters of ASCII and Latin, composed, are one match of the pattern, and the normalizer leaves them as they are.
        plain = [w.isalpha() and (w.isascii() or max(w) < LATIN and w == w.lower() and is_normalized("NFC", w)) for w in pieces]
        other = iter(self.coder.encode_batch([w for w, p in zip(pieces, plain) if not p], add_special_tokens=False))
        got = [[x.id for x in self.model.tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(BYTES))] if p else next(other).ids for w, p in zip(pieces, plain)]
        count = np.array([len(x) for x in got], np.int64)
        at = self.put(np.fromiter(chain.from_iterable(got), np.uint32, int(count.sum())))
        return (at + np.cumsum(count) - count << 32 | count).astype(np.uint64)


def known(path: str) -> _Known:
    """What a Python worker remembers of a vocabulary."""
    return _held.get(path + "#words") or _held.setdefault(path + "#words", _Known(path))


def text_words(texts: list[str], memory: _Known) -> list[np.ndarray]:
    """Words of each whole text, as places of their ids in the memory.

    The vocabulary encodes pieces on their own: its normalizer joins nothing across a space, line feed or tab, its pattern matches none of these, and its special
    tokens hold none. It lower-cases, so A-Z are lowered here, except beside combining marks (a lower letter may compose
    with one where the upper one doesn't) and where a special token may stand: such texts go to the library whole, and each of their ids is a word. A sign after a letter or digit and
    before a cut begins a match of its own, so it is a piece.
    """
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
    plain, blobs = [], []
    for i, text in enumerate(texts):
        blob = text.encode()
        if b"<|" in blob or (b"\xcc" in blob or b"\xcd" in blob) and MARK.search(text):
            ids = np.array(memory.coder.encode(text, add_special_tokens=False).ids, np.uint32)
            out[i] = (memory.put(ids) + np.arange(len(ids)) << 32 | 1).astype(np.uint64)
        else:
            plain.append(i)
            blobs.append(blob)
    for a, b in by_bytes(blobs):
        for i, words in zip(plain[a:b], memory.words(blobs[a:b])):
            out[i] = words
    return out


def encode(texts: list[str], path: str) -> list[np.ndarray]:
    """Token ids of each whole text, from those of its pieces."""
    memory = known(path)
    memory.tidy()
    return [memory.flat[spread((w >> np.uint64(32)).astype(np.int64), (w & np.uint64(2**32 - 1)).astype(np.int64))] for w in text_words(texts, memory)]


def write(docs: DataFrame, vocabulary: str, scratch: Scratch, name: str = "ids", end: int = END, parts: int | None = None, frame_ids: int = FRAME) -> DataFrame:
    """(part, frame, n_ids, data): the files' frames, in ascending (doc_id, text) order over part and frame.

    A null or empty text is the end id alone. Rows with the same doc_id are written each, in the order of their texts.
    An empty table writes no frame.
    """
    n = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    out = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("frame", T.IntegerType()), T.StructField("n_ids", T.LongType()), T.StructField("data", T.BinaryType())])

    def run(batches):
        schema, part, memory = arrow_schema(out), TaskContext.get().partitionId(), known(vocabulary)
        keys, sizes, words, count, frame = [], [], [], 0, 0

        def tail():
            memory.tidy()
            return np.array([memory.put(np.array([end])) << 32 | 1], np.uint64)

        def flush():
            data = pack(keys, sizes, np.concatenate(words), memory.flat)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([frame], pa.int32()), pa.array([count], pa.int64()), pa.array([data], pa.binary())], schema=schema)

        last = tail()
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                some = batch.slice(a, 512).to_pydict()
                for b, c in by_bytes(some["text"], min(1 << 20, frame_ids)):
                    for key, own in zip(some["doc_id"][b:c], text_words(some["text"][b:c], memory)):
                        keys.append(key)
                        words += [own, last]
                        sizes.append(int((own & np.uint64(2**32 - 1)).sum()) + 1)
                        count += sizes[-1]
                    if count >= frame_ids:
                        yield flush()
                        keys, sizes, words, count, frame, last = [], [], [], 0, frame + 1, tail()
        if keys:
            yield flush()

    return scratch.table(rows.mapInArrow(run, out), name)


def read(frames: DataFrame) -> DataFrame:
    """Per document, from the stored frames: part, frame, doc_id, first (ids before it in the frame), n_tokens, ids_crc32."""
    names = ["part", "frame", "doc_id", "first", "n_tokens", "ids_crc32"]
    out = T.StructType([T.StructField(n, T.IntegerType() if n in ("part", "frame") else T.LongType()) for n in names])

    def run(batches):
        schema = arrow_schema(out)
        for batch in batches:
            for i in range(batch.num_rows):
                part, frame, data = (batch.column(c)[i].as_py() for c in ("part", "frame", "data"))
                docs = unpack(data)
                sizes = [len(x) for _, x in docs]
                first = np.cumsum([0, *sizes])[:-1]
                crc = [zlib.crc32(np.ascontiguousarray(x, "<u4").tobytes()) for _, x in docs]
                columns = [[part] * len(docs), [frame] * len(docs), [k for k, _ in docs], first, sizes, crc]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return frames.select("part", "frame", "data").mapInArrow(run, out)


def placed(frames: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of the stored documents, read from the frames."""
    order = Window.partitionBy(F.lit(0)).orderBy("part", "frame")  # one row for millions of ids
    starts = frames.select("part", "frame", (F.sum("n_ids").over(order) - F.col("n_ids")).alias("before"))
    return read(frames).join(starts, ["part", "frame"]).select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: all documents written as token files and read back, with each one's place in the whole."""
    import public_tokenizers

    return placed(write(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), Scratch(spark, "tokens")))
