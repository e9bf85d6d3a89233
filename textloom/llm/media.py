"""Media columns: stored media, and a sniffer that says what bytes really are.

One Aho-Corasick pass over the bytes locates the magic numbers of the known
formats, and the marks that end some of them. At each magic number the format's validator walks the structure and yields the
length, or rejects it (a text may hold magic bytes by chance). End marks are looked up by bisection, and ways through
blocks that several magic numbers lead to are walked once, so a text full of magic numbers takes linear time. The format
that holds at place 0 corrects the declared type, whatever follows it; others that hold inside are embedded media
and can be carved out.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from bisect import bisect_left

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Scratch, arrow_schema, by_bytes, documents, in_batches, keyed_text, slices

ROW = 576
RATE = 8000


# ---- writing and reading -------------------------------------------------

def payload(text: bytes) -> bytes:
    """The text, with bytes 255 up to a positive multiple of 576."""
    return text + b"\xff" * (ROW - len(text) % ROW if len(text) % ROW or not text else 0)


def to_wav(data: bytes, cover: bytes = b"") -> bytes:
    """One channel of unsigned 8-bit samples; a cover image has a chunk of its own after them. A chunk of odd size gets the pad byte that chunks need."""
    tail = struct.pack("<4sI", b"covr", len(cover)) + cover + b"\0" * (len(cover) & 1) if cover else b""
    pad = len(data) & 1
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(data) + pad + len(tail), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(data))
    return head + data + b"\0" * pad + tail


def to_png(data: bytes, width: int = ROW) -> bytes:
    """Grey 8-bit rows of `width` samples, each with filter 0."""
    height = len(data) // width
    rows = b"".join(b"\0" + data[i * width : (i + 1) * width] for i in range(height))

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows, 1)) + chunk(b"IEND", b"")


def chunks_of(blob: bytes, kind: str):
    """(name, start, size) of the chunks of a RIFF or PNG file."""
    at = 12 if kind == "audio/wav" else 8
    while at + 8 <= len(blob):
        if kind == "audio/wav":
            name, size = blob[at : at + 4], struct.unpack_from("<I", blob, at + 4)[0]
            yield name, at + 8, size
            at += 8 + size + (size & 1)
        else:
            size, name = struct.unpack_from(">I4s", blob, at)
            yield name, at + 8, size
            at += 12 + size


def samples(blob: bytes, kind: str) -> bytes:
    """The 8-bit samples of a stored WAV or PNG (grey, filter 0)."""
    if kind == "audio/wav":
        return next(blob[a : a + n] for name, a, n in chunks_of(blob, kind) if name == b"data")
    width, body = 0, []
    for name, a, n in chunks_of(blob, kind):
        if name == b"IHDR":
            width = struct.unpack_from(">I", blob, a)[0]
        elif name == b"IDAT":
            body.append(blob[a : a + n])
    rows = zlib.decompress(b"".join(body))
    return b"".join(rows[i + 1 : i + 1 + width] for i in range(0, len(rows), width + 1))


# ---- validators: (blob, start, places of end marks) -> length, or 0 ---------------------------

def _chunk_tree(b: bytes) -> tuple[dict, dict, dict]:
    """(number, size, counts) of the chunk places that RIFF heads lead to; a chunk's parent is the one after it.

    Heads lead to common places, so each is read once. `number` is in preorder: place t follows place p if number[t] <= number[p] < number[t] + size[t];
    counts: `fmt ` and `data` chunks from a place to the end of its way.
    """
    after: dict[int, int] = {}
    for m in re.finditer(rb"(?s)RIFF(?=.{4}WAVE)", b):
        at = m.start() + 12
        while at not in after and at + 8 <= len(b):
            n = struct.unpack_from("<I", b, at + 4)[0]
            after[at] = at + 8 + n + (n & 1)
            at = after[at]
        after.setdefault(at, -1)
    places = sorted(after)
    size = dict.fromkeys(places, 1)
    for at in places:
        if after[at] >= 0:
            size[after[at]] += size[at]
    number, free, counts, roots = {}, {}, {}, 0
    for at in reversed(places):
        up = after[at]
        if up < 0:
            number[at], roots = roots, roots + size[at]
            counts[at] = (0, 0)
        else:
            number[at] = free[up]
            free[up] += size[at]
            f, d = counts[up]
            counts[at] = (f + (b[at : at + 4] == b"fmt "), d + (b[at : at + 4] == b"data"))
        free[at] = number[at] + 1
    return number, size, counts


def _wav(b: bytes, s: int, marks: dict) -> int:
    """Chunks from the head must end where its length says, and hold a format and data."""
    if len(b) < s + 44 or b[s + 8 : s + 12] != b"WAVE":
        return 0
    size = struct.unpack_from("<I", b, s + 4)[0] + 8
    if "riff" not in marks:
        marks["riff"] = _chunk_tree(b)
    number, under, counts = marks["riff"]
    at, end = s + 12, s + size
    if end > len(b) or end not in number or not number[end] <= number[at] < number[end] + under[end]:
        return 0
    return size if all(x > y for x, y in zip(counts[at], counts[end])) else 0


def _walked(marks: dict, kind: str, state: int, step) -> int:
    """The end of the way that step(state) -> next state or ~end or None leads along, 0 if it leads nowhere. Heads lead to common states: each is stepped once."""
    known, way = marks.setdefault(kind, {}), []
    while state not in known:
        way.append(state)
        new = step(state)
        if new is None or new < 0:
            known[state] = 0 if new is None else ~new
            break
        state = new
    end = known[state]
    known.update(dict.fromkeys(way, end))
    return end


def _png(b: bytes, s: int, marks: dict) -> int:
    """Chunks with right checksums, the head's first, up to the end's. A state is the place of a chunk."""

    def step(at: int) -> int | None:
        if at + 12 > len(b):
            return None
        n, name = struct.unpack_from(">I4s", b, at)
        if at + 12 + n > len(b) or struct.unpack_from(">I", b, at + 8 + n)[0] != zlib.crc32(view[at + 4 : at + 8 + n]):
            return None
        return ~(at + 12 + n) if name == b"IEND" else at + 12 + n

    view = memoryview(b)
    return max(0, _walked(marks, "png", s + 8, step) - s) if b[s + 8 : s + 16] == b"\0\0\0\rIHDR" else 0


def _gif(b: bytes, s: int, marks: dict) -> int:
    """Blocks up to the trailer. A state is twice the place of a block, and one more inside its pieces."""
    if len(b) < s + 14 or b[s + 3 : s + 6] not in (b"87a", b"89a"):
        return 0

    def step(state: int) -> int | None:
        at, inside = state >> 1, state & 1
        if at >= len(b):
            return None
        if inside:
            return at + 1 + b[at] << 1 | 1 if b[at] else at + 1 << 1
        if b[at] == 0x3B:
            return ~(at + 1)
        if b[at] == 0x21:
            return at + 2 << 1 | 1
        if b[at] == 0x2C and at + 10 < len(b):
            return at + 11 + (3 << (b[at + 9] & 7) + 1 if b[at + 9] & 128 else 0) << 1 | 1
        return None

    first = s + 13 + (3 << (b[s + 10] & 7) + 1 if b[s + 10] & 128 else 0)
    return max(0, _walked(marks, "gif", first << 1, step) - s)


def _jpeg(b: bytes, s: int, marks: dict) -> int:
    """Segments up to the end mark. A state is twice the place of a segment, and one more in the scan that follows one."""
    if "ff" not in marks:
        marks["ff"] = [m.start() for m in re.finditer(b"\xff", b)]
    escapes = marks["ff"]

    def step(state: int) -> int | None:
        at, scan = state >> 1, state & 1
        if scan:
            i = bisect_left(escapes, at)
            if i == len(escapes) or escapes[i] + 1 >= len(b):
                return None
            at = escapes[i]
            kind = b[at + 1]
            return ~(at + 2) if kind == 0xD9 else at + 2 << 1 | 1 if not kind or 0xD0 <= kind <= 0xD7 else at << 1
        if at + 4 > len(b) or b[at] != 0xFF:
            return None
        n = struct.unpack_from(">H", b, at + 2)[0]
        return None if n < 2 else at + 2 + n << 1 | (b[at + 1] == 0xDA)

    return max(0, _walked(marks, "jpeg", s + 2 << 1, step) - s)


def _bmp(b: bytes, s: int, marks: dict) -> int:
    if len(b) < s + 54:
        return 0
    size, _, data, head, width, height, planes, bits = struct.unpack_from("<IIIIiiHH", b, s + 2)
    need = data + (abs(width) * bits + 31) // 32 * 4 * abs(height)
    return size if head >= 40 and planes == 1 and bits in (1, 4, 8, 16, 24, 32) and 54 <= data and width > 0 and need <= size <= len(b) - s else 0


def _within(places: list[int], low: int, high: int) -> int:
    """The last of the sorted places in [low, high), or -1."""
    i = bisect_left(places, high) - 1
    return places[i] if i >= 0 and places[i] >= low else -1


def _pdf(b: bytes, s: int, marks: dict) -> int:
    """Up to the last end mark before the next file's head: a file that was added to has several."""
    heads = marks[b"%PDF-"]
    i = bisect_left(heads, s + 1)
    end = _within(marks[b"%%EOF"], s, heads[i] if i < len(heads) else len(b))
    return end + 5 - s if end >= 0 and _within(marks[b"startxref"], s, end) >= 0 else 0


def _zip(b: bytes, s: int, marks: dict) -> int:
    """The end record that says that its file begins here."""
    if "zip" not in marks:
        marks["zip"] = {}
        for end in marks[b"PK\x05\x06"]:
            if end + 22 <= len(b):
                size, start, note = struct.unpack_from("<IIH", b, end + 12)
                if end + 22 + note <= len(b):
                    marks["zip"][end - size - start] = end + 22 + note
    return marks["zip"].get(s, s) - s


def _gzip(b: bytes, s: int, marks: dict) -> int:
    if len(b) < s + 18 or b[s + 3] & 0xE0:
        return 0
    try:
        d, at, view = zlib.decompressobj(31), s, memoryview(b)
        while not d.eof and at < len(b):
            piece = view[at : at + (1 << 14)]
            at += len(piece)
            while len(piece) and not d.eof:
                d.decompress(piece, 1 << 16)
                piece = d.unconsumed_tail
        return at - s - len(d.unused_data) if d.eof else 0
    except zlib.error:
        return 0


#: Magic bytes, media type, validator.
MAGIC = [
    (b"RIFF", "audio/wav", _wav),
    (b"\x89PNG\r\n\x1a\n", "image/png", _png),
    (b"GIF8", "image/gif", _gif),
    (b"\xff\xd8\xff", "image/jpeg", _jpeg),
    (b"BM", "image/bmp", _bmp),
    (b"%PDF-", "application/pdf", _pdf),
    (b"PK\x03\x04", "application/zip", _zip),
    (b"\x1f\x8b\x08", "application/gzip", _gzip),
]
#: Marks that stand in or at the end of files.
ENDS = [b"%%EOF", b"startxref", b"PK\x05\x06"]
_auto = None


def sniff(blob: bytes) -> list[tuple[int, int, str]]:
    """(start, length, type) of the media that hold, sorted: one at place 0, and of those inside it or behind it the outermost. An empty blob has none."""
    global _auto
    if _auto is None:
        _auto = ahocorasick.Automaton()
        for magic, kind, check in MAGIC:
            _auto.add_word(magic.decode("latin-1"), (magic, kind, check))
        for mark in ENDS:
            _auto.add_word(mark.decode("latin-1"), (mark, None, None))
        _auto.make_automaton()
    marks: dict = {m: [] for m in (*ENDS, b"%PDF-")}
    hits = []
    for end, (magic, kind, check) in _auto.iter(blob.decode("latin-1")):
        start = end - len(magic) + 1
        if magic in marks:
            marks[magic].append(start)
        if kind:
            hits.append((start, kind, check))
    found, upto = [], 0
    for start, kind, check in sorted(hits, key=lambda h: h[:2]):
        if start >= upto and (size := check(blob, start, marks)):
            found.append((start, size, kind))
            if start:
                upto = start + size
    return found


#: What stored files are declared as, by two bits of their checksum.
DECLARED = ["image/png", "audio/wav", "text/plain", "application/octet-stream"]


def carve(blob: bytes, found: list | None = None) -> list[tuple[str, bytes]]:
    """Embedded media: those that hold at another place than 0. found: what sniff() said, where it is known."""
    return [(kind, blob[s : s + n]) for s, n, kind in (sniff(blob) if found is None else found) if s]


def store(text: bytes) -> tuple[str, bytes]:
    """(declared type, file). The form follows from the payload's checksum: PNG where it is even, else WAV with its first row as a PNG cover. What is
    declared follows from it too, as types in the wild do: one row in four is right, others name the other form, text or nothing.
    """
    data = payload(text)
    check = zlib.crc32(data)
    blob = to_wav(data, to_png(data[:ROW])) if check & 1 else to_png(data)
    return DECLARED[check >> 1 & 3], blob


def media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, declared, media) of a (doc_id, text) frame; n_bytes: of the text."""
    out = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("declared", T.StringType()), T.StructField("media", T.BinaryType())])
    return in_batches(keyed_text(docs), out, lambda ids, blobs: [ids, list(map(len, blobs)), *map(list, zip(*map(store, blobs)))])


_TEXTS = ("payload_sha256", "media_sha256", "media_type", "feature", "carved_sha256")
LOOKED = [("payload_bytes", T.LongType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), *[(n, T.StringType()) for n in _TEXTS], ("n_embedded", T.LongType()), ("n_trailing", T.LongType())]


def inspect(frame: DataFrame) -> DataFrame:
    """A frame with `declared` and `media` columns, without the bytes and with what the sniffer found in them.

    media_type: the type that holds at the start of the bytes, or else the declared one; payload_*: of the 8-bit samples of a WAV or PNG, none of others; n_trailing: bytes
    after the file; carved_sha256: of all embedded media in a row, null without any. Null bytes count as none; rows that repeat and rows without a doc_id are looked at each.
    Other columns stay, those with the names of results are replaced. An empty frame gives an empty result.
    """
    added = [n for n, _ in LOOKED]
    held = [f for f in frame.schema.fields if f.name not in ("media", *added)]
    out = T.StructType(held + [T.StructField(n, t) for n, t in LOOKED])
    at = next(i for i, f in enumerate(held) if f.name == "declared")

    def run(batches):
        schema = arrow_schema(out)
        for batch in slices(batches, 64):
            declared, blobs = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            for a, b in by_bytes([x or b"" for x in blobs]):
                seen = [look(x or b"", d) for x, d in zip(blobs[a:b], declared[a:b])]
                own = batch.slice(a, b - a).columns[:-1]
                found = [pa.array(c, t) for c, t in zip(zip(*seen), schema.types[len(own) :])]
                yield pa.RecordBatch.from_arrays([*(c.cast(t) for c, t in zip(own, schema.types)), *found], schema=schema)

    return frame.select(*[F.col(f"`{f.name}`") for f in held], "media").mapInArrow(run, out)


def look(blob: bytes, declared: str | None = None) -> tuple:
    """The values of LOOKED of one file."""
    found = sniff(blob)
    size, kind = next(((n, k) for s, n, k in found if s == 0), (0, None))
    inside = carve(blob, found)
    data = samples(blob, kind) if kind in ("audio/wav", "image/png") else b""
    feature = f"{kind or 'unknown'};samples={len(data)};high={data.count(255)};space={data.count(32)};line={data.count(10)};embedded={','.join(sorted(k for k, _ in inside))}"
    carved = hashlib.sha256()
    for _, b in inside:
        carved.update(b)
    digests = hashlib.sha256(data).hexdigest(), hashlib.sha256(blob).hexdigest(), kind or declared, feature, carved.hexdigest() if inside else None
    return len(data), zlib.crc32(data[-32:]), len(blob), *digests, len(inside), len(blob) - size if kind else 0


def report(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Every whole text of (doc_id, text) stored as media in a table of the shared folder, read back through the sniffer.

    `declared_type` is what was stored with the bytes, `media_type` what they are, `corrected` where the two differ.
    A null text counts as an empty one. Repeated rows and rows without a doc_id have a row each. An empty frame gives an empty result.
    """
    seen = inspect(scratch.table(media(docs), "media"))
    return seen.withColumn("corrected", F.col("declared") != F.col("media_type")).withColumnRenamed("declared", "declared_type")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: the report of every document."""
    return report(documents(spark, sf_dir), Scratch(spark, "media"))
