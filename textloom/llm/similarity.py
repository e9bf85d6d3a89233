"""N-gram Jaccard join by token-combination prefixes, and the classes of its links.

Tokens are the hashes of a document's distinct word shingles, in one global order from rare to frequent by a
sketch of document frequencies. A set of n that misses at most e = n - ceil(t n) tokens of a similar one is indexed by
the shortest prefix of its order that e missing tokens can't clear of signatures: a rare token is one
by itself; frequent tokens fall into classes by hash, and any two of one class are one (so a class of m
tokens takes m - 1 missing ones). The number of classes follows the size of the set, which keeps combinations in
proportion to the prefix; a set near the limit of two numbers is indexed by both, so similar sets
always meet under one. Sets of at most TINY tokens have too few for combinations and are indexed by single tokens.

Documents with one and the same set are joined first and stand as one. In an
index list all members are compared with one hub, the document whose tokens
are the most frequent ones (of copies, mostly the original); so a list of n
gives n pairs. Lists that may be long are dealt in pieces with a hub each, and the hubs of the pieces are compared with the best of
them. Lists whose members are not yet in one class go on: short ones to every pair, longer ones to some more hubs and then, in blocks of
two pieces of a list, to every pair across classes that sizes, places and bitmaps of the sets allow. No pair that could join two
classes is left unverified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Scratch, arrow_schema, by_bytes, documents, keyed_text, near, slices
from .words import mix, shingle_sets

K = 4
NUMERATOR, DENOMINATOR = 85, 100
SKETCH_BITS = 20
FREQUENT = 32  # documents over the sketch's noise that make a token frequent
TINY = 10  # sets of so many tokens are indexed by single tokens
PIECE = 4096  # members of a list that are dealt as one piece, about
SHORT = 8  # members of a list whose pairs are all tried next
HUBS = 6  # more hubs of a longer list that has not come together
BLOCK = 256  # members of a list that are compared as one piece at last, about
SALT_ROWS = 400  # pairs of one hub that go to one task
_ONE, _TWO, _ALONE, _PAIR = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x5851F42D4C957F2D, 0x14057B7EF767814F))


def sets_of(docs: DataFrame, k: int, bits: int = SKETCH_BITS) -> DataFrame:
    """Per document its n_shingles, a 128-bit digest (a, b) and a 128-bit parity bitmap (p, q) of the set; and per partition, with `block` set,
    the document frequencies of all tokens in 2^bits counters, whose number is the same for every input."""
    names = [("doc_id", T.LongType()), ("n_shingles", T.LongType()), *[(c, T.LongType()) for c in "abpq"], ("block", T.IntegerType()), ("counts", T.BinaryType())]
    out = T.StructType([T.StructField(n, t) for n, t in names])
    blocks, size, low = 256, (1 << bits) // 256, np.uint64((1 << bits) - 1)

    def run(batches):
        schema, total = arrow_schema(out), np.zeros(1 << bits, np.int64)
        for batch in slices(batches):
            ids, blobs = batch.column("doc_id"), batch.column("text").to_pylist()
            for i, j in by_bytes(blobs):
                sets = shingle_sets(blobs[i:j], k)
                n = np.array([len(s) for s in sets])
                every, full = np.concatenate(sets), np.flatnonzero(n)
                starts = (np.cumsum(n) - n)[full]
                columns = np.zeros((4, j - i), np.uint64)
                if len(full):
                    np.add.at(total, (every & low).astype(np.int64), 1)
                    bit = np.uint64(1) << (every >> np.uint64(40) & np.uint64(63))
                    upper = (every >> np.uint64(46) & np.uint64(1)).astype(bool)
                    columns[0, full], columns[1, full] = np.add.reduceat(mix(every * _ONE), starts), np.add.reduceat(mix(every ^ _TWO), starts)
                    columns[2, full], columns[3, full] = (np.bitwise_xor.reduceat(np.where(side, bit, np.uint64(0)), starts) for side in (upper, ~upper))
                nothing = pa.nulls(j - i)
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(n), *[pa.array(c.view(np.int64)) for c in columns], nothing.cast(pa.int32()), nothing.cast(pa.binary())], schema=schema)
        if total.any():
            parts = [total[i * size : (i + 1) * size].astype("<u4").tobytes() for i in range(blocks)]
            yield pa.RecordBatch.from_arrays([*[pa.nulls(blocks, pa.int64())] * 6, pa.array(range(blocks), pa.int32()), pa.array(parts, pa.binary())], schema=schema)

    return docs.mapInArrow(run, out)


def sketch_of(sets: DataFrame, bits: int = SKETCH_BITS) -> np.ndarray:
    """The counters of all partitions added up."""
    size = (1 << bits) // 256

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(size, np.int64)
        for c in table.column("counts").to_pylist():
            total += np.frombuffer(c, "<u4")
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()), "counts": pa.array([np.minimum(total, 2**32 - 1).astype("<u4").tobytes()], pa.binary())})

    out = np.zeros(1 << bits, "<u4")
    for r in sets.where("block is not null").select("block", "counts").groupBy("block").applyInArrow(add, "block int, counts binary").collect():
        out[r.block * size : (r.block + 1) * size] = np.frombuffer(r.counts, "<u4")
    return out


def needed(n: int, num: int = NUMERATOR, den: int = DENOMINATOR) -> int:
    """The least overlap of a set of n with any set at the threshold."""
    return -(-num * n // den)


def class_numbers(n: int) -> list[int]:
    """How many classes frequent tokens of a set of n fall into: one number for 64 to 255 tokens, four times as many for four times the
    tokens; two near the upper limit, where a similar set may be beyond it. A set always has enough tokens for the number: needed(n) > classes."""
    limit, classes = 64, 8
    while n >= limit:
        limit, classes = limit * 4, classes if limit == 64 else classes * 4
    return [classes] if DENOMINATOR * n < NUMERATOR * limit else [classes, classes if limit == 64 else classes * 4]


def signatures(s: np.ndarray, counters: np.ndarray, noise: int, frequent: int = FREQUENT, tiny: int = TINY):
    """(keys, left, pieces) of a set's signatures, and its rank as a hub (0 to 127, the lower the better).

    left: the most tokens that a similar set can share with this one if the signature is the first one complete; pieces: how
    many pieces the signature's list is dealt in. `noise` is what the sketch adds to every count.
    """
    df = counters[(s & np.uint64(len(counters) - 1)).astype(np.int64)].astype(np.int64)
    order = np.lexsort((s, df))
    s, df, n = s[order], df[order], len(s)
    limit = noise + frequent + 6 * int(noise**0.5)
    rare = int(np.searchsorted(df, limit, "right"))
    spare = n - needed(n)
    single = np.arange(min(rare, spare + 1))
    keys, left, dealt = [s[single]], [n - single], [np.zeros(len(single), np.int64)]
    rest, many = s[rare:], spare + 1 - rare
    if many > 0 and n * NUMERATOR <= tiny * DENOMINATOR + NUMERATOR:  # tiny ones, and those that may be similar to them
        place = np.arange(rare, spare + 1)
        keys, left, dealt = keys + [mix(s[place] ^ _ALONE)], left + [n - place], dealt + [df[place]]
    if many > 0 and n > tiny:
        for classes in dict.fromkeys(class_numbers(n)):
            kind = (rest >> np.uint64(20) & np.uint64(classes - 1)).astype(np.int64)
            gain = np.ones(len(rest), np.int64)
            gain[np.unique(kind, return_index=True)[1]] = 0
            end = int(np.searchsorted(np.cumsum(gain), many)) + 1
            by_class = np.argsort(kind[:end], kind="stable")
            sorted_kind = kind[by_class]
            for step in range(1, end):
                at = np.flatnonzero(sorted_kind[step:] == sorted_kind[:-step])
                if not len(at):
                    break
                i, j = by_class[at], by_class[at + step]
                keys.append(mix(mix(rest[i]) * _PAIR + rest[j] + np.uint64(classes)))
                left.append(n - rare - j + np.minimum(rare + j, classes))
                dealt.append(df[rare + i])
    pieces = np.minimum(np.maximum(np.concatenate(dealt) - noise, 0) // PIECE + 1, 1 << 15)
    return np.concatenate(keys), np.minimum(np.concatenate(left), n), np.where(pieces > 1, pieces, 0), rare * 127 // n


def postings(reps: DataFrame, sketch: np.ndarray, k: int, frequent: int = FREQUENT) -> DataFrame:
    """(key, piece, doc_id, info) of every document: its index entries. piece: 0, or of a list that may be long from 1 on.

    info: rank, size of the set and `left` in 7, 28 and 28 bits, so that a shuffled entry is short.
    """
    out = T.StructType([T.StructField("key", T.LongType()), T.StructField("piece", T.ShortType()), T.StructField("doc_id", T.LongType()), T.StructField("info", T.LongType())])
    shared = reps.sparkSession.sparkContext.broadcast(sketch)  # 2^bits counters whatever the input
    noise = int(np.median(sketch))

    def run(batches):
        schema, counters = arrow_schema(out), shared.value
        for batch in slices(batches):
            ids, blobs = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for a, b in by_bytes(blobs):
                got = [(d, len(s), signatures(s, counters, noise, frequent)) for d, s in zip(ids[a:b], shingle_sets(blobs[a:b], k)) if len(s)]
                if not got:
                    continue
                sizes = [len(e[0]) for _, _, e in got]
                keys, left, pieces = (np.concatenate([e[x] for _, _, e in got]) for x in range(3))
                doc = np.repeat(np.array([d for d, _, _ in got], np.int64), sizes)
                info = np.repeat(np.array([e[3] << 56 | n << 28 for _, n, e in got], np.int64), sizes) | left
                piece = np.where(pieces > 0, (mix(doc.view(np.uint64)) >> np.uint64(32)).astype(np.int64) % np.maximum(pieces, 1) + 1, 0)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(piece.astype(np.int16)), pa.array(doc), pa.array(info)], schema=schema)

    return reps.select("doc_id", "text").mapInArrow(run, out)


def _size(info):
    return F.shiftright(info, 28).bitwiseAND(F.lit((1 << 28) - 1))


def _left(info):
    return info.bitwiseAND(F.lit((1 << 28) - 1))


def _may_link(info, other):
    """Sizes and places allow 100 * overlap >= 85 * union: the overlap is at most what is left of both."""
    n, m, least = _size(info), _size(other), F.least(_left(info), _left(other))
    return (DENOMINATOR * F.least(n, m) >= NUMERATOR * F.greatest(n, m)) & (DENOMINATOR * least >= NUMERATOR * (n + m - least))


def verified(pairs: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """The (hub, doc_id) pairs whose exact similarity is at or above the threshold.

    Texts of members are brought to their hub, a hub's text once for each of its salts: as many as it has
    SALT_ROWS pairs, so that no task gets all of them. A task reads its rows in order and holds one hub's set at a time.
    """
    uses = pairs.groupBy("hub").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("_salts"))
    members = pairs.join(uses, "hub").select("hub", F.pmod(F.xxhash64("doc_id"), F.col("_salts")).cast("int").alias("salt"), F.lit(True).alias("member"), "doc_id")
    hubs = uses.select("hub", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("salt"), F.lit(False).alias("member"), F.col("hub").alias("doc_id"))
    rows = docs.join(near(hubs.unionByName(members)), "doc_id").select("hub", "salt", "member", "doc_id", "text")  # one pass over the texts for both sides
    rows = rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "member", "doc_id")

    def run(batches):
        now, own = None, []
        for batch in slices(batches):
            hub, member, ids = (batch.column(c).to_pylist() for c in ("hub", "member", "doc_id"))
            blobs, kept = batch.column("text").to_pylist(), []
            for a, b in by_bytes(blobs):
                for i, s in zip(range(a, b), shingle_sets(blobs[a:b], k)):
                    if hub[i] != now:
                        now, own = hub[i], []
                    if not member[i]:
                        own.append(s)  # one set, or several where rows repeat the hub's id
                        continue
                    for h in own:
                        same = len(np.intersect1d(h, s, assume_unique=True))
                        if same and DENOMINATOR * same >= NUMERATOR * (len(h) + len(s) - same):
                            kept.append(i)
                            break
            yield pa.RecordBatch.from_arrays([pa.array([hub[i] for i in kept], pa.int64()), pa.array([ids[i] for i in kept], pa.int64())], names=["hub", "doc_id"])

    return rows.mapInArrow(run, "hub long, doc_id long")


def components(links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(doc_id, component) of every document with a link (x, y): the least id reachable.

    In each round every class points at the least of its neighbour classes. Pointers can only run in a circle of two, whose lesser
    class becomes the root; they are doubled until all reach a root, and links are kept between roots only. Each class that has a link left is
    merged with another one, so their number at least halves, whatever the order of ids; rounds go on until no link is left.
    """
    edges = links.select("x", "y").union(links.select("y", "x")).where("x <> y").distinct()
    edges = scratch.table(edges, f"{label}-edges-0")
    nodes, n = None, 0
    while nodes is None or not edges.isEmpty():
        least = edges.groupBy("x").agg(F.min("y").alias("up"))
        back = least.select(F.col("x").alias("up"), F.col("up").alias("_back"))
        tree = least.join(back, "up").select("x", F.when((F.col("_back") == F.col("x")) & (F.col("x") < F.col("up")), F.col("x")).otherwise(F.col("up")).alias("up"))
        tree, step = scratch.table(tree, f"{label}-tree-{n}-0"), 0
        while True:
            for _ in range(2):
                far = tree.select(F.col("x").alias("up"), F.col("up").alias("_up"))
                tree = tree.select("x", "up").join(far, "up").select("x", F.col("_up").alias("up"), (F.col("_up") != F.col("up")).alias("moved"))
            tree = scratch.table(tree, f"{label}-tree-{n}-{step + 1}")
            scratch.drop(f"{label}-tree-{n}-{step}")
            step += 1
            if tree.where("moved").isEmpty():
                break
        tree = near(tree.select("x", "up"))
        old, n = n, n + 1
        if nodes is None:
            nodes = tree.withColumnRenamed("up", "c")
        else:
            nodes = scratch.table(nodes.join(tree.withColumnRenamed("x", "c"), "c", "left").select("x", F.coalesce("up", "c").alias("c")), f"{label}-{n}")
        ends = edges.join(tree.select("x", F.col("up").alias("_x")), "x").join(tree.select(F.col("x").alias("y"), F.col("up").alias("_y")), "y")
        edges = scratch.table(ends.where("_x <> _y").select(F.col("_x").alias("x"), F.col("_y").alias("y")).distinct(), f"{label}-edges-{n}")
        scratch.drop(f"{label}-edges-{old}", *([f"{label}-{old}"] if old > 1 else []))
    least = nodes.groupBy("c").agg(F.min("x").alias("component"))
    out = scratch.table(nodes.join(least, "c").select(F.col("x").alias("doc_id"), "component"), f"{label}-out")
    scratch.drop(f"{label}-edges-{n}", f"{label}-{n}", f"{label}-tree-0-{step}")
    return out


def _joined(known: DataFrame, links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """The classes `known` (doc_id, component) after more links (hub, doc_id): links are drawn between classes, so only what is new is worked on."""
    of = near(known)
    named = links
    for c in ("hub", "doc_id"):
        named = named.join(of.select(F.col("doc_id").alias(c), F.col("component").alias(f"_{c}")), c, "left").withColumn(c, F.coalesce(f"_{c}", c)).drop(f"_{c}")
    more = near(components(named.select(F.col("hub").alias("x"), F.col("doc_id").alias("y")), scratch, label))
    old = known.join(more.select(F.col("doc_id").alias("component"), F.col("component").alias("_c")), "component", "left").select("doc_id", F.coalesce("_c", "component").alias("component"))
    return scratch.table(old.unionByName(more.join(of.select("doc_id"), "doc_id", "left_anti")), f"{label}-classes")


def join_classes(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_shingles, component_id of (doc_id, text) rows.

    A null or empty text has an empty set and is linked with nothing. Rows that repeat a doc_id are one document: it has one row for each
    size of set among them and the links of all. A row without a doc_id can't be named, so it is linked with nothing
    and its component_id is null. An empty frame gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "similarity")
    docs = keyed_text(docs)
    base = scratch.table(sets_of(docs, k), "base")
    sets = base.where("block is null")
    named = sets.where("doc_id is not null and n_shingles > 0")
    copies = scratch.table(named.groupBy("a", "b", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count("*").alias("_n")).where("_n > 1").drop("_n"), "copies")
    marked = named.join(near(copies), ["a", "b", "n_shingles"], "left").select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"))
    twins = scratch.table(marked.where("doc_id <> rep").distinct(), "twins")  # documents that another one stands for
    # A document that has rows of several sets may stand for some and be stood for by others: these are links too.
    lasting = marked.where("doc_id = rep").select("doc_id").distinct()
    bridges = scratch.table(twins.join(lasting, "doc_id", "left_semi").select(F.col("rep").alias("hub"), "doc_id").unionByName(
        twins.groupBy("doc_id").agg(F.min("rep").alias("hub"), F.max("rep").alias("_last")).where("hub < _last").drop("_last").join(twins, "doc_id").select("hub", F.col("rep").alias("doc_id"))
    ), "bridges")
    alone = twins.join(near(bridges.select("doc_id")), "doc_id", "left_anti").select("doc_id")
    reps = docs.where("doc_id is not null").join(near(alone), "doc_id", "left_anti")
    entries = postings(reps, sketch_of(base), k)
    order = Window.partitionBy("key", "piece").orderBy("info", "doc_id")
    live = entries.withColumn("hub", F.first(F.struct("doc_id", "info")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("_next", F.lead("doc_id").over(order))
    lead = F.col("hub.doc_id") == F.col("doc_id")
    live = live.where(~lead | F.col("_next").isNotNull() | (F.col("piece") > 0)).drop("_next")  # lists of one document can't give a pair
    live = scratch.table(live, "live")
    pairs = live.where(~lead & _may_link(F.col("info"), F.col("hub.info"))).select(F.col("hub.doc_id").alias("hub"), "doc_id")
    heads = live.where(lead & (F.col("piece") > 0)).select("key", "doc_id", "info")  # a row a piece
    best = heads.groupBy("key").agg(F.min(F.struct("info", "doc_id")).alias("hub"))
    heads = heads.join(best, "key").where((F.col("hub.doc_id") != F.col("doc_id")) & _may_link(F.col("info"), F.col("hub.info")))
    pairs = scratch.table(pairs.unionByName(heads.select(F.col("hub.doc_id").alias("hub"), "doc_id")).distinct(), "pairs-1")
    links = verified(pairs, reps, k).unionByName(bridges).select(F.col("hub").alias("x"), F.col("doc_id").alias("y"))
    known = components(links, scratch, "known-1")
    bitmaps, lists = sets.select("doc_id", "p", "q"), live.drop("hub")
    for step in (2, 3):
        marked = lists.join(near(known), "doc_id", "left").withColumn("c", F.coalesce("component", "doc_id")).drop("component")
        split = marked.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("_members")).where("lo < hi").select("key", "_members")
        open_lists = scratch.table(marked.join(near(scratch.table(split, f"split-{step}")), "key"), f"open-{step}")
        if step == 2:  # all pairs of short lists, more hubs for the others
            lists = open_lists.where(F.col("_members") > SHORT).drop("c", "_members")
            more = _block_pairs(open_lists.where(F.col("_members") <= SHORT), bitmaps).unionByName(_hub_pairs(open_lists.where(F.col("_members") > SHORT), scratch))
        else:
            more = _block_pairs(open_lists, bitmaps)
        tried = pairs.unionByName(pairs.select(F.col("doc_id").alias("hub"), F.col("hub").alias("doc_id")))
        more = scratch.table(more.distinct().join(tried, ["hub", "doc_id"], "left_anti"), f"pairs-{step}")
        scratch.drop(f"split-{step}", *(["live"] if step == 2 else []))
        if not more.isEmpty():
            known, pairs = _joined(known, verified(more, reps, k), scratch, f"known-{step}"), pairs.unionByName(more)
    scratch.drop("open-2", "open-3", "pairs-1", "pairs-2", "pairs-3")
    found = near(known.withColumnRenamed("doc_id", "rep"))
    every = sets.select("doc_id", "n_shingles").distinct()
    moved = near(twins.groupBy("doc_id").agg(F.min("rep").alias("rep")))
    return (
        every.join(moved, "doc_id", "left").withColumn("rep", F.coalesce("rep", "doc_id")).join(found, "rep", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    )


def _hub_pairs(open_lists: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs of each list's members with the HUBS best hubs of the list that are of another class. Hubs are found among the best of
    pieces of the list, so no list has to fit in one task."""
    piece = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    few = open_lists.select("key", "doc_id", "info", "c").withColumn("_r", F.row_number().over(Window.partitionBy("key", piece).orderBy("info", "doc_id"))).where(F.col("_r") <= HUBS)
    few = few.withColumn("_r", F.row_number().over(Window.partitionBy("key").orderBy("info", "doc_id"))).where(F.col("_r") <= HUBS)
    hubs = scratch.table(few.select("key", F.col("doc_id").alias("hub"), F.col("info").alias("_info"), F.col("c").alias("_c")), "hubs")  # written, so that the join's sides are plain and a long list can be split
    return open_lists.join(hubs, "key").where((F.col("_c") != F.col("c")) & _may_link(F.col("info"), F.col("_info"))).select("hub", "doc_id")


def _block_pairs(open_lists: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Every pair of a list's members of different classes that sizes, places and bitmaps allow.

    A list is dealt in pieces of about BLOCK members, and each two pieces are a block of their own, so the work of one list is spread over
    all tasks. Parity bitmaps differ in no more places than the sets in tokens, so a pair with a larger distance can't be a link.
    """
    pieces = F.ceil(F.col("_members") / BLOCK).cast("int")
    rows = open_lists.join(bitmaps, "doc_id").select("key", "doc_id", "info", "c", "p", "q", pieces.alias("_n")).withColumn("_at", F.pmod(F.xxhash64("doc_id"), F.col("_n")).cast("int"))
    x = rows.select("key", F.col("_at").alias("lo"), F.explode(F.expr("sequence(_at, _n - 1)")).alias("hi"), *[F.col(c).alias(f"x_{c}") for c in ("doc_id", "info", "c", "p", "q")])
    y = rows.select("key", F.explode(F.expr("sequence(0, _at)")).alias("lo"), F.col("_at").alias("hi"), *[F.col(c).alias(f"y_{c}") for c in ("doc_id", "info", "c", "p", "q")])
    differ = sum(F.bit_count(F.col(f"x_{c}").bitwiseXOR(F.col(f"y_{c}"))) for c in "pq")
    n = _size(F.col("x_info")) + _size(F.col("y_info"))
    once = (F.col("lo") < F.col("hi")) | (F.col("x_doc_id") < F.col("y_doc_id"))
    may = (F.col("x_c") != F.col("y_c")) & once & _may_link(F.col("x_info"), F.col("y_info")) & ((NUMERATOR + DENOMINATOR) * differ <= (DENOMINATOR - NUMERATOR) * n)
    return x.join(y, ["key", "lo", "hi"]).where(may).select(F.least("x_doc_id", "y_doc_id").alias("hub"), F.greatest("x_doc_id", "y_doc_id").alias("doc_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: the class of every document under links of 85 in 100 of their 4-word shingles."""
    return join_classes(documents(spark, sf_dir).select("doc_id", "text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, the one of the least id, with its own columns; documents without words stay.

    Of rows that repeat a doc_id the least by their columns stays; rows without a doc_id all stay.
    """
    scratch = Scratch(spark, "near-copies")
    gone = scratch.table(join_classes(docs.select("doc_id", "text")).where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    twice = scratch.table(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("_n")).where("_n > 1").select("doc_id"), "twice")
    kept = docs.join(near(gone), "doc_id", "left_anti")
    if twice.isEmpty():
        return kept.select(*docs.columns)
    first = kept.join(near(twice), "doc_id", "left_semi").withColumn("_r", F.row_number().over(Window.partitionBy("doc_id").orderBy(*[c for c in docs.columns if c != "doc_id"]))).where("_r = 1")
    return kept.join(near(twice), "doc_id", "left_anti").select(*docs.columns).unionByName(first.select(*docs.columns))
