"""Operators 11 to 13 against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import collections
import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from textloom.llm import divergence, infill, line_dedup

SCHEMA = "doc_id long, text string, lang string, source string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = ["The Quick brown fox jumps over the lazy dog again %d" % i for i in range(4)] + ["Ünïcode É line with forty code points or more %d" % i for i in range(3)] + ["x" * 39, "y" * 40]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lined(n=80, seed=1):
    rng = random.Random(seed)
    out = [None, "", "\n", "\n\n\n", "a\n", LONG[0], "\n".join(LONG), LONG[0] + "\n" + LONG[0], " \t" + LONG[1].upper() + "\r\x0b\x0c ", " " + LONG[1]]
    for _ in range(n):
        lines = [rng.choice(["", "short", " " * 50, rng.choice(LONG), rng.choice(LONG).upper(), "\t" + rng.choice(LONG) + " ", f"a line of its own that is long enough to count {rng.random()}"]) for _ in range(rng.randint(1, 9))]
        out.append("\n".join(lines))
    return out


def kept_lines(rows, least_chars=40, least_docs=5):
    holders = collections.defaultdict(set)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < least_docs or d == max((h for h in holders[key(x)] if h is not None), default=object())]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("odd", [False, True])
def test_lines(spark, odd):
    rows = list(enumerate(lined()))
    if odd:  # repeated ids with equal and other texts, rows without an id
        rows += rows[5:20] + [(7, LONG[2] + "\n" + LONG[3]), (None, LONG[0] + "\nkept"), (None, LONG[0] + "\nkept"), (None, None)]
    df = spark.createDataFrame([(d, t, "lost", "n") for d, t in rows], "doc_id long, text string, _lost string, line string")
    got = line_dedup.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "_lost", "line", "kept", "n_lines", "n_dropped"]
    have = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got.collect()), key=repr)
    assert have == sorted(kept_lines(rows), key=repr)
    assert any(r[2] for r in have)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_a_common_line_and_a_long_text(spark):
    # One line in all documents is a heavy key; one text of 60,000 lines loses every second one in time in proportion.
    rows = [(i, LONG[0] + f"\nmine {i}") for i in range(3000)] + [(5000, "\n".join(LONG[1 + i % 2] if i % 2 else f"own {i}" for i in range(60_000)))] + [(6000 + i, LONG[1] + "\n" + LONG[2]) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    began = time.time()
    have = sorted((r.doc_id, r.n_lines, r.n_dropped, sha(r.kept)) for r in line_dedup.dedup_lines(df).collect())
    assert time.time() - began < 60
    assert have == sorted((d, n, x, sha(t)) for d, n, x, t in kept_lines(rows))


def cut(d, text, seed=1):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return d, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    return (d, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (d, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_infill(spark):
    rng = random.Random(4)
    some = [None, "", "a", "é", "🙂", "日本", "<P>", "a<S>b", "<M", "<", "><", "<S<P", "x" * 70_000 + "é" * 70_000, "🙂é" * 40_000]
    some += ["".join(rng.choice("ab <>PSM\né日🙂\x00") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    rows = [(i * 7 - 50, t) for i, t in enumerate(some)] + [(3, "twice"), (3, "twice"), (3, "other"), (None, "no id"), (None, None)]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, output string, n int")
    out = infill.transform(df).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    got = out.collect()
    want = [cut(d, t) for d, t in rows]
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=repr) == sorted(want, key=repr)
    assert sorted(((r.doc_id, r.back) for r in got), key=repr) == sorted(((d, t or "") for d, t in rows), key=repr)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert infill.transform(df.limit(0)).count() == 0


def divergence_rows(rows, least=10, top=10):
    docs = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))) for _, t, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df = collections.Counter(w for x in docs if x[0] == lang for w in set(x[2]))
        kept = {w for w, n in df.items() if n >= least}
        count = {s: collections.Counter() for s in {d[1] for d in docs if d[0] == lang}}
        for x in docs:
            if x[0] == lang:
                count[x[1]].update(w for w in x[2] if w in kept)
        whole = sum(count.values(), collections.Counter())
        share = lambda c, w: 1 + 10**9 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept))
        apart = lambda p, q: (p - q) ** 2 // (p + q)
        p = {s: {w: share(c, w) for w in kept} for s, c in count.items()}
        q = {w: share(whole, w) for w in kept}
        for s in count:
            pair = [("pair", o, sum(apart(p[s][w], p[o][w]) for w in kept)) for o in count if o != s]
            term = [("term", w, apart(p[s][w], q[w])) for w in kept if count[s][w] and p[s][w] > q[w]]
            for part, most in ((pair, len(pair)), (term, top)):
                part.sort(key=lambda x: (-x[2], x[1].encode()))
                out += [(lang, s, *x, i + 1) for i, x in enumerate(part[:most])]
    return sorted(out)


def test_divergence(spark):
    rng = random.Random(9)
    common = [f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz"] + ["É", "é", "日本", "Ab", "aB", "x@y", "don't"]
    rows = [(i, " ".join(rng.choice(common[: 5 + 3 * (i % 10)]) for _ in range(rng.randint(0, 40))), rng.choice(["en", "de"]), f"s{int(rng.random() ** 2 * 9)}") for i in range(400)]
    rows += [(1, None, None, None), (1, "", "", "s"), (2, "alone in its language", "fr", "s1"), (3, "x", "fr", "é"), (4, "", "en", "textless"), (None, "wa wa wb", "en", None), (5, "wa", "de", "S1"), (5, "wa", "de", "S1")]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA + ", k string, term int")
    for least, top in ((10, 10), (1, 3), (10_000, 10)):
        got = sorted(tuple(r) for r in divergence.audit(df, least, top).select("lang", "source", "part", "item", "value", "rank").collect())
        assert got == divergence_rows(rows, least, top)
    assert divergence.audit(df.limit(0)).count() == 0


def test_trees_in_small_pieces(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(chr(97 + int(rng.random() ** 2 * 26)) * rng.randint(1, 3) for _ in range(30)), "en", f"s{i % 12}") for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(tuple(r) for r in divergence.audit(df, 3, held_terms=40, cells=60).collect()) == divergence_rows(rows, 3)


def test_long_division(spark):
    cases = [(2, 3), (10**12, 3 * 10**13), (8 * 10**14 + 1, 8 * 10**14 + 1), (7, 9 * 10**15 - 1), (5 * 10**15, 9 * 10**15 - 1)]
    df = spark.createDataFrame(cases, "n long, m long").select(F.expr(divergence.long_division("n", "m")).alias("x"))
    assert [r.x for r in df.collect()] == [10**9 * n // m for n, m in cases]
