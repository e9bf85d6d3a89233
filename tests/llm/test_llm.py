"""The numbered operators on small frames: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns; brute force and round trips."""

import collections
import gzip
import hashlib
import io
import random
import re
import struct
import time
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import chat, licenses, media, mixing, pieces, quality, range_coder, sharding, similarity, token_files, toxicity, words
from textloom.llm.shared import Scratch, keyed_text

SF = "/root/testdata/sf0.001"
WORDS = "the of and thing ation er loser under mit license version apache cc by nc é ß 日本 x1".split()


def texts(n=60, seed=3):
    rng = random.Random(seed)
    out = [None, "", " ", "a", "\n\n", "Under the MIT License. under the mit license", "x " * 9000, "Apache License, Version 2.0 CC BY-NC", "K İ Under THE mit licenſe", "a  b   c \t d"]
    out += [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 80))) for _ in range(n)]
    for i in range(20):
        base = out[12 + i].split()
        base[len(base) // 2] = "edit"
        out.append(" ".join(base))
    return out + out[10:20]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 3 if i % 4 else 0}", len(t or ""), 1) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score long")


def brute_shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()


def test_pieces_like_the_library(spark, docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    got = {r.doc_id: r for r in pieces.encode(docs, pieces.model_path()).collect()}
    for i, t in enumerate(texts()):
        ids = sp.encode(t or "", add_eos=True)
        assert list(got[i].piece_ids) == ids
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    assert pieces.encode(docs.limit(0), pieces.model_path()).count() == 0
    coder, rng = pieces.coder(pieces.model_path()), random.Random(5)
    for _ in range(400):
        t = "".join(rng.choice("abeth nio▁ \n日é🙂") for _ in range(rng.randint(0, 50)))
        ids = sp.encode(t, add_eos=True)
        assert coder.encode(t) == ids and coder.decode(ids) == sp.decode(ids)


def test_license_places(spark, docs):
    every, spans = licenses.scan(docs)
    n = {r.doc_id: r.n_words for r in every.collect()}
    base = collections.Counter()
    for r in spans.where("base").collect():
        base[r.doc_id, r.first_word, r.label] += 1
    want = collections.Counter()
    for i, t in enumerate(texts()):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        assert n[i] == len(w)
        for phrase, label in licenses.BASE:
            p = phrase.split()
            for j in range(len(w)):
                if w[j : j + len(p)] == p:
                    want[i, j, label] += 1
    assert base == want
    assert licenses.scan(docs.limit(0))[1].count() == 0 and licenses.report(docs.limit(0)).count() == 0


def plain_report(text, base, notices):
    """Labels and score of one text by the method's definition, over lists."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, base_labels, labels, score = [], set(), set(), 0.0
    for phrase, label in base:
        p = phrase.split()
        found = [j for j in range(len(w)) if w[j : j + len(p)] == p]
        starts += found
        if found:
            base_labels.add(label)
            score = 1.0
    for phrase, label in notices:
        p = phrase.split()
        n, half = len(p) - 2, max(1, 2 * min(licenses.DRIFT, (len(p) - 1) // 2))
        hits = [(at, place) for at in range(len(w) - 2) for place in range(n) if w[at : at + 3] == p[place : place + 3]]
        for window in {d // half - x for d in (at - place for at, place in hits) for x in (0, 1)}:
            own = [(at, place) for at, place in hits if window * half <= at - place < (window + 2) * half]
            counts = collections.Counter(at - place for at, place in own)
            main = min(counts, key=lambda d: (-counts[d], d))
            last, last_at, got = -1, -1, 0
            for place, _, at in sorted((place, abs(at - place - main), at) for at, place in own):
                if place > last and at > last_at:
                    last, last_at, got = place, at, got + 1
            if got >= n * licenses.COVER:
                labels.add(label)
                score = max(score, got / n)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)), ",".join(sorted(base_labels | labels)), score


def test_license_report(spark):
    notice = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License"
    cases = [*texts(20), notice, notice.replace("redistribute", "pass on"), notice.replace("free software; you", "you"), notice + " " + notice, "all rights reserved", "All rights reserved. " * 4, "general public license " * 3,
             "of the terms under it modify or and it redistribute can you software free is program this", "this work is licenced under the gnu general public license version 3", "gnu lesser general public license gnu lesser general public"]
    rows = [(i % 7 if i % 11 else None, t) for i, t in enumerate(cases)] + [(3, "under the mit license")] * 2 + [(None, "cc by nc")] * 3 + [(3, None)] * 2
    got = licenses.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    want = [(d, *plain_report(t, licenses.BASE, licenses.NOTICES)) for d, t in rows]
    assert sorted(map(key, (tuple(r) for r in got))) == sorted(map(key, want))
    labels = {t: plain_report(t, [], licenses.NOTICES)[5] for t in cases}
    assert labels["All rights reserved. " * 4] == "all-rights-reserved" and labels["general public license " * 3] == ""
    assert labels[notice.replace("redistribute", "pass on")] == "gpl" and labels[cases[-3]] == "" and labels[cases[-2]] == "gpl-3"


def test_mixing_budgets(spark, docs):
    leaves = spark.createDataFrame([("d0", "en", "a", 100), ("d0", "en", "b", 1000), ("d0", "de", "c", 1000), ("d1", "en", "d", 50)], "domain string, lang string, source string, available long")
    got = {r.source: r.budget for r in mixing.budgets(leaves.withColumn("_all", F.lit(2150)), F.lit(1200.0), {}).collect()}
    assert got == {"d": 50, "a": 100, "b": 475, "c": 575}  # d's shortage goes to the other domain, a's to its sibling
    rows = mixing.leveled(docs)
    out = mixing.mix(rows, Scratch(spark, "t"), share=0.5).collect()
    assert len(out) == docs.count()
    used, there = sum(r.tokens * r.copies for r in out), sum(r.tokens for r in out)
    assert used <= 0.5 * there
    twice = mixing.mix(rows, Scratch(spark, "t"), share=1.5, epochs=2.0).collect()
    assert max(r.copies for r in twice) == 2 and mixing.mix(rows.limit(0), Scratch(spark, "t")).count() == 0


def shares(budget, caps, weights):
    """Water filling by hand: whoever would get more than they hold is filled, and the rest shares what is left."""
    got, todo = dict.fromkeys(caps, 0.0), set(caps)
    while todo:
        each = (budget - sum(got.values())) / sum(weights[c] for c in todo)
        full = {c for c in todo if caps[c] <= each * weights[c] + 1e-9}
        for c in full or todo:
            got[c] = caps[c] if full else each * weights[c]
        todo = todo - full if full else set()
    return got


def test_mixing_by_hand(spark, docs):
    odd = spark.createDataFrame([(None, "a b c", None, None), (None, "d", "en", "s1"), (3, "x y", "en", "s1"), (500, None, "de", "s2"), (501, "", "de", "s2")], "doc_id long, text string, lang string, source string")
    rows = mixing.leveled(docs.select("doc_id", "text", "lang", "source").unionByName(odd)).withColumn("budget", F.lit("clash"))
    for share, epochs in ((0.3, 1.0), (0.8, 1.0), (1.7, 2.0), (5.0, 3.0), (0.0, 1.0)):
        out = mixing.mix(rows, Scratch(spark, "t"), share=share, epochs=epochs).collect()
        held = collections.defaultdict(int)
        for r in out:
            held[r.domain, r.lang, r.source] += r.tokens
        total = share * sum(held.values())

        def weight(level, name):
            return mixing.WEIGHTS.get(mixing.LEVELS[level], {}).get(name, 1.0)

        def deal(prefix, budget, level):
            if level == 3:
                return {prefix: int(budget + 1e-6)}
            names = {leaf[level] for leaf in held if leaf[:level] == prefix}
            caps = {n: epochs * sum(v for leaf, v in held.items() if leaf[: level + 1] == (*prefix, n)) for n in names}
            out = {}
            for n, b in shares(min(budget, sum(caps.values())), caps, {n: weight(level, n) for n in names}).items():
                out |= deal((*prefix, n), b, level + 1)
            return out

        budgets = deal((), total, 0)
        places = {}
        for leaf, budget in budgets.items():
            passes = budget // max(1, held[leaf])
            own = sorted(((r.doc_id, r.tokens, r.copies) for r in out if (r.domain, r.lang, r.source) == leaf), key=str)
            marks = spark.createDataFrame([(o[0],) for o in own], "d long").select(F.xxhash64(F.lit(mixing.SEED), F.lit(passes).cast("long"), F.coalesce("d", F.lit(-1)))).collect()
            order, upto, left = sorted(zip([m[0] for m in marks], own), key=lambda z: (z[0], z[1][0] is not None, z[1][0] or 0, z[1][1])), 0, budget - passes * held[leaf]
            for _, (_, tokens, copies) in order:
                upto += tokens
                assert copies == (0 if tokens == 0 else passes + (upto <= left)), (leaf, share)
            places[leaf] = passes
        assert len(out) == docs.count() + 5


def test_mixing_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 1)  # as many ranges as a leaf of millions of documents has
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("d0").alias("domain"), F.lit("en").alias("lang"), F.lit("a").alias("source"), (F.col("id") % 7 + 1).alias("tokens"))
    out = mixing.mix(rows, Scratch(spark, "t"), share=0.5).withColumn("place", F.xxhash64(F.lit(mixing.SEED), F.lit(0).cast("long"), F.col("doc_id"))).orderBy("place").collect()
    budget, upto = sum(r.tokens for r in out) // 2, 0
    for r in out:
        upto += r.tokens
        assert r.copies == (1 if upto <= budget else 0)
    assert len(out) == 5000


def test_similarity_brute_force(spark, docs):
    sets = [brute_shingles(t) for t in texts()]
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similarity.join_classes(docs).collect()}
    assert got == {i: (len(s), label[i]) for i, s in enumerate(sets)}


def test_components_of_shuffled_chains(spark):
    rng, links, least = random.Random(1), [], {}
    for start, n in ((0, 1000), (1000, 300)):
        ids = list(range(start, start + n))
        rng.shuffle(ids)
        links += list(zip(ids, ids[1:]))
        least |= dict.fromkeys(ids, start)
    down = [2000, *range(2079, 2000, -1)]  # the least id at one end, then falling ones
    links += list(zip(down, down[1:])) + [(3000 + i, 3050) for i in range(50)]
    least |= dict.fromkeys(down, 2000) | dict.fromkeys(range(3000, 3051), 3000)
    found = similarity.components(spark.createDataFrame([tuple(sorted(p)) for p in links], "x long, y long").coalesce(2), Scratch(spark, "t"), "c")
    rows = found.collect()
    assert len(rows) == len(least) and {r.doc_id: r.component for r in rows} == least
    assert similarity.components(found.select("doc_id", F.col("component").alias("x"), F.col("doc_id").alias("y")).limit(0), Scratch(spark, "t"), "c").count() == 0


def test_words_have_different_hashes():
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a  # one hash as polynomials modulo 2^64
    rng = random.Random(2)
    some = {a, b, *("".join(rng.choice("ab") for _ in range(rng.randint(1, 40))) for _ in range(3000)), "abcdefgh", "abcdefgh\0", "x" * (1 << 21)}
    h, limits = words.word_hashes([w.encode() for w in sorted(some)])
    assert len(set(h.tolist())) == len(some) and list(np.diff(limits)) == [1] * len(some)
    same, _ = words.word_hashes([f" {w}\t".encode() for w in sorted(some)] + [b"ABCDEFGH"])
    assert list(same) == [*h, h[sorted(some).index("abcdefgh")]]


def test_similar_sets_meet_in_a_signature():
    """Any mix of rare and frequent tokens, sizes on both sides of every limit of class numbers; and no pair is lost by sizes and places."""
    rng = np.random.default_rng(1)
    counters = np.where(np.arange(1 << 10) % 3 > 0, 1000, 0).astype("<u4")
    met = 0
    for n in [*range(1, 40), 54, 63, 64, 70, 218, 255, 256, 300, 900, 1024, 1100, 2500] * 3:
        for share in (0.0, 0.5, 1.0):
            pool = rng.integers(0, 1 << 62, 4 * n + 60, dtype=np.uint64)
            often = counters[(pool & np.uint64(1023)).astype(int)] > 0
            pool = np.unique(np.concatenate([pool[often][: int(share * 2 * n) + 1], pool[~often][: int((1 - share) * 2 * n) + 1]]))
            s = rng.permutation(pool)[:n]
            most = n - similarity.needed(n)
            lost = int(rng.integers(0, most + 1))
            y = np.unique(np.concatenate([s[lost:], rng.integers(0, 1 << 62, int(rng.integers(0, most + 1)), dtype=np.uint64)]))
            s, same = np.unique(s), len(np.intersect1d(s, y))
            if 100 * same < 85 * (len(s) + len(y) - same):
                continue
            met += 1
            one, two = (similarity.signatures(z, counters, 0) for z in (s, y))
            left = dict(zip(one[0].tolist(), one[1].tolist()))
            shared = [(left[k], m) for k, m in zip(two[0].tolist(), two[1].tolist()) if k in left]
            assert any(100 * min(p) >= 85 * (len(s) + len(y) - min(p)) for p in shared), (n, share)
            if share == 1.0 and len(s) > 40:
                assert len(one[0]) <= len(s)  # combinations stay in proportion to the set
    assert met > 200


def test_similarity_of_odd_rows(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near, other = base.replace("w30", "x"), " ".join(f"v{i}" for i in range(50))
    rows = [(5, base), (9, near), (5, base), (None, base), (None, None), (7, None), (8, ""), (4, other), (6, other), (6, base + " tail"), (1, "one two"), (2, "ONE two"), (3, "two one")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rep", F.lit(1)).withColumn("key", F.lit("k"))
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_shingles, r.component_id) for r in similarity.join_classes(frame).collect())
    want = [(5, 57, 4), (9, 57, 4), (7, 0, 7), (8, 0, 8), (4, 47, 4), (6, 47, 4), (6, 58, 4), (1, 1, 1), (2, 1, 1), (3, 1, 3)]  # 6 has rows in two groups, which are one by it
    assert got == sorted([((False, d), n, c) for d, n, c in want] + [((True, 0), 57, None), ((True, 0), 0, None)])
    kept = similarity.stage(spark, frame.select("doc_id", "text", "key"), "")
    assert kept.columns == ["doc_id", "text", "key"]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text is None) for r in kept.collect()) == [(False, 1, False), (False, 3, False), (False, 4, False), (False, 7, True), (False, 8, False), (True, 0, False), (True, 0, True)]
    assert similarity.join_classes(frame.limit(0)).count() == 0 and similarity.stage(spark, frame.limit(0), "").count() == 0


def test_similarity_of_long_lists(spark, monkeypatch):
    """Lists dealt in pieces with hubs of their own, and blocks of two pieces at last, give the same classes."""
    rng = random.Random(8)
    texts = []
    for group in range(6):
        common = [f"g{group}w{i}" for i in range(40)]
        for _ in range(40):
            w = common + [f"u{rng.randrange(10**6)}" for _ in range(rng.choice((0, 1, 2, 12)))]
            texts.append(" ".join(w))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [brute_shingles(t) for t in texts]
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]) and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    for name, value in (("FREQUENT", 5), ("PIECE", 7), ("HUBS", 1), ("BLOCK", 3), ("SHORT", 4)):
        monkeypatch.setattr(similarity, name, value)
    assert {r.doc_id: r.component_id for r in similarity.join_classes(frame).collect()} == dict(enumerate(label))


CALLS = "conv_id long, turn long, call_id string, parents array<string>, tool string, args string"


def test_chat(spark):
    rows = [(1, 0, "a", None, "lookup", '{"query": "q\\"é", "limit": 2}'), (1, 2, "b", ["a"], "lookup", '{"limit": 0}'), (1, 4, "c", ["b"], "fly", "{}"), (1, 6, "d", ["e"], "note", '{"text": "t"}'), (1, 8, "e", ["d"], "note", '{"z": 1, "text": ""}')]
    rows += [(2, 0, "x", None, "note", '{"text": "t"}'), (2, 1, "x", None, "note", '{"text": "t"}'), (None, None, None, None, None, None), (3, 0, "n", ["gone"], "note", "no json"), (3, 1, "m", ["n"], "note", "[1]"), (3, 2, "o", [], "lookup", '{"query": 1, "limit": 1.5}')]
    c = spark.createDataFrame(rows, CALLS).withColumn("depth", F.lit("clash")).withColumn("json", F.lit(1)).select(*[x.split()[0] for x in CALLS.split(", ")])
    r = spark.createDataFrame([("a", 1, "first"), ("a", 3, "late"), ("x", 2, "r")], "call_id string, turn long, content string")
    got = {(x.call_id, x.turn): x for x in chat.format_calls(c, r, Scratch(spark, "t")).collect()}
    assert got["a", 0].json == '{"arguments":{"limit":2,"query":"q\\"é"},"id":"a","name":"lookup","result":"first","turn":0}'
    assert [got["a", 0].depth, got["b", 2].depth, got["c", 4].depth, got["d", 6].depth, got["n", 0].depth, got["m", 1].depth] == [0, 1, 2, None, 0, 1]
    assert got["b", 2].problems == "bad:limit,missing:query" and got["c", 4].problems == "unknown-tool" and got["e", 8].problems == "bad:text,unknown-argument"
    assert got["n", 0].problems == "bad-json" and '"arguments":"no json"' in got["n", 0].json and got["m", 1].problems == "bad-arguments" and got["o", 2].problems == "bad:limit,bad:query"
    assert got["x", 0].status == "repeated-id" and got["d", 6].status == "no-result" and len(got) == len(rows)
    assert sorted(x.position for k, x in got.items() if x.conv_id == 1) == [1, 2, 3, 4, 5]
    assert chat.format_calls(c.limit(0), r.limit(0), Scratch(spark, "t")).count() == 0


def test_chat_schemas(spark):
    schema = {"type": "object", "required": ["tags"], "properties": {"tags": {"type": "array", "minItems": 1, "items": {"type": "string", "maxLength": 3}}, "mode": {"enum": ["a", 2, None]}, "on": {"type": "boolean"},
              "at": {"type": "object", "required": ["x"], "additionalProperties": False, "properties": {"x": {"type": "number", "maximum": 1}, "deep": {"type": "array", "items": {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer"}}}}}}}}
    cases = {'{"tags": ["ab", "c"], "free": {"b": [1, {"z": 1, "a": null}], "a": 0.5}}': "", "{}": "missing:tags", '{"tags": []}': "bad:tags", '{"tags": ["long"]}': "bad:tags", '{"tags": [1]}': "bad:tags", '{"tags": null}': "bad:tags",
             '{"tags": ["a"], "mode": null, "on": true}': "", '{"tags": ["a"], "mode": "b", "on": "true"}': "bad:mode,bad:on", '{"tags": ["a"], "at": {"x": 1.5, "y": 1}}': "bad:at.x,unknown-argument",
             '{"tags": ["a"], "at": {"deep": [{"k": 1}, {"k": "1"}]}}': "bad:at.deep,missing:at.x", '{"tags": ["a"], "at": {"x": -2, "deep": [{"k": 1.0}]}}': "", '{"tags": ["a"], "at": []}': "bad:at"}
    c = spark.createDataFrame([(1, i, str(i), None, "t", args) for i, args in enumerate(cases)], CALLS)
    got = {r.turn: r for r in chat.format_calls(c, spark.createDataFrame([], "call_id string, turn long, content string"), Scratch(spark, "t"), {"t": schema}).collect()}
    for i, (args, want) in enumerate(cases.items()):
        assert got[i].problems == want, args
    assert '"arguments":{"free":{"a":0.5,"b":[1,{"a":null,"z":1}]},"tags":["ab","c"]}' in got[0].json


def test_chat_depths(spark):
    rng, parents = random.Random(4), {}
    for i in range(400):  # chains, trees and joins
        parents[str(i)] = [str(i - 1)] if i and i < 120 else [str(rng.randrange(i)) for _ in range(rng.choice((0, 1, 1, 2, 3)))] if i else []
    parents |= {"c1": ["c2"], "c2": ["c1"], "c3": ["c1", "5"], "c4": ["c3"], "s": ["s"], "u": ["nowhere", "7"]}
    depth = {}

    def longest(c, on=()):
        if c in on:
            return None
        if c not in depth:
            ups = [longest(p, (*on, c)) for p in parents[c] if p in parents]
            depth[c] = None if None in ups else max(ups, default=-1) + 1
        return depth[c]

    want = {c: longest(c) for c in parents}
    frame = spark.createDataFrame([(c, p or None) for c, p in parents.items()] + [(None, ["1"])], "call_id string, parents array<string>")
    assert {r.call_id: r.depth for r in chat.depths(frame, Scratch(spark, "t")).collect()} == want


def test_chat_every_message(spark):
    talk = [(1, 0, "system", "be"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 3, "user", "c"), (1, 4, "assistant", "d"), (1, 5, "user", "e"), (1, 6, "tool", 'q"'), (1, 7, "user", "g")]
    talk += [(2, 0, "user", "a"), (2, 1, "assistant", "b"), (2, 2, "user", "c"), (3, 0, None, None), (None, None, "system", "s"), (4, 1, "assistant", "lone")]
    rows = chat.format_messages(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string"), Scratch(spark, "t")).collect()
    got = {(r.conv_id, r.turn): r for r in rows}
    assert len(rows) == len(talk) and {(r.conv_id, r.turn, r.role) for r in rows} == {r[:3] for r in talk}
    assert [got[1, t].depth for t in (1, 3, 5, 7)] == [0, 1, 2, 2] and [got[1, t].position for t in (1, 3, 5, 7)] == [1, 2, 3, 4]
    assert [got[2, t].depth for t in (0, 2)] == [0, 1]
    assert got[1, 0].json == '{"content":"be","id":null,"role":"system","turn":0}'
    assert got[1, 2].json == '{"content":"b","id":"1:1","role":"assistant","turn":2}' and got[1, 2].status == "answer"
    assert got[1, 6].json == '{"content":"q\\"","id":null,"role":"tool","turn":6}'
    assert got[4, 1].status == "message" and got[3, 0].json == '{"content":"","id":null,"role":null,"turn":0}'


def test_range_coder_round_trips():
    rng = np.random.default_rng(0)
    for ids in (np.zeros(0), np.arange(1), np.zeros(5000), rng.integers(0, 49408, 4000), rng.integers(0, 3, 7777), np.tile([5, 9, 400, 65535], 3000)):
        ids = ids.astype(np.int64)
        for size in (range_coder.BLOCK, 100):
            head, blocks = range_coder.encode_blocks(ids, size)
            assert list(np.concatenate([*range_coder.decode_blocks(head, blocks), np.zeros(0)])) == list(ids)
            if blocks:  # each block by itself
                assert list(range_coder.decode_blocks(head, blocks[-1:])[0]) == list(ids[(len(blocks) - 1) * size :])
    head, blocks = range_coder.encode_blocks(rng.integers(0, 49408, 500))
    block = bytearray(blocks[0])
    block[40] ^= 1
    with pytest.raises(ValueError):
        range_coder.decode_blocks(head, [bytes(block)])


def test_range_coder_mixes_its_predictions():
    rng = np.random.default_rng(1)
    bits = lambda ids: 8 * sum(map(len, range_coder.encode_blocks(np.array(ids, np.int64))[1])) / len(ids)
    loop = list(rng.permutation(40)) * 100  # each id names the next one: order 1
    twice = [x for i in range(3000) for x in ((1, 2, 30 + i % 2) if i % 2 else (3, 2, 60))]  # what follows 2 depends on what stood before it: order 2
    skewed = np.minimum(rng.geometric(0.5, 20000), 200)  # no context helps: order 0, 2 bits an id
    assert bits(loop) < 2 and bits(twice) < 1 and 1.9 < bits(skewed) < 2.3 and bits(rng.integers(0, 256, 40000)) < 8.6


def test_token_files(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    frames = token_files.write(docs, path, Scratch(spark, "t"), parts=3)
    got = {r.doc_id: r for r in token_files.read(frames).collect()}
    tok = Tokenizer.from_file(path)
    start = 0
    for i, t in enumerate(texts()):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        assert got[i].n_tokens == len(ids) and got[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    order = [(r.part, r.frame, r["first"]) for r in sorted(got.values(), key=lambda r: r.doc_id)]
    assert order == sorted(order)  # files hold the documents in ascending order
    for frames_of in (None, 60):  # one frame a file, and many
        rows = token_files.placed(token_files.write(docs, path, Scratch(spark, "t"), parts=3, frame_ids=frames_of or token_files.FRAME)).orderBy("doc_id").collect()
        start = 0
        for r in rows:
            assert r.start == start and r.n_tokens == got[r.doc_id].n_tokens and r.ids_crc32 == got[r.doc_id].ids_crc32
            start += r.n_tokens
        assert len(rows) == len(texts())
    assert token_files.placed(token_files.write(docs.limit(0), path, Scratch(spark, "t"))).count() == 0
    odd = spark.createDataFrame([(None, "b"), (4, None), (4, "a"), (None, "a"), (-3, "x")], "doc_id long, text string").withColumn("part", F.lit(7)).withColumn("frame", F.lit("x"))
    rows = token_files.placed(token_files.write(odd, path, Scratch(spark, "t"))).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, -3, 4, 4] and rows[0].ids_crc32 == zlib.crc32(np.array(tok.encode("a", add_special_tokens=False).ids + [2], "<u4").tobytes())


def test_frames_hold_frequent_words_as_one_symbol():
    rng = np.random.default_rng(6)
    flat = rng.integers(0, 49408, 4000).astype(np.uint32)
    flat[7] = 3_000_000_000
    known = [(0, 3), (3, 1), (7, 1), (10, 300), (400, 2), (402, 6), (500, 1), (600, 4)]
    word = lambda a, n: np.uint64(a << 32 | n)
    docs = [[known[i] for i in rng.integers(0, len(known), n)] + [(3999, 1)] for n in (0, 1, 30, 0, 200)] + [[(700 + 5 * i, 5) for i in range(60)]]  # the last one's words are there once
    words = np.array([word(*w) for d in docs for w in d], np.uint64)
    ids = [np.concatenate([flat[a : a + n] for a, n in d]) for d in docs]
    keys = [None, -3, 0, 4, 4, 2**40]
    symbols, length, parts, base = token_files.united(words, flat)
    assert len(symbols) == sum(map(len, docs)) + 4 * 60 and sorted(length) == [2, 3, 4, 6, 300] and len(parts) == 315 and base == 3_000_000_001
    got = token_files.unpack(token_files.pack(keys, [len(x) for x in ids], words, flat))
    assert [k for k, _ in got] == keys and all(x.tolist() == y.tolist() for (_, x), y in zip(got, ids))
    assert token_files.unpack(token_files.pack([], [], words[:0], flat)) == []
    none = token_files.unpack(token_files.pack([5], [1], words[:1] >> np.uint64(32) << np.uint64(32) | np.uint64(1), flat))
    assert none[0][0] == 5 and len(none[0][1]) == 1


def test_words_encode_as_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(5)
    tok, signs = Tokenizer.from_file(path), [*"aA'sS Σςσ\u0301\u0308\u00a0\u2003\u3000\x0b\x0c\r\n\t  0９日本<|>éİß", "'ll ", "<|endoftext|>", " <|startoftext|> ", "don't ", "J\u030c", "T\u0308. ", "<|ENDOFTEXT|>", *".,;:!? Zz"]
    texts = ["", " ", "\n\t", "x" * 5000, *("".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(3000))]
    for a in range(0, len(texts), 500):
        some = texts[a : a + 500]
        assert [x.tolist() for x in token_files.encode(some, path)] == [e.ids for e in tok.encode_batch(some, add_special_tokens=False)]
    assert token_files.encode([], path) == []


def test_media():
    for t in texts(20):
        b = (t or "").encode()
        data = media.payload(b)
        assert len(data) % 576 == 0 and data and data.startswith(b)
        for kind, form in (("audio/wav", media.to_wav), ("image/png", media.to_png)):
            blob = form(data)
            assert media.samples(blob, kind) == data and (0, len(blob), kind) in media.sniff(blob)
    gif = b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0x80, 0, 0) + b"\0" * 6 + b"," + b"\0" * 9 + b"\x02\x02L\x01\0;"
    mixed = b"RIFF GIF89a junk BM" + gif + b" text " + media.to_png(media.payload(b"x")) + b"%PDF-1.4 no end"
    assert [k for k, _ in media.carve(mixed)] == ["image/gif", "image/png"] and media.sniff(b"") == []
    assert media.look(b"nothing")[5] is None and media.look(b"nothing", "text/plain")[5] == "text/plain"
    wav = media.to_wav(media.payload(b"abc"))
    assert media.look(wav + b"tail", "image/png")[5] == "audio/wav" and media.look(wav + b"tail")[9] == 4
    cover = media.to_png(media.payload(b"cover"))
    for size in (576, 1152):  # an odd cover is padded
        blob = media.to_wav(b"a" * size, cover)
        assert media.sniff(blob)[0] == (0, len(blob), "audio/wav") and media.carve(blob) == [("image/png", cover)] and media.samples(blob, "audio/wav") == b"a" * size
    short = struct.pack("<I", len(blob) - 10) + blob[8:]
    assert media.sniff(b"RIFF" + short) == [(blob.index(cover), len(cover), "image/png")]  # a length that no chunk ends at
    assert media.sniff(gif * 2 + gif[:-1]) == [(0, len(gif), "image/gif"), (len(gif), len(gif), "image/gif")]
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xda\x00\x03cxx\xff\x00\xff\xd1y\xff\xd9"
    assert media.sniff(jpeg + b"z") == [(0, len(jpeg), "image/jpeg")] and media.sniff(jpeg[:-1]) == []
    assert media.sniff(cover + cover[:-1]) == [(0, len(cover), "image/png")]


def test_media_end_marks():
    pdf = b"%PDF-1.4 a startxref 1 %%EOF more startxref 2 %%EOF"
    assert media.sniff(pdf + b" " + pdf) == [(0, len(pdf), "application/pdf"), (len(pdf) + 1, len(pdf), "application/pdf")]
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("a", "x" * 50)
    outer = io.BytesIO()
    with zipfile.ZipFile(outer, "w") as z:  # stored as it is, so it holds the inner file's end record
        z.writestr("b", inner.getvalue())
        z.writestr("c", "y")
    assert [(s, k) for s, _, k in media.sniff(outer.getvalue())][0] == (0, "application/zip") and (2, len(outer.getvalue()), "application/zip") in media.sniff(b"--" + outer.getvalue())
    packed = gzip.compress(random.Random(1).randbytes(100_000))
    assert media.sniff(b"z" + packed + b"tail") == [(1, len(packed), "application/gzip")]
    began = time.process_time()
    zeros = b"".join(b"RIFF" + struct.pack("<I", 1_000_000) + b"WAVE" for _ in range(20_000)) + bytes(1_000_000)
    for full in (b"%PDF-" * 200_000, b"PK\x03\x04" * 200_000, b"\x1f\x8b\x08\x00" * 200_000, b"GIF89a!" * 200_000, b"GIF89a" * 20_000 + b"!\x01" * 400_000, zeros, b"\xff\xd8\xff\xda\x00\x02" * 100_000):
        assert media.sniff(full) == []
    assert time.process_time() - began < 10


def test_media_report(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(None, "x"), (5, "twice"), (5, "twice"), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("media", F.lit(1)).withColumn("declared", F.lit("q"))
    got = sorted(
        (r.doc_id is None, r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256, r.media_type, r.declared_type, r.corrected, r.feature, r.n_embedded, r.carved_sha256 or "")
        for r in media.report(frame, Scratch(spark, "t")).collect()
    )
    want = []
    for key, text in rows:
        body = (text or "").encode()
        data = body + b"\xff" * (-len(body) % 576 or (0 if body else 576))
        check, cover = zlib.crc32(data), media.to_png(data[:576])
        kind, blob = ("audio/wav", media.to_wav(data, cover)) if check % 2 else ("image/png", media.to_png(data))
        declared = media.DECLARED[check // 2 % 4]
        feature = f"{kind};samples={len(data)};high={sum(x == 255 for x in data)};space={sum(x == 32 for x in data)};line={sum(x == 10 for x in data)};embedded={'image/png' if check % 2 else ''}"
        carved = hashlib.sha256(cover).hexdigest() if check % 2 else ""
        want.append((key is None, key, len(body), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-32:]), len(blob), hashlib.sha256(blob).hexdigest(), kind, declared, declared != kind, feature, check % 2, carved))
    assert got == sorted(want) and media.report(frame.limit(0), Scratch(spark, "t")).count() == 0
    assert {w[10] for w in want} == {True, False}
    clash = media.inspect(media.media(frame).withColumn("feature", F.lit(1)).withColumn("source", F.lit("kept")))
    assert {r.source for r in clash.collect()} == {"kept"} and dict(clash.dtypes)["feature"] == "string"
    odd = spark.createDataFrame([(1, "image/gif", b"text"), (2, None, None), (None, "audio/wav", media.to_png(b"a" * 576))], "doc_id long, declared string, media binary")
    assert [r.media_type for r in media.inspect(odd.coalesce(1)).collect()] == ["image/gif", None, "image/png"] and media.inspect(odd.limit(0)).count() == 0


def test_quality_counts():
    t = "a b c d e a b c d e x\nline\nline\n\n \n#*$ |"
    counts, _ = quality.text_counts([t, "", "\n"], [t.encode(), b"", b"\n"])
    assert counts[0].tolist() == [15, sum(map(len, t.split())), 4, 1, 10] and counts[1].tolist() == [0] * 5 and counts[2].tolist() == [0] * 5


def plain_counts(text):
    """The base counts as the contract words them, over lists."""
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    times, lines = collections.Counter(windows), [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    inside = {i + j for i, x in enumerate(windows) if times[x] > 1 for j in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside)


def test_quality_of_documents(spark, docs):
    """Base counts of all documents by brute force; odd rows have one each."""
    odd = spark.createDataFrame([(None, None), (1, "a b\r\na b\n\x0b\n a b"), (1, "a b c d e " * 3), (1, "a b c d e " * 3), (2, "é#日 " * 20000)], "doc_id long, text string")
    frame = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(docs.select("doc_id", "text")).unionByName(odd).withColumn("kept", F.lit("clash")).withColumn("n_words", F.lit("clash"))
    model = quality.fit(frame, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = quality.judge(frame, model).collect()
    assert len(rows) == frame.count()
    for r in rows:
        n = plain_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0]) and not (r.base_failed and r.kept)


def test_quality_verdicts(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    forest, at = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    assert forest is not None and 0 < at < 1
    out = quality.judge(docs, (forest, at)).join(labels, "doc_id").where("not base_failed and doc_id % 2 = 1").select("quality", "kept").collect()  # rows that the forest was not fitted on
    good, bad = [r.kept for r in out if r.quality == 1], [r.kept for r in out if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.2 * len(bad) and len(bad) > 3
    assert quality.fit(docs, labels.limit(0)) is None and quality.fit(docs, labels.where("quality = 1")) is None
    assert quality.judge(docs.limit(0), None).count() == 0


def test_isolation_forest():
    rng = np.random.default_rng(3)
    usual = rng.normal(size=(400, 3)) * [1, 5, 0.1]
    odd = np.array([[0, 0, 1.5], [0, 0, 1.4], [9, 0, 0], [0, 60, 0]] * 5, float)
    rows, good = np.concatenate([usual, odd]), np.arange(420) < 400
    forest = quality.IsolationForest(rows, good)
    score = forest.score(rows)
    assert (score[~good] > np.quantile(score[good], 0.95)).all() and ((0 < score) & (score < 1)).all()
    assert (forest.score(usual[:50]) == score[:50]).all()  # a row's score is its own
    middle = forest.score(np.array([[0.0, 0.0, 0.7], [0.0, 0.0, 0.0]]))
    assert middle[0] > middle[1]  # paths tell rows apart that lie between the usual ones and the odd ones
    assert quality.IsolationForest.expected(256) == pytest.approx(10.24, abs=0.01)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    field = toxicity.fit(docs, labels)
    out = toxicity.score(docs, field).join(labels, "doc_id").select("toxic", "score", toxicity.held_out(F.col("doc_id")).alias("h")).where("h").collect()
    assert sum((r.score >= 0.5) == (r.toxic == 1) for r in out) >= 0.9 * len(out)
    none = toxicity.fit(docs, labels.limit(0))
    assert none.score("") < 0.5 and toxicity.score(docs.limit(0), none).count() == 0


def test_chain_fit_by_brute_force():
    """Runs with counts, some shorter: the slope is nil at the weights found (as there is next to no decay), by all paths of every run."""
    rng = np.random.default_rng(5)
    n, length, f = 30, 4, 2
    sizes, times = rng.integers(1, length + 1, n), rng.integers(1, 4, n)
    x = rng.random((n, length, f)) < 0.4
    x[np.arange(length)[None, :] >= sizes[:, None]] = False
    y = ((x[..., 0] & (rng.random((n, length)) < 0.8)) | (rng.random((n, length)) < 0.2)).astype(float)
    y[np.arange(length)[None, :] >= sizes[:, None]] = 0
    at, feature = np.nonzero(x.reshape(-1, f))
    weight, bias, move = toxicity.fit_chain(at, feature, f, y, sizes, times, steps=3000, rate=0.02, decay=1e-9)
    off = np.zeros(f + 5)
    for i in range(n):
        k, paths = sizes[i], []
        for path in range(2 ** sizes[i]):
            s = np.array([path >> j & 1 for j in range(k)])
            parts = np.concatenate([(x[i, :k] * s[:, None]).sum(0), [s.sum()], [((s[:-1] == a) & (s[1:] == b)).sum() for a in (0, 1) for b in (0, 1)]])
            paths.append((parts, np.exp(parts @ np.concatenate([weight, [bias], move.ravel()])), (s == y[i, :k]).all()))
        whole = sum(p for _, p, _ in paths)
        off += times[i] * (next(v for v, _, own in paths if own) - sum(v * p for v, p, _ in paths) / whole)
    assert abs(off).max() < 0.05


def test_runs_hold_every_word(spark):
    rows = spark.createDataFrame([("bad one", 1), ("bad one", 1), ("fine " * 20, 0), ("fine " * 9 + "bad", 1), ("", 1), (None, 0)], "text string, toxic int")
    got = sorted((r.size, r.place, r.feature, r.toxic_at, r.times) for r in toxicity.runs(rows, ["^bad$"]).collect())
    assert got == [(1, [0], [0], [0], 1), (2, [], [], [], 1), (2, [0], [0], [0], 2), (9, [], [], [], 3)]


def test_quality_threshold_of_unseen_rows():
    rng = np.random.default_rng(1)
    rows = np.concatenate([rng.normal(size=(600, 9)), rng.normal(8, 1, (60, 9))])
    label, half = (np.arange(660) < 600).astype(int), np.arange(660) % 2
    forest, at = quality.train(rows, label, half)
    other = quality.IsolationForest(rows[half == 0], label[half == 0] == 1)
    assert (forest.cut == other.cut).all() and at in forest.score(rows[half == 1])
    assert quality.train(rows, label, half * 0) is None and quality.train(rows[:600], label[:600], half[:600]) is None


def test_quality_learns_from_every_labelled_row(spark):
    """More than 4,000 labelled documents of one class: Spark's forest and threshold are those of all rows in memory, whatever the partitions."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(WORDS) + str(rng.randint(0, 99) if i % 12 else "#" * rng.randint(1, 40)) for _ in range(rng.randint(8, 25)))) for i in range(10_000)]
    labels = [(i, int(i % 12 > 0)) for i, _ in rows if i % 50] + [(13, 0), (None, 1)]
    docs = spark.createDataFrame(rows + [(None, "a " * 20)], "doc_id long, text string").repartition(3)
    forest, at = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    label = dict(labels) | {13: 0}
    some = [(i, t) for i, t in rows if i in label]
    counts, features = quality.text_counts([t for _, t in some], [t.encode() for _, t in some])
    passed = ~quality.base_failed(counts)
    own, half = (np.array(x)[passed] for x in ([label[i] for i, _ in some], [zlib.crc32(str(i).encode()) % 2 for i, _ in some]))
    assert (own == 1).sum() > 7000
    other, limit = quality.train(features[passed], own, half)
    assert (forest.feature == other.feature).all() and (forest.cut == other.cut).all() and (forest.path == other.path).all() and at == limit
    assert forest.norm == pytest.approx(float(forest.expected((half == 0).sum())))


def test_chain_by_brute_force():
    """Marginals by runs of unknown words equal those over all paths."""
    field = toxicity.Field(["^bad$", "^wors"], np.array([2.0, 1.5]), -1.0, np.array([[0.5, -0.5], [-0.2, 0.4]]))
    text = "ok bad fine words worse bad end"
    words = text.split()
    emit = [field.bias + sum(w for f, w in zip(field.features, field.weight) if f in toxicity.word_features(x)) for x in words]
    total, on = 0.0, [0.0] * len(words)
    for path in range(2 ** len(words)):
        y = [path >> i & 1 for i in range(len(words))]
        s = sum(e * v for e, v in zip(emit, y)) + sum(field.move[a, b] for a, b in zip([0, *y], y))
        total += np.exp(s)
        on = [o + np.exp(s) * v for o, v in zip(on, y)]
    got = {text[a:b]: p for a, b, p in field.spans(text)}
    assert got["worse"] == pytest.approx(on[4] / total)


def test_sharding_by_hand(spark, docs):
    """Every column of the query: sizes, checksums, shards by the middle of a row's bytes, slots; null and repeated keys, and texts of all sizes."""
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(None, "x"), (None, None), (7, "seven"), (7, "seven"), (-5, "y" * 5000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash")).withColumn("_part", F.lit(1)).repartition(3)
    got = sharding.assign(frame).collect()
    key = lambda k: (k is not None, k or 0)
    made = sorted(((k, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for k, t in rows), key=lambda r: (key(r[0]), r[1], r[2]))
    total, before, slots, want = sum(r[2] for r in made), 0, collections.Counter(), []
    for k, crc, size in made:
        shard = min(39, int((before + size / 2) * 40 / total))
        want.append((k, size, crc, "bytes", shard, slots[shard], None))
        slots[shard] += 1
        before += size
    order = lambda r: (key(r[0]), *r[1:6])
    assert sorted((tuple(r) for r in got), key=order) == sorted(want, key=order)
    assert sharding.assign(frame.limit(0)).count() == 0


def test_sharding(spark, docs):
    keyed = keyed_text(docs)
    out = sharding.shard_by_bytes(keyed, "doc_id", F.octet_length("text") + 16, 7, parts=3).orderBy("doc_id").collect()
    assert [r.shard for r in out] == sorted(r.shard for r in out) and len(out) == docs.count()
    slots = collections.defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(s == list(range(len(s))) for s in slots.values())
    total, most = sum(r.size for r in out), max(r.size for r in out)
    for k in slots:
        assert abs(sum(r.size for r in out if r.shard == k) - total / 7) <= 2 * most
    assert sharding.shard_by_bytes(keyed.limit(0), "doc_id", F.lit(1), 7).count() == 0
