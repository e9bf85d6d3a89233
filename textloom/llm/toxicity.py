"""Toxic spans by a linear-chain conditional random field, and scores of documents from its marginals.

Labels are given for documents, so tokens are labelled from them: a feature (a
word or an affix of one) that appears in at least MIN_DOCS toxic documents of a bounded
training sample and in next to no clean one makes a token of a toxic document toxic. So the field learns this lexicon's weights anew,
and from the chain how toxic words follow each other. It has the states clean and
toxic; its weights (one a feature, a bias, four transitions) are fitted by gradient ascent on the log-likelihood of
all words of the sampled documents, cut into runs of LENGTH words (the last one of a document may be shorter). Runs that agree in their known
features and labels are one row with a count, so the many runs without a known word cost next to nothing.

A word is a run of letters (WORD), in training, scoring and the counts of unknown words alike.

Scoring runs forward-backward over the whole text. Words without a known
feature share one potential, so a run of n of them is the n-th power of one 2x2 matrix;
the recursion steps over known words only, and the result is the same as over
every word. The marginals of a document (the greatest and their sum) give its score by a
logistic curve fitted on the same sample.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import arrow_schema, documents, free_prefix, slices

SAMPLE = 3000  # labelled documents a class
MIN_DOCS = 8
PURITY = 20.0  # times as frequent in toxic documents
AFFIX = (4, 5, 6, 7)
STEPS = 120
LENGTH = 9
WORD = re.compile(r"[^\W\d_]+")


def lowered(text: str) -> str:
    """Lower case with every place kept."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def letter(c: str) -> bool:
    """Whether a character may stand in a word: what WORD matches."""
    return c.isalnum() and not c.isdecimal()


def word_features(word: str) -> set[str]:
    """`^word$` and the prefixes, suffixes of some lengths, marked at the word's edge."""
    whole = f"^{word}$"
    return {whole} | {whole[: n + 1] for n in AFFIX if n < len(word)} | {whole[-n - 1 :] for n in AFFIX if n < len(word)}


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, text, toxic) of at most `sample` documents a class, outside the held-out fold: one row a document, with the least of its texts;
    a document with both labels is toxic."""
    folds = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = [folds.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for c in (0, 1)]
    return docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def lexicon(rows: DataFrame) -> list[str]:
    """All features that mark toxic documents, by counts over the training documents: a toxic document of the sample adds its words, and at least MIN_DOCS must hold a feature."""

    def run(batches):
        for batch in batches:
            got, found, labels = batch.to_pydict(), [], []
            for text, toxic in zip(got["text"], got["toxic"]):
                seen: set[str] = set()
                for word in set(WORD.findall(lowered(text or ""))):
                    seen |= word_features(word)
                found += seen
                labels += [toxic] * len(seen)
                if len(found) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(labels, pa.int32())], names=["feature", "toxic"])
                    found, labels = [], []
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(labels, pa.int32())], names=["feature", "toxic"])

    counts = rows.select("text", "toxic").mapInArrow(run, "feature string, toxic int").groupBy("feature").agg(F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good"))
    top = counts.where((F.col("bad") >= MIN_DOCS) & (F.col("bad") >= PURITY * F.col("good")))
    return sorted(r.feature for r in top.select("feature").collect())


class Field:
    """Chain with two states. bias, weight[f]: score of toxic; move[a, b]: score of state b after a."""

    def __init__(self, features: list[str], weight: np.ndarray, bias: float, move: np.ndarray, curve=(0.0, 0.0, 0.0)):
        self.features, self.weight, self.bias, self.move, self.curve = features, weight, bias, move, curve
        self._auto = None

    def __getstate__(self):
        return self.__dict__ | {"_auto": None, "_grown": None}

    def find(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, score of toxic) of each word that has known features, in order."""
        if not self.features:
            return []
        if self._auto is None:
            self._auto = ahocorasick.Automaton()
            for f, w in zip(self.features, self.weight):
                core = f.strip("^$")
                old = self._auto.get(core, ())
                self._auto.add_word(core, (*old, (f, float(w), len(core))))
            self._auto.make_automaton()
        hits: dict[int, list] = {}
        for end, known in self._auto.iter(text):
            for f, w, n in known:
                a, b = end - n + 1, end + 1
                if f[0] == "^" and a and letter(text[a - 1]) or f[-1] == "$" and b < len(text) and letter(text[b]):
                    continue
                while f[0] != "^" and a and letter(text[a - 1]):
                    a -= 1
                while f[-1] != "$" and b < len(text) and letter(text[b]):
                    b += 1
                word = hits.setdefault(a, [b, 0.0, set()])
                if f not in word[2]:
                    word[1] += w
                    word[2].add(f)
        return [(a, hits[a][0], hits[a][1]) for a in sorted(hits)]

    def power(self, n: int) -> np.ndarray:
        """n unknown words in a row, scaled to a sum of 1."""
        m = np.exp(self.move) * np.exp([0.0, self.bias])[None, :]
        out, m = np.eye(2), m / m.sum()
        while n:
            if n & 1:
                out = out @ m
                out /= out.sum()
            m, n = m @ m, n >> 1
            m /= m.sum()
        return out

    def spans(self, text: str) -> list[tuple[int, int, float]]:
        """Known words with their marginal of toxic by forward-backward over all words."""
        low = lowered(text)
        known = self.find(low)
        if not known:
            return []
        at, gaps = 0, []
        for a, b, _ in known:
            gaps.append(len(WORD.findall(low, at, a)))
            at = b
        gaps.append(len(WORD.findall(low, at)))
        steps = [self.power(n) for n in gaps]
        potentials = [np.exp(np.clip([0.0, self.bias + s], -30, 30)) for _, _, s in known]
        move, forward = np.exp(self.move), []
        state = np.array([1.0, 0.0])  # before the first word: clean
        for step, p in zip(steps, potentials):
            state = (state @ step) @ move * p
            state /= state.sum()
            forward.append(state)
        back, out = np.ones(2), [0.0] * len(known)
        for i in range(len(known) - 1, -1, -1):
            back = steps[i + 1] @ back if i == len(known) - 1 else steps[i + 1] @ (move @ (potentials[i + 1] * back))
            back /= back.sum()
            both = forward[i] * back
            out[i] = float(both[1] / both.sum())
        return [(a, b, p) for (a, b, _), p in zip(known, out)]

    def evidence(self, text: str) -> tuple[float, float]:
        return self.summed(self.spans(text))

    @staticmethod
    def summed(spans: list[tuple[int, int, float]]) -> tuple[float, float]:
        p = [p for _, _, p in spans]
        return (max(p), float(np.log1p(sum(p)))) if p else (0.0, 0.0)

    def score(self, text: str) -> float:
        return self.scored(*self.evidence(text))

    def scored(self, top: float, total: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.curve[0] + self.curve[1] * top + self.curve[2] * total, -30, 30))))


def fit_chain(place: np.ndarray, feature: np.ndarray, features: int, y: np.ndarray, sizes: np.ndarray, times: np.ndarray, steps: int = STEPS, rate: float = 0.1, decay: float = 1e-3) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias and transitions that maximise the log-likelihood of the state paths y (runs x length).

    place, feature: the features that hold, each with its word's place in y read row by row; a run has its first `sizes` words and
    counts `times`. Adam steps on the exact gradient: observed less expected counts, the expected ones from forward-backward.
    """
    (n, length), f = y.shape, features
    there = np.arange(length)[None, :] < sizes[:, None]
    one, two = there * times[:, None].astype(float), there[:, 1:] * times[:, None].astype(float)
    scale = max(1.0, float(times[np.unique(place // length)].sum()))  # runs with a known word
    theta = np.zeros(f + 5)
    moment, second = np.zeros_like(theta), np.zeros_like(theta)
    counts = lambda states: np.bincount(feature, weights=states.ravel()[place], minlength=f)
    pairs = np.stack([((y[:, :-1] == a) & (y[:, 1:] == b)).astype(float).ravel() @ two.ravel() for a in (0, 1) for b in (0, 1)])
    seen = np.concatenate([counts(y * one), [(y * one).sum()], pairs])
    for step in range(1, steps + 1):
        score = np.bincount(place, weights=theta[feature], minlength=n * length).reshape(n, length) + theta[f]
        emit = np.exp(np.clip(np.stack([np.zeros((n, length)), score], -1), -30, 30))
        move = np.exp(theta[f + 1 :].reshape(2, 2))
        ahead, behind = np.empty((n, length, 2)), np.ones((n, length, 2))
        ahead[:, 0] = emit[:, 0] / emit[:, 0].sum(-1, keepdims=True)
        for i in range(1, length):
            ahead[:, i] = ahead[:, i - 1] @ move * emit[:, i]
            ahead[:, i] /= ahead[:, i].sum(-1, keepdims=True)
        for i in range(length - 2, -1, -1):
            behind[:, i] = np.where(there[:, i + 1, None], (behind[:, i + 1] * emit[:, i + 1]) @ move.T, 1.0)
            behind[:, i] /= behind[:, i].sum(-1, keepdims=True)
        single = ahead * behind
        single /= single.sum(-1, keepdims=True)
        joint = ahead[:, :-1, :, None] * move * (emit * behind)[:, 1:, None, :]
        joint /= joint.sum((-1, -2), keepdims=True)
        toxic = single[..., 1] * one
        expected = np.concatenate([counts(toxic), [toxic.sum()], np.einsum("nl,nlab->ab", two, joint).ravel()])
        slope = (seen - expected) / scale - decay * theta
        moment, second = 0.9 * moment + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta += rate * (moment / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:f], float(theta[f]), theta[f + 1 :].reshape(2, 2)


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 500) -> tuple[float, float, float]:
    """Logistic curve over the two evidence values with balanced classes."""
    z = np.column_stack([np.ones(len(x)), x])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    beta = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-4 * np.eye(3)
        step = np.linalg.solve(hess, z.T @ (weight * (y - p)) - 1e-4 * beta)
        beta = beta + step
        if abs(step).max() < 1e-8:
            break
    return tuple(map(float, beta))


def runs(rows: DataFrame, features: list[str], length: int = LENGTH) -> DataFrame:
    """All words of (text, toxic) rows in runs of `length`: size, the places and numbers of known features, the places of toxic words, and how many runs are alike."""
    number = {f: i for i, f in enumerate(features)}
    shared = rows.sparkSession.sparkContext.broadcast((Field(features, np.ones(len(features)), 0.0, np.zeros((2, 2))), number))
    names = ["size", "place", "feature", "toxic_at"]
    ints = pa.list_(pa.int32())

    def run(batches):
        rough, number = shared.value
        for batch in slices(batches, 64):
            got, out = batch.to_pydict(), []
            for text, toxic in zip(got["text"], got["toxic"]):
                low = lowered(text or "")
                known = {a: b for a, b, _ in rough.find(low)}
                words = [m.start() for m in WORD.finditer(low)]
                for lo in range(0, len(words), length):
                    part = words[lo : lo + length]
                    held = [(i, sorted(number[f] for f in word_features(low[a : known[a]]) if f in number)) for i, a in enumerate(part) if a in known]
                    out.append((len(part), [i for i, fs in held for _ in fs], [f for _, fs in held for f in fs], [i for i, fs in held if fs and toxic == 1]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, [pa.int32(), ints, ints, ints])], names=names)

    cut = rows.select("text", "toxic").mapInArrow(run, "size int, place array<int>, feature array<int>, toxic_at array<int>")
    return cut.groupBy(*names).agg(F.count("*").alias("times"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """The field of a bounded labelled sample. With labels of one class or none, no feature is known and every score is the base's."""
    rows = training_rows(docs, labels, sample)
    features = lexicon(rows)
    got = runs(rows, features).orderBy("size", "place", "feature", "toxic_at").toArrow().combine_chunks() if features else None
    if got is None or not got.num_rows:
        return Field([], np.zeros(0), 0.0, np.zeros((2, 2)), (-2.0, 0.0, 0.0))

    def flat(column: str) -> tuple[np.ndarray, np.ndarray]:
        lists = got.column(column)
        return np.repeat(np.arange(got.num_rows), pc.list_value_length(lists).to_numpy()), pc.list_flatten(lists).to_numpy()

    owner, place = flat("place")
    feature = flat("feature")[1]
    y = np.zeros((got.num_rows, LENGTH))
    y[flat("toxic_at")] = 1
    chain = fit_chain(owner * LENGTH + place, feature, len(features), y, got.column("size").to_numpy(), got.column("times").to_numpy())
    field = Field(features, *chain)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def weigh(batches):
        for batch in batches:
            rows = batch.to_pydict()
            seen = [shared.value.evidence(t or "") for t in rows["text"]]
            yield pa.RecordBatch.from_arrays([pa.array(rows["doc_id"], pa.int64()), pa.array(rows["toxic"], pa.int32()), pa.array([a for a, _ in seen], pa.float64()), pa.array([b for _, b in seen], pa.float64())], names=["doc_id", "toxic", "top", "total"])

    seen = rows.mapInArrow(weigh, "doc_id long, toxic int, top double, total double").collect()
    seen.sort(key=lambda r: r.doc_id)
    field.curve = fit_curve(np.array([(r.top, r.total) for r in seen]), np.array([r.toxic for r in seen]))
    return field


def score(docs: DataFrame, field: Field, text: str = "text", prefix: str = "") -> DataFrame:
    """docs with `score` (0 to 1) and `toxic_spans` (start, end, marginal of each word that is toxic by 0.5 or more).

    A null or empty text has no span and the score of no evidence. Repeated rows and rows without a doc_id are scored each. An empty
    frame gives an empty result. Columns with these names are replaced; `prefix` goes before them.
    """
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("p", T.DoubleType())]))
    held = [f for f in docs.schema.fields if f.name not in (f"{prefix}score", f"{prefix}toxic_spans")]
    out = T.StructType([*held, T.StructField(f"{prefix}score", T.DoubleType()), T.StructField(f"{prefix}toxic_spans", span)])
    docs = docs.select(*[F.col(f"`{f.name}`") for f in held])
    shared = docs.sparkSession.sparkContext.broadcast(field)  # weights of the sample's features

    def run(batches):
        schema, model = arrow_schema(out), shared.value
        for batch in slices(batches):
            texts = [x or "" for x in batch.column(batch.schema.names.index(text)).to_pylist()]
            scores, spans = [], []
            for t in texts:
                found = model.spans(t)
                scores.append(model.scored(*model.summed(found)))
                spans.append([{"start": a, "end": b, "p": q} for a, b, q in found if q >= 0.5])
            columns = [*batch.columns, pa.array(scores, pa.float64()), pa.array(spans, schema.field(f"{prefix}toxic_spans").type)]
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, schema.types)], schema=schema)

    return docs.mapInArrow(run, out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: the score of every document; labels of the held-out fifth are never read into the model."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    field = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, field).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("toxic_spans").cast("long").alias("n_toxic_words")
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5, with their own columns; each of repeated rows is judged by its own text."""
    field = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    prefix = free_prefix(docs)
    return score(docs, field, prefix=prefix).where(F.col(f"{prefix}score") < 0.5).select(*docs.columns)
