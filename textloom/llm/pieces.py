"""Exact merge-type encoding by backtracking, and decoding, for SentencePiece BPE models.

A sequence of tokens is the merge procedure's result when every two neighbours
are: the pair, joined and merged again, must come apart in the same two tokens. So the
encoder walks over a word with the longest tokens that an Aho-Corasick
automaton finds at each place, steps to shorter ones where a neighbour
is not compatible, and goes back where none is, with failed places kept as bits
of a number so that none is tried twice.

No token of such a model holds a space mark after another character, so the text
may be cut before each run of marks; words are remembered in a bounded memo. Runs of two or more
marks meet tokens of one common score, whose merges depend on the place; these
runs are merged step by step.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import arrow_schema, documents

MARK = "▁"
MEMO = 200_000  # stretches in each of two generations


class PieceCoder:
    """Encoder and decoder of one model; without normalisation beyond the space marks (an identity model)."""

    def __init__(self, path: str, memo: int = MEMO):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("only BPE models with identity normalisation and a dummy prefix")
        self.pieces = [p.piece for p in model.pieces]
        self.kind = [p.type for p in model.pieces]
        self.score = {p.piece: p.score for p in model.pieces if p.type == 1}
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kind[i] == 1}
        if any(a != MARK and b == MARK for p in self.ids for a, b in zip(p, p[1:])):
            raise ValueError("a token holds a space mark after another character")
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kind[i] == 6}
        self.end = self.pieces.index("</s>")
        self.plain = [(" " * p.count(MARK) + p.lstrip(MARK) if MARK in p else p) if k == 1 else None for p, k in zip(self.pieces, self.kind)]
        self.raw = {i: b for b, i in self.byte.items()}
        self.text_of = [chr(self.raw[i]) if self.raw.get(i, 128) < 128 else p or "" for i, p in enumerate(self.plain)]
        self.beyond_ascii = frozenset(i for i, b in self.raw.items() if b > 127)
        self.fallback = [k == 6 for k in self.kind]
        self.parts: dict[str, tuple[str, str]] = {}  # the last merge of each token
        whole = [p for p in self.ids if len(p) == 1 or self._last_merge(p)]  # others can't come out of merges
        self.falling = all(self.score[p] < self.score[x] for p, two in self.parts.items() for x in two if len(x) > 1 and p.strip(MARK))
        self.edges = {p: (self._edge(p, 0), self._edge(p, 1)) for p in whole}
        self.auto = ahocorasick.Automaton()
        for p in whole:
            self.auto.add_word(p, len(p))
        self.auto.make_automaton()
        known = set(whole)
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in known or k == 1), None) for p in whole}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.limit = memo
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.written = [str(i) for i in range(len(self.pieces))]

    def merged(self, text: str, but: str | None = None) -> list[str]:
        """The merge procedure itself: always the neighbours whose joined token scores best, the leftmost of equals. `but` is not made."""
        part, after, before = list(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        n, heap = len(part), []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (s := self.score.get(part[i] + part[j])) is not None and part[i] + part[j] != but:
                heapq.heappush(heap, (-s, i, len(part[i]) + len(part[j]), part[i] + part[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, _, joined = heapq.heappop(heap)
            if not part[i] or after[i] >= n or part[i] + part[after[i]] != joined:
                continue
            j = after[i]
            part[i], part[j], after[i] = joined, "", after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in part if p]

    def _last_merge(self, piece: str) -> bool:
        """Whether the merges of a piece's characters end in the piece; if so, its last two parts are noted."""
        for k in range(1, len(piece)):  # its parts can only be two tokens
            if piece[:k] not in self.ids or piece[k:] not in self.ids:
                continue
            if self.merged(piece, but=piece) == [piece[:k], piece[k:]]:
                self.parts[piece] = piece[:k], piece[k:]
                return self.merged(piece) == [piece]
        return False

    def _edge(self, piece: str, side: int) -> list[tuple[str, float]]:
        """The parts that stand at one edge while a token is merged, from its character to itself, each with the score of the merge that takes it."""
        chain, taken = [], float("-inf")
        while True:
            chain.append((piece, taken))
            if piece not in self.parts:
                return chain[::-1]
            taken, piece = self.score[piece], self.parts[piece][side]

    def compatible(self, a: str, b: str) -> bool:
        """Whether a and b, merged again as one text, come apart as a and b."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= self.limit:
                self.pairs.clear()
            known = self.pairs[a, b] = self._remerge(a, b)
        return known

    def _remerge(self, a: str, b: str) -> bool:
        if a not in self.edges or b not in self.edges:
            return True  # a character that is no token joins with nothing
        if not self.falling:
            return self.merged(a + b) == [a, b]
        # Only parts at the cut can meet. Merges go by falling score, so both edges are played
        # forward in step; the cut is crossed when a joined part comes before both next merges.
        left, right, i, j = self.edges[a][1], self.edges[b][0], 0, 0
        while True:
            (p, p_taken), (q, q_taken) = left[i], right[j]
            joined = self.score.get(p + q)
            if joined is not None and joined > p_taken and joined >= q_taken:  # the leftmost of equals goes first
                return False
            if p_taken == q_taken == float("-inf"):
                return True
            if p_taken >= q_taken:
                i += 1
            else:
                j += 1

    def backtracked(self, word: str) -> list[str]:
        """Tokens of a stretch; characters that are no token stand alone and join with nothing."""
        size = len(word)
        longest = [1] * (size + 1)
        for end, n in self.auto.iter(word):  # of one start, the longer match comes later
            longest[end - n + 1] = n
        failed = 0  # bit n: no tokens fit from place n on
        pairs, shorter, compatible = self.pairs, self.shorter, self.compatible
        tokens: list[str] = []
        pos, token, last = 0, word[: longest[0]], None
        while pos < size:
            while token is not None:
                end = pos + len(token)
                if not (failed and failed >> end & 1):
                    fits = last is None or pairs.get((last, token))
                    if fits or fits is None and compatible(last, token):
                        break
                token = shorter.get(token)
            if token is not None:
                tokens.append(token)
                last, pos = token, end
                token = word[end : end + longest[end]]
            else:
                failed |= 1 << pos
                token = tokens.pop()
                last = tokens[-1] if tokens else None
                pos -= len(token)
                token = shorter.get(token)
        return tokens

    def _ids(self, tokens: list[str]) -> list[int]:
        out: list[int] = []
        for t in tokens:
            i = self.ids.get(t)
            if i is None:
                out += [self.byte[b] for b in t.encode()]
            else:
                out.append(i)
        return out

    def stretch(self, rest: str, marks: int = 1) -> tuple[int, ...]:
        """Ids of a stretch: some marks and the characters up to the next ones. Short stretches are remembered, in two generations of a bounded size."""
        if marks > 1 or len(rest) > 64:
            word = MARK * marks + rest
            return tuple(self._ids(self.merged(word) if marks > 1 else self.backtracked(word)))
        got = self.old.get(rest)
        if got is None:
            got = tuple(self._ids(self.backtracked(MARK + rest)))
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        self.young[rest] = got
        return got

    def encode(self, text: str, end: bool = True) -> list[int]:
        out: list[int] = []
        if text and "  " not in text and MARK not in text and text[0] != " ":
            for w in text.split(" "):
                out += self.young.get(w) or self.stretch(w)
        elif text:
            for run, rest in re.findall(f"({MARK}+)([^{MARK}]*)", (MARK + text).replace(" ", MARK)):
                out += self.stretch(rest, len(run))
        if end:
            out.append(self.end)
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids: control ids vanish, runs of byte ids are read as UTF-8 (a wrong byte as U+FFFD), one space in front goes."""
        plain, out, run = self.plain, [], bytearray()
        if self.beyond_ascii.isdisjoint(ids):
            text = "".join(map(self.text_of.__getitem__, ids))
            return text[1:] if text.startswith(" ") else text
        for i in ids:
            if self.fallback[i]:
                run.append(self.raw[i])
                continue
            if run:
                out.append(_utf8(run))
                run = bytearray()
            out.append(plain[i] or "")
        if run:
            out.append(_utf8(run))
        text = "".join(out)
        return text[1:] if text.startswith(" ") else text


def _utf8(run: bytearray) -> str:
    try:
        return run.decode()
    except UnicodeDecodeError:
        text, at = "", 0
        while at < len(run):
            for n in (1, 2, 3, 4):
                try:
                    text, at = text + run[at : at + n].decode(), at + n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                text, at = text + "�", at + 1
        return text


_coders: dict[str, PieceCoder] = {}


def coder(path: str) -> PieceCoder:
    """One coder a Python worker."""
    if path not in _coders:
        _coders[path] = PieceCoder(path)
    return _coders[path]


def encode(docs: DataFrame, model: str, text: str = "text", ids: bool = True) -> DataFrame:
    """docs with `piece_ids` (if asked for), `n_tokens`, `ids_sha256`, `decoded_sha256`.

    A null or empty text has the end id alone and decodes to nothing. Repeated rows are encoded each; columns with these names are
    replaced. `model` is a path that every executor can open.
    """
    names = ["piece_ids"] * ids + ["n_tokens", "ids_sha256", "decoded_sha256"]
    kinds = [T.ArrayType(T.IntegerType())] * ids + [T.LongType(), T.StringType(), T.StringType()]
    held = [f for f in docs.schema.fields if f.name not in names]
    out = T.StructType(held + [T.StructField(n, k) for n, k in zip(names, kinds)])
    docs = docs.select(*[F.col(f"`{f.name}`") for f in held])

    def run(batches):
        schema, own = arrow_schema(out), coder(model)
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            for a in range(0, batch.num_rows, 256):
                rows = []
                for t in column.slice(a, 256).to_pylist():
                    flat = own.encode(t or "")
                    written = " ".join(map(own.written.__getitem__, flat))
                    back = own.decode(flat)
                    rows.append(([flat] if ids else []) + [len(flat), hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()])
                columns = [*batch.slice(a, 256).columns, *[pa.array(c, schema.field(n).type) for n, c in zip(names, zip(*rows))]]
                yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, schema.types)], schema=schema)

    return docs.mapInArrow(run, out)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """op1: every whole text in ids with an end id, and decoded again."""
    return encode(documents(spark, sf_dir).select("doc_id", "text"), model or model_path(), ids=False).drop("text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ids; the last stage."""
    return encode(docs, model_path())
