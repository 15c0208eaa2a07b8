"""Language identification with error-correcting output codes.

Every language gets a codeword; for each bit a binary classifier over hashed character n-grams
learns to tell the languages whose bit is 1 from those whose bit is 0. A text gets the language
whose codeword has the smallest loss, each bit weighted by how well its classifier does on the
sample. The ratio of the two best losses says how sure that is.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.shared import U, mix

#: Bound of the training sample: documents, an equal number per language.
SAMPLE = 4000
FEATURES = 2048
#: Languages are a small set; more distinct values raise an error.
MAX_LANGUAGES = 200
AMBIGUOUS = 0.55
_EPOCHS = 150
_SLICE = 1 << 19  # characters at once
_DECODED = 512  # rows that are decoded at once

_TABLE: dict[str, np.ndarray] = {}


def _folded() -> np.ndarray:
    """Code point -> lower-case letter's code point, or 0 for what is not a letter."""
    if "fold" not in _TABLE:
        table = np.zeros(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _TABLE["fold"] = table
    return _TABLE["fold"]


def _vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Square roots of the shares of hashed 1- to 4-grams of letters, per text; letter counts.

    Runs of other characters count as one boundary each.
    """
    joined = "\0".join([*texts, ""])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    letters = _folded()[codes]
    keep = letters > 0
    keep[1:] |= letters[:-1] > 0  # the boundary after a letter
    keep[:1] |= letters[:1] > 0
    x, row = letters[keep].astype(U), row[keep]
    counts = np.bincount(row[x > 0], minlength=len(texts))
    out = np.zeros((len(texts), FEATURES), dtype=np.float32)
    gram = np.zeros(len(x), dtype=U)
    for n in range(1, 5):
        size = len(x) - n + 1
        if size <= 0:
            break
        gram = gram[:size] * U(0x9E3779B97F4A7C15) + x[n - 1 :]
        same = row[:size] == row[n - 1 :]
        slot = (mix(gram[same], n) % U(FEATURES)).astype(np.int64)
        out += np.bincount(
            row[:size][same] * FEATURES + slot, minlength=out.size
        ).reshape(out.shape)
    total = out.sum(axis=1, keepdims=True)
    return np.sqrt(out / np.maximum(total, 1)), counts


def codewords(n: int) -> np.ndarray:
    """n codewords of -1 and 1, every column a different split of the languages.

    Up to five languages: all 2**(n-1) - 1 splits. More: the best separated of 64 sets of random
    splits from a fixed seed.
    """
    if n < 2:
        return np.zeros((n, 0))
    if n <= 5:
        splits = [s for s in itertools.product((1, -1), repeat=n - 1) if -1 in s]
        return np.array([(1, *s) for s in splits]).T
    rng = np.random.default_rng(n)
    bits = max(15, math.ceil(10 * math.log2(n)))
    best, best_gap = None, -1
    for _ in range(64):
        code = rng.choice((-1, 1), size=(n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        apart = (code.shape[1] - code @ code.T) / 2
        gap = apart[~np.eye(n, dtype=bool)].min()
        if gap > best_gap:
            best, best_gap = code, gap
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    trust: np.ndarray  # weight of every bit, they sum to 1

    def decode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best language and share of it against the second best, for every row."""
        n = len(self.languages)
        if n == 1:
            return np.zeros(len(vectors), dtype=int), np.ones(len(vectors))
        margin = vectors @ self.weights + self.bias
        loss = np.zeros((len(vectors), n))
        for k in range(n):
            loss[:, k] = np.logaddexp(0, -margin * self.code[k]) @ self.trust
        best = loss.argmin(axis=1)
        ordered = np.sort(loss, axis=1)
        with np.errstate(invalid="ignore"):
            score = ordered[:, 1] / (ordered[:, 0] + ordered[:, 1])
        return best, np.clip(np.nan_to_num(score, nan=0.5), 0, 1)


def fit(vectors: np.ndarray, labels: np.ndarray, languages: list[str]) -> Model:
    """One logistic classifier per bit by gradient descent with momentum, from zero weights."""
    code = codewords(len(languages))
    bits = code.shape[1]
    weights = np.zeros((vectors.shape[1], bits), dtype=np.float32)
    bias = np.zeros(bits, dtype=np.float32)
    if not bits:
        return Model(languages, code, weights, bias, np.zeros(0))
    target = code[labels].astype(np.float32)
    counts = np.bincount(labels, minlength=len(languages))
    balance = (1.0 / counts[labels] / len(languages)).astype(np.float32)[:, None]
    speed, lift = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(_EPOCHS):
        margin = target * (vectors @ weights + bias)
        pull = -balance * target / (1 + np.exp(np.clip(margin, -30, 30)))
        speed = 0.9 * speed + vectors.T @ pull + 1e-5 * weights
        lift = 0.9 * lift + pull.sum(axis=0)
        weights -= 8.0 * speed
        bias -= 2.0 * lift
    right = ((vectors @ weights + bias) * target > 0).astype(float)
    error = np.clip(((1 - right) * balance).sum(axis=0), 1e-3, 0.499)
    trust = np.log((1 - error) / error)
    return Model(languages, code, weights, bias, trust / trust.sum())


def _training_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for a, b in _cuts(texts):
            vectors, _ = _vectors(texts[a:b])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a),
                    pa.array([v.tobytes() for v in vectors.astype(np.float16)], pa.binary()),
                ],
                ["lang", "vector"],
            )


def _cuts(texts: list[str]) -> list[tuple[int, int]]:
    out, start, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= _SLICE or i + 1 - start >= 256:
            out.append((start, i + 1))
            start, size = i + 1, 0
    if start < len(texts):
        out.append((start, len(texts)))
    return out


def _held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on about ``sample`` labelled documents, the same number of each language.

    Learns from text and lang of rows whose crc32(doc_id) mod 4 is not 2. The sample is drawn by
    a hash of text and id, of whole texts; the languages are all values of lang in these rows.
    """
    labelled = docs.select("doc_id", "text", "lang").where(
        "doc_id is not null and text is not null and lang is not null"
    ).where(~_held_out())
    languages = labelled.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    sizes = {r.lang: r["count"] for r in languages}
    names = sorted(sizes)
    if not names:
        return Model([], np.zeros((0, 0)), np.zeros((FEATURES, 0)), np.zeros(0), np.zeros(0))
    each = max(10, sample // len(names))
    draw = F.shiftrightunsigned(F.xxhash64("text", "doc_id"), 33) / F.lit(2.0**31)
    rate = F.lit(0.0)
    for name in names:  # about 1.2 times as many as wanted, then the smallest hashes
        rate = F.when(
            F.col("lang") == name, F.lit(min(1.0, 1.2 * each / sizes[name]))
        ).otherwise(rate)
    drawn = labelled.withColumn("draw", draw).where(F.col("draw") <= rate)
    rows = (
        drawn.select("lang", "text").mapInArrow(_training_vectors, "lang string, vector binary")
        .select("lang", "vector", F.xxhash64("vector").alias("order"))
        .collect()
    )
    rows.sort(key=lambda r: (r.lang, r.order, bytes(r.vector)))
    chosen = []
    for name in names:
        chosen += [r for r in rows if r.lang == name][:each]
    vectors = np.array([np.frombuffer(r.vector, np.float16) for r in chosen], dtype=np.float32)
    labels = np.array([names.index(r.lang) for r in chosen])
    present = [i for i in range(len(names)) if (labels == i).any()]
    labels = np.searchsorted(present, labels)
    return fit(vectors, labels, [names[i] for i in present])


def _predictor(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for a, b in _cuts(texts):
                vectors, letters = _vectors(texts[a:b])
                if fitted.languages:
                    best, score = fitted.decode(vectors)
                    names = [fitted.languages[i] for i in best]
                else:
                    names, score = ["und"] * (b - a), np.zeros(b - a)
                empty = letters == 0
                score = np.where(empty, 0.0, score)
                names = ["und" if e else n for e, n in zip(empty, names)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array(names, pa.string()),
                        pa.array(score.astype(np.float64)),
                        pa.array((score < AMBIGUOUS) | empty),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
                )

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous), one row per row of ``docs``.

    Only the whole text is read. Null texts and texts without a letter are ``und`` with score 0;
    so is everything if no language was learned. score is the second smallest loss over the sum
    of the two smallest: 0.5 for a tie (the first language in order wins), near 1 if clear.
    ``ambiguous``: score below 0.55, or ``und``. A null id is not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(_held_out(), F.lit(False)).alias("held_out"),
        "text",
    ).mapInArrow(
        _predictor(shared),
        "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean",
    )


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    return predict(docs, train(docs, sample))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents in a learned language, row by row; ``und`` and ambiguous ones go."""
    model = train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_identified(shared, docs.columns.index("text")), docs.schema)


def _identified(model, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        for batch in batches:
            for start in range(0, batch.num_rows if fitted.languages else 0, _DECODED):
                part = batch.slice(start, _DECODED)
                texts = [t or "" for t in part.column(column).to_pylist()]
                found = np.zeros(len(texts), dtype=bool)
                for a, b in _cuts(texts):
                    vectors, letters = _vectors(texts[a:b])
                    _, score = fitted.decode(vectors)
                    found[a:b] = (letters > 0) & (score >= AMBIGUOUS)
                yield part.filter(pa.array(found))

    return run
