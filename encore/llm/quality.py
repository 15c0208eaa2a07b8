"""Quality rules: distance of a document's histograms from those of the languages.

Two histograms are compared with references by Jensen-Shannon distance (base 2, so 0 to 1):
classes of characters, and common words. A reference exists for every value of ``lang``; it is
summed over all documents with that value. Common words have at least 0.5% of the words of a
language. A document is compared with every reference and the nearest counts, so its own lang
is not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.shared import _IS_SPACE, U, hashed_words, mix, slices

COMMON_SHARE = 0.005
#: Counters per task and language; a word's count is too low by 1/COUNTERS of all words at most.
COUNTERS = 4096
MAX_LANGUAGES = 200
#: A histogram is judged from so many of its items on.
LEAST_CHARS, LEAST_WORDS = 200, 50
#: Distances above these, plus what chance gives a text of that length, are rejected.
CHAR_LIMIT, WORD_LIMIT = 0.16, 0.12

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CONTINUED = np.zeros(256, dtype=bool)
_CONTINUED[0x80:0xC0] = True
#: Bytes that separate letter runs: all of ASCII but a-z (texts are lower-cased first).
_NO_LETTER = np.zeros(256, dtype=bool)
_NO_LETTER[:0x80] = True
_NO_LETTER[list(range(0x61, 0x7B))] = False

CLASSES = ["small", "capital", "digit", "space", "sentence", "other_ascii", "beyond_ascii"]
_CLASS = np.full(256, 5, dtype=np.int64)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A] = 0, 1, 2
_CLASS[_IS_SPACE] = 3
_CLASS[list(b".,;:!?'\"()-")] = 4
_CLASS[0x80:] = 6


@dataclass
class References:
    languages: list[str]
    chars: np.ndarray  # languages x classes, shares
    common: np.ndarray  # sorted hashes of the common words of all languages
    words: np.ndarray  # languages x (common words, other), shares


def _char_counts(texts: list[bytes]) -> np.ndarray:
    buffer = np.frombuffer(b"".join(texts), dtype=np.uint8)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    begin = ~_CONTINUED[buffer]
    slot = row[begin] * len(CLASSES) + _CLASS[buffer[begin]]
    return np.bincount(slot, minlength=len(texts) * len(CLASSES)).reshape(len(texts), -1)


def _word_counts(texts: list[str], common: np.ndarray) -> np.ndarray:
    hashes, starts = _letter_runs(texts)
    row = np.repeat(np.arange(len(texts)), np.diff(starts))
    width = len(common) + 1
    if not len(common):
        slot = row
    else:
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        slot = row * width + np.where(common[at] == hashes, at, len(common))
    return np.bincount(slot, minlength=len(texts) * width).reshape(len(texts), width)


def _letter_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return hashed_words([t.lower().encode("utf-8", "replace") for t in texts], _NO_LETTER)


def _entropy(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return -np.where(p > 0, p * np.log2(p), 0).sum(axis=-1)


def distances(counts: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of every row of counts to its nearest reference; 0 if none."""
    if not len(references):
        return np.zeros(len(counts))
    p = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
    best = np.ones(len(counts))
    own = _entropy(p)
    for q in references:
        between = _entropy((p + q) / 2) - (own + _entropy(q)) / 2
        best = np.minimum(best, np.sqrt(np.clip(between, 0, 1)))
    return best


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    for batch in batches:
        by: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by.setdefault(lang, []).append(text)
        for lang, texts in by.items():
            for a, b in slices(texts):
                yield lang, texts[a:b]


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mergeable counters: whenever there are too many, all lose what the smallest have."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    total: dict[str, int] = {}
    for lang, texts in _grouped(batches):
        hashes, _ = _letter_runs(texts)
        total[lang] = total.get(lang, 0) + len(hashes)
        words, counts = np.unique(hashes, return_counts=True)
        if lang in held:
            both = np.concatenate((held[lang][0], words))
            words, where = np.unique(both, return_inverse=True)
            counts = np.bincount(
                where, weights=np.concatenate((held[lang][1], counts)), minlength=len(words)
            ).astype(np.int64)
        if len(words) > COUNTERS:
            counts = counts - np.partition(counts, -COUNTERS - 1)[-COUNTERS - 1]
            words, counts = words[counts > 0], counts[counts > 0]
        held[lang] = words, counts
    for lang, (words, counts) in held.items():
        keys = np.concatenate((words.view(np.int64), [0]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(keys), pa.string()),
                pa.array(keys),
                pa.array(np.concatenate((counts, [total[lang]])).astype(np.int64)),
                pa.array([False] * len(words) + [True]),
            ],
            ["lang", "word", "n", "total"],
        )


def _exact(common: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for lang, texts in _grouped(batches):
            chars = _char_counts([t.encode("utf-8", "replace") for t in texts]).sum(axis=0)
            words = _word_counts(texts, common).sum(axis=0)
            old = sums.get(lang, (0, 0))
            sums[lang] = old[0] + chars, old[1] + words
        for lang, (chars, words) in sums.items():
            n = len(chars) + len(words)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * n, pa.string()),
                    pa.array(np.arange(n)),
                    pa.array(np.concatenate((chars, words)).astype(np.int64)),
                ],
                ["lang", "slot", "n"],
            )

    return run


def references(docs: DataFrame) -> References:
    """Sum the references over all documents that have text and lang.

    Two passes: the first finds every word that can be common, at most 1 / COMMON_SHARE (and a
    few) per language, by mergeable counters; the second counts those and the characters exactly.
    """
    rows = docs.select("lang", "text").where("lang is not null and text is not null")
    names = [r.lang for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counted = rows.mapInArrow(_frequent, "lang string, word long, n long, total boolean")
    counted = counted.groupBy("lang", "word", "total").agg(F.sum("n").alias("n"))
    totals = counted.where("total").select("lang", F.col("n").alias("all"))
    lowest = COMMON_SHARE - 1 / COUNTERS
    candidates = (
        counted.where("not total").join(F.broadcast(totals), "lang")  # one row per language
        .where(F.col("n") >= F.lit(lowest) * F.col("all"))
        .select("word").distinct().collect()
    )
    common = np.unique(np.array([r.word for r in candidates], dtype=np.int64).view(U))
    sums = (
        rows.mapInArrow(_exact(common), "lang string, slot long, n long")
        .groupBy("lang", "slot").agg(F.sum("n").alias("n")).collect()
    )
    names.sort()
    table = np.zeros((len(names), len(CLASSES) + len(common) + 1))
    for r in sums:
        table[names.index(r.lang), r.slot] = r.n
    chars, words = table[:, : len(CLASSES)], table[:, len(CLASSES) :]
    used = (chars.sum(axis=1) > 0) & (words.sum(axis=1) > 0)
    names = [n for n, u in zip(names, used) if u]
    chars = chars[used] / chars[used].sum(axis=1, keepdims=True)
    words = words[used] / words[used].sum(axis=1, keepdims=True)
    wanted = (words[:, :-1] >= COMMON_SHARE).any(axis=0)
    kept = words[:, :-1][:, wanted]
    other = 1 - kept.sum(axis=1, keepdims=True)
    return References(names, chars, common[wanted], np.concatenate((kept, other), axis=1))


def _base(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counted properties of the contract, per text."""
    rows = len(texts)
    hashes, starts = hashed_words(texts)
    n_words = np.diff(starts)
    buffer = np.frombuffer(b"".join(texts), dtype=np.uint8)
    row = np.repeat(np.arange(rows), [len(t) for t in texts])
    inside = ~_IS_SPACE[buffer] & ~_CONTINUED[buffer]
    repeated = np.zeros(rows, dtype=np.int64)
    triples = max(0, len(hashes) - 2)
    gram = np.zeros(triples, dtype=U)
    for k in range(3):
        gram = mix(gram * U(0x9E3779B97F4A7C15) + hashes[k : k + triples], 3)
    for i in np.flatnonzero(n_words >= 4):
        own = gram[starts[i] : starts[i + 1] - 2]
        _, where, count = np.unique(own, return_inverse=True, return_counts=True)
        again = count[where] > 1
        hit = np.zeros(len(own) + 2, dtype=bool)
        for k in range(3):
            hit[k : k + len(own)] |= again
        repeated[i] = hit.sum()
    duplicates = np.zeros(rows, dtype=np.int64)
    for i, t in enumerate(texts):
        if b"\n" in t:
            lines = [x for x in t.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
            duplicates[i] = len(lines) - len(set(lines))
    return {
        "n_words": n_words.astype(np.int64),
        "word_chars": np.bincount(row[inside], minlength=rows),
        "n_symbols": np.bincount(row[_SYMBOL[buffer]], minlength=rows),
        "n_dup_lines": duplicates,
        "n_repeat_words": repeated,
    }


def _judge(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = shared.value
        for batch in batches:
            all_texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(all_texts):
                texts = all_texts[a:b]
                raw = [t.encode("utf-8", "replace") for t in texts]
                base = _base(raw)
                n, again = base["n_words"], base["n_repeat_words"]
                failed = (n < 50) | (100 * again > 50 * n)
                chars, words = _char_counts(raw), _word_counts(texts, refs.common)
                char_far, word_far = distances(chars, refs.chars), distances(words, refs.words)
                n_chars, n_runs = chars.sum(axis=1), words.sum(axis=1)
                # the mean square of a distance by chance is about (bins - 1) / (8 ln 2 n)
                chance = lambda bins, size: np.sqrt(
                    (bins - 1) / (8 * np.log(2) * np.maximum(size, 1))
                )
                bins = (refs.words > 0.001).sum(axis=1).max(initial=1)
                bad = (n_chars >= LEAST_CHARS) & (
                    char_far > CHAR_LIMIT + chance(len(CLASSES), n_chars)
                )
                bad |= (n_runs >= LEAST_WORDS) & (word_far > WORD_LIMIT + chance(bins, n_runs))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        *(pa.array(v.astype(np.int64)) for v in base.values()),
                        pa.array(failed),
                        pa.array(~failed & ~bad),
                        pa.array(char_far),
                        pa.array(word_far),
                    ],
                    OUT_NAMES,
                )

    return run


OUT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, char_distance double, "
    "word_distance double"
)
OUT_NAMES = [x.split()[0] for x in OUT.split(", ")]


def judge(docs: DataFrame, refs: References | None = None) -> DataFrame:
    """(doc_id, counts, base_failed, kept, char_distance, word_distance), one row per row.

    Null and empty texts have no words, distances of 1 to any reference and fail. A histogram is
    judged from 200 characters or 50 letter runs on; its distance may exceed the limit by what
    chance alone gives a text of that length. Without any labelled text nothing is rejected but
    by the base rules. Documents without lang are judged, but not part of a reference.
    """
    refs = references(docs) if refs is None else refs
    shared = docs.sparkSession.sparkContext.broadcast(refs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _judge(shared), OUT
    )
