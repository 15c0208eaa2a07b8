"""Mix and shards against their laws."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from encore.llm import mixing, sharding
from encore.llm.shared import U


def corpus(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "B", "é", None, "tiny"])
        if source == "tiny" and i > 40:
            source = "a"
        n = rng.choice([0, 1, 7, 60, 300])
        rows.append((i, " ".join(rng.choice(["x", "yy", "z"]) for _ in range(n)), "en", source))
    return rows + [(7, None, None, None), rows[3], rows[3], (None, "q w", None, "a"),
                   (900, "long " * 40_000, None, "B")]


def test_targets():
    assert [float(t) for t in mixing.targets([10, 10, 10])] == [5, 10, 15]
    capped = mixing.targets([1, 100, 1])
    assert capped[0] == 3 and capped[2] == 3 and capped[1] == 96
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0, 0]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000])
def test_permutation_and_inverse(n):
    at, size, key = np.arange(n), np.full(n, n), np.full(n, 99, dtype=U)
    there = mixing.permute(at, size, key)
    assert sorted(there) == list(range(n))
    assert (mixing.permute(there, size, key, inverse=True) == at).all()


def test_mix_takes_its_targets(spark, docs_of):
    rows = corpus()
    docs = docs_of(rows)
    options = {"block": 64, "shard_slots": 32, "bucket_rows": 50}
    got = [tuple(r) for r in mixing.mixed_sizes(docs, **options).collect()]
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len((text or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = dict(zip(names, mixing.targets([sizes[n] for n in names])))
    source_of = {(i, len((t or "").split())): s for i, t, _, s in rows}
    taken = defaultdict(int)
    for doc_id, size, source_size, target, words in got:
        source = source_of[doc_id, size]
        assert source_size == sizes[source] and target == pytest.approx(float(wanted[source]))
        assert 0 <= words <= 3 * size
        taken[source] += words
    for name in names:
        assert taken[name] == int(wanted[name])
    again = [tuple(r) for r in mixing.mixed_sizes(docs.repartition(5), **options).collect()]
    assert sorted(got, key=str) == sorted(again, key=str)


def test_mixed_documents_hold_the_words_taken(spark, docs_of):
    rows = [r for r in corpus(2) if r[0] is not None]
    docs = docs_of(rows)
    options = {"block": 64, "shard_slots": 32}
    made = mixing.mixed_documents(docs, **options)
    assert made.columns == docs.columns
    words = Counter()
    texts = defaultdict(list)
    for i, t, *_ in rows:
        texts[i].append(Counter((t or "").split()))
    for r in made.collect():
        own = Counter(r.text.split())
        words[r.doc_id] += own.total()
        assert any(own <= t for t in texts[r.doc_id])
    taken = Counter()
    for r in mixing.mixed_sizes(docs, **options).collect():
        taken[r.doc_id] += r.taken
    assert words == Counter({k: v for k, v in taken.items() if v})
    assert mixing.mixed_sizes(docs.limit(0)).count() == 0
    assert mixing.mixed_documents(docs.where("text is null")).count() == 0


@pytest.mark.parametrize("options", [{}, {"ranges": 8, "sample": 200, "range_rows": 20}])
def test_shards_are_near_equal(spark, docs_of, options):
    rows = corpus(3)[:-1] + [(1000 + i, "the same hot text") for i in range(300)]
    got = sharding.balanced_shards(docs_of(rows), **options).collect()
    assert len(got) == len(rows)
    key = lambda i, t: (i is None, i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
    assert Counter((r.doc_id is None, r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        key(r[0], r[1]) for r in rows
    )
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    assert sorted(by) == list(range(16))
    for shard in by.values():
        assert sorted(r.slot for r in shard) == list(range(len(shard)))
        assert abs(sum(r["size"] for r in shard) - total / 16) <= largest
    assert sharding.balanced_shards(docs_of(rows).limit(0)).count() == 0
    one = sharding.balanced_shards(docs_of([(1, None)])).first()
    assert (one["size"], one.text_crc32, one.slot) == (1, 0, 0)
