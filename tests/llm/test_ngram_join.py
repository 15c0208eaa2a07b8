"""N-gram Jaccard join against brute force."""

import random
import time

import numpy as np
import pytest

from encore.llm import ngram_join, shared
from encore.llm.components import components


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, n, similarity):
    """Components by comparing all pairs."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if x and y and 100 * len(x & y) >= similarity * len(x | y):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets}


def corpus(seed, groups=12, copies=14, length=(4, 160)):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(900)] + ["the", "of", "a"] * 40
    passage = " ".join(rng.choice(vocabulary) for _ in range(25))
    rows, i = [], 0
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(*length))]
        for _ in range(rng.randint(1, copies)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                at = rng.randrange(len(words))
                kind = rng.random()
                if kind < 0.5:
                    words[at] = rng.choice(vocabulary)
                elif kind < 0.75 and len(words) > 2:
                    del words[at]
                else:
                    words.insert(at, rng.choice(vocabulary))
            text = " ".join(words)
            if rng.random() < 0.2:
                text += "\n" + passage
            rows.append((i, text.upper() if rng.random() < 0.1 else text))
            i += 1
    return rows


@pytest.mark.parametrize("n, similarity", [(3, 90), (5, 80)])
@pytest.mark.parametrize("chunk", [1 << 17, 300])  # one task per family, and many
def test_equals_brute_force(spark, docs_of, n, similarity, chunk):
    rows = corpus(n * chunk)
    got = ngram_join.linked_components(docs_of(rows), n, similarity, chunk_weight=chunk)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()}
    assert got == brute(rows, n, similarity)


def test_edges(spark, docs_of):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [
        (5, None), (6, ""), (7, " \t\n"), (8, "one two"), (3, "ONE  two\n"), (9, "two one"),
        (11, long), (10, long + " more"), (20, "x y z"), (20, "p q r"), (21, "x y z"),
        (22, "p q r"), (8, "one two"), (None, "one two"), (None, None), (30, "É é ö x"),
        (31, "é é ö x"),
    ]
    got = ngram_join.linked_components(docs_of(rows), 3, 90).collect()
    assert len(got) == len(rows)
    seen = sorted((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None)
    assert seen == sorted([
        (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 1, 3), (3, 1, 3), (9, 1, 9), (11, 29998, 10),
        (10, 29999, 10), (20, 1, 20), (20, 1, 20), (21, 1, 20), (22, 1, 20), (8, 1, 3),
        (30, 2, 30), (31, 2, 31),
    ])
    none = sorted((r.n_shingles, r.component_id or -1) for r in got if r.doc_id is None)
    assert none == [(0, -1), (1, 3)]
    empty = docs_of(rows).limit(0)
    assert ngram_join.linked_components(empty, 3, 90).count() == 0
    kept = ngram_join.one_per_component(docs_of([(1, "a b c d e f"), (2, "a b c d e f")]))
    assert [r.doc_id for r in kept.collect()] == [1] and "block" in kept.columns


def test_repeated_id_with_a_long_text(spark, docs_of):
    """An id's short text links, its long text needs many shared blocks and has no partner."""
    short = " ".join(f"s{i}" for i in range(60))
    rows = [(5, short), (9, short + " more"), (5, " ".join(f"l{i}" for i in range(1500))),
            (7, " ".join(f"m{i}" for i in range(1500)))]
    got = ngram_join.linked_components(docs_of(rows), 3, 90).collect()
    want = brute(rows, 3, 90)
    assert sorted((r.doc_id, r.component_id) for r in got) == [(5, 5), (5, 5), (7, 7), (9, 5)]
    assert {i: c for i, (_, c) in want.items()} == {5: 5, 7: 7, 9: 5}


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 102), (7, 7), (200, 200)]
    df = spark.createDataFrame(chain + chain[:5] + [(None, 3)], "u long, v long")
    got = dict(tuple(r) for r in components(df).collect())
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100, 102: 100, 200: 200}


def test_one_row_of_each_component(spark, docs_of):
    """Decided by row: null and repeated ids are deduplicated, unlike texts of one id stay."""
    text = " ".join(f"w{i}" for i in range(60))
    near = text + " tail"
    rows = [(None, text)] * 5 + [(3, text)] * 3
    rows += [(4, "other words in a text of its own"), (4, "a second text that shares nothing")]
    rows += [(5, near), (6, None), (6, None), (7, ""), (None, None)]
    docs = docs_of(rows)
    got = ngram_join.one_per_component(docs)
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert sum(t in (text, near) for _, t in kept) == 1
    assert sorted(t for i, t in kept if i == 4) == sorted([rows[8][1], rows[9][1]])
    assert sorted(str(i) for i, t in kept if not t) == ["6", "7", "None"]


def test_very_long_texts_are_hashed_in_pieces():
    rng = random.Random(3)
    long_text = " ".join(f"w{rng.randrange(5000)}" for _ in range(400_000)).encode()
    assert len(long_text) > 8 * ngram_join.PIECE
    texts = [long_text, b"", b"short text", b"x" * (3 * ngram_join.PIECE), b" a  b "]
    hashes, starts = ngram_join._word_hashes(texts)
    whole, begins = ngram_join.hashed_words(texts)
    assert (hashes == whole).all() and (starts == begins).all()


def test_a_common_passage_makes_no_family(spark, docs_of, monkeypatch):
    """Pairs of near copies that hold one passage: a family each, not one with all rows, whose
    chunks would be compared (and written) pair by pair."""
    passage = " ".join(f"p{i}" for i in range(150))
    rows = []
    for i in range(12):
        own = " ".join(f"d{i}w{k}" for k in range(300))
        rows += [(2 * i, f"{own} {passage}"), (2 * i + 1, f"{own} tail {passage}")]
    families = []

    def spied(edges):
        families.append(components(edges))
        return families[-1]

    monkeypatch.setattr(ngram_join, "components", spied)
    got = ngram_join.linked_components(docs_of(rows), 5, 80).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i, _ in rows}
    assert families[0].select("component").distinct().count() == 12


def test_rarest_blocks_still_meet(spark):
    """Every two rows that share as many blocks as both need share one of those that are left."""
    rng = random.Random(8)
    sets, need = {}, {}
    for cls in range(60):
        group = [f"g{cls // 4}b{k}" for k in range(9)]
        common = [f"c{k}" for k in range(12)]
        sets[cls] = set(rng.sample(group, 6)) | set(rng.sample(common, rng.randint(0, 9)))
        need[cls] = rng.randint(1, 6)
    number = {b: i for i, b in enumerate(sorted(set().union(*sets.values())))}
    rows = [(c, 0, need[c], number[b]) for c, blocks in sets.items() for b in blocks]
    sent = spark.createDataFrame(rows, "cls long, step tinyint, need long, block long")
    left = {c: set() for c in sets}
    for r in ngram_join._rarest(ngram_join._meeting(sent)).collect():
        left[r.cls].add(r.block)
    for a in sets:
        for b in range(a):
            if len(sets[a] & sets[b]) >= max(need[a], need[b]):
                assert left[a] & left[b], (a, b)
    assert sum(map(len, left.values())) < len(rows)


def test_rounds_send_every_block_once(spark, docs_of):
    bitmap = np.full(8, 255, np.uint8)
    marked = docs_of(corpus(5)).selectExpr("doc_id", "text", "cast(doc_id % 64 as long) as slot")

    def sent(*turn):
        schema = "cls long, step tinyint, need long, block long"
        found = marked.mapInArrow(ngram_join._blocks_sent(5, 80, bitmap, *turn), schema)
        return sorted(map(tuple, found.collect()))

    parts = [sent(turn, 3) for turn in range(3)]
    assert all(parts) and sorted(sum(parts, [])) == sent()


def test_stored_leaves_no_shuffle_files(spark):
    def files():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        found = manager.getAllFiles().mkString("\n").split("\n")
        return {f for f in found if "/shuffle_" in f}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = files(), spark.conf.get(key)
    df = spark.range(20_000).repartition(3, "id")
    kept = shared.stored(df, "test")
    for _ in range(50):  # the files are dropped by another thread
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(key) == was
    assert kept.count() == df.count() == 20_000
