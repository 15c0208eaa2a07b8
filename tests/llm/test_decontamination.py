"""Winnowing against a search for every window."""

import hashlib
import random
import re

import pytest

from encore.llm import decontamination


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text, items):
    own, hit, names = words(text), set(), set()
    for name, item in items:
        its = words(item)
        if not its:
            continue
        n = min(13, len(its))
        windows = {tuple(its[i : i + n]) for i in range(len(its) - n + 1)}
        for i in range(len(own) - n + 1):
            if tuple(own[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                if name is not None:
                    names.add(str(name))
    digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    contaminated = bool(hit) and 20 * len(hit) >= len(own)
    return len(own), len(hit), len(names), digest, contaminated


def fixture(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)] + ["the", "of"] * 20
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(rng.randint(15, 60)))) for i in range(20)]
    items += [(20, "rare1 rare2"), (21, "of"), (22, " ".join(text(12))), (23, "uno dos tres cuatro")]
    items += [(24, None), (25, " ... "), (None, "rare1"), (3, " ".join(text(20)))]
    rows = []
    for i in range(120):
        own = text(rng.choice([0, 5, 13, 40, 300]))
        for _ in range(rng.choice([0, 1, 2])):
            source = words(rng.choice(items)[1])
            size = rng.choice([5, 11, 12, 13, 14, 20, 60])
            start = rng.randrange(max(1, len(source) - size + 1))
            at = rng.randrange(len(own) + 1)
            own[at:at] = source[start : start + size]
        joined = rng.choice([" ", ", ", "\n", "-"]).join(own)
        rows.append((i, joined.upper() if rng.random() < 0.2 else joined))
    return rows, items


@pytest.mark.parametrize("limit", [500_000, 3])  # broadcast, and beyond its bound
def test_equals_brute_force(spark, docs_of, limit):
    rows, items = fixture(4)
    rows += [rows[5], (200, None), (201, ""), (202, " ".join(["rare1"] * 3000 + ["rare2"]))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contamination(docs_of(rows), benchmark, broadcast_rows=limit)
    got = sorted(tuple(r) for r in got.collect())
    want = sorted((i, *brute(t, items)) for i, t in rows)
    assert got == want
    assert sum(r[5] for r in want) > 20


def test_long_items_only_and_empty_tables(spark, docs_of):
    rows, items = fixture(9)
    items = [x for x in items if x[1] and len(words(x[1])) > 14]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in decontamination.contamination(docs_of(rows), benchmark).collect())
    assert got == sorted((i, *brute(t, items)) for i, t in rows)
    assert decontamination.contamination(docs_of(rows).limit(0), benchmark).count() == 0
    clean = decontamination.contamination(docs_of(rows), benchmark.limit(0))
    assert clean.where("n_hit > 0 or contaminated").count() == 0 and clean.count() == len(rows)
    kept = decontamination.drop_contaminated(docs_of(rows), benchmark)
    bad = {i for i, t in rows if brute(t, items)[4]}
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - bad
    plan = decontamination.contamination(docs_of(rows), benchmark)
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_rows_are_dropped_by_their_own_text(spark, docs_of):
    passage = " ".join(f"p{i}" for i in range(20))
    benchmark = spark.createDataFrame([(None, passage)], "item_id long, text string")
    rows = [(None, passage), (1, passage), (1, "clean text"), (None, "clean"), (None, None)]
    rows += [(2, passage.upper())] * 3
    docs = docs_of(rows)
    got = decontamination.drop_contaminated(docs, benchmark)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == [
        ("1", "clean text"), ("None", "None"), ("None", "clean")
    ]
