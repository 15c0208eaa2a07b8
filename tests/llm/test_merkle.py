import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from encore.llm.merkle import audit, build, without_line_breaks

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    parts = []
    for field in FIELDS:
        x = row[field]
        parts.append("-" if x is None else f"{len(str(x).encode())}:{x}")
    return digest("".join(parts))


def tree(hashes, fanout):
    """The root and, per leaf, the siblings (left, right) level by level."""
    paths, at, nodes = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            run = nodes[i // fanout * fanout : i // fanout * fanout + fanout]
            path.append(("".join(run[: i % fanout]), "".join(run[i % fanout + 1 :])))
        nodes = [digest("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
        at = [i // fanout for i in at]
    return nodes[0], paths


def expected(rows, fanout=3):
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, found = [], []
    for source in order:
        members = sorted(
            groups[source],
            key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)),
        )
        subroot, paths = tree([leaf_of(r) for r in members], fanout)
        subroots.append(subroot)
        found.append((members, paths))
    root, tops = tree(subroots, fanout)
    out = []
    for subroot, (members, paths), top in zip(subroots, found, tops):
        for row, path in zip(members, paths):
            steps = path + top
            other = dict(row)
            number = zlib.crc32(str(row["doc_id"]).encode())
            if row["doc_id"] is not None and number % 2 == 0 and row["text"] is not None:
                other["text"] = row["text"].replace("\n", "")
            now = leaf_of(other)
            for left, right in steps:
                now = digest(left + now + right)
            proof = digest("".join(a + b for a, b in steps))
            out.append((row["doc_id"], leaf_of(row), subroot, root, proof, now, now == root))
    return sorted(out, key=str)


def frame(spark, rows):
    df = spark.createDataFrame(
        [tuple(r[f] for f in FIELDS) for r in rows],
        "doc_id long, source string, lang string, n_chars long, text string",
    )
    for name in ("tree", "pos", "n", "leaf", "c0", "hash", "steps", "grp", "parent", "slot", "at"):
        df = df.withColumn(name, F.lit("x"))
    return df


def rows_of(sizes, lines=True):
    rows, i = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            text = f"line {i}\nnext é {i % 7}" if i % 5 else (None if i % 2 else "")
            rows.append(dict(doc_id=i * 7 % 1009, source=source, lang=[None, "en", ""][i % 3],
                             n_chars=None if i % 4 == 0 else i, text=text))
            i += 1
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 3}, {"b": 4, None: 2}, {"a": 28, "": 1, "é": 9, "z": 10, None: 5},
])
def test_audit_equals_plain_trees(spark, sizes):
    rows = rows_of(sizes)
    got = audit(frame(spark, rows), without_line_breaks())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                           "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_repeated_rows_null_ids_and_many_groups(spark):
    rows = rows_of({"a": 11, None: 3}) + rows_of({"a": 5})
    rows += [dict(rows[0], doc_id=None), dict(rows[0], doc_id=None), dict(rows[1])]
    rows += rows_of({f"s{i}": 1 for i in range(20)})
    got = audit(frame(spark, rows), without_line_breaks()).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)
    changed = audit(frame(spark, rows), {"lang": F.lit("??")}).collect()
    assert not any(r.verified for r in changed)


def test_fanout_and_very_long_text(spark):
    rows = rows_of({"a": 30, "b": 2})
    rows[0]["text"] = "ab\n" * 1_000_000
    got = audit(frame(spark, rows), without_line_breaks(), fanout=4).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, 4)


def test_empty_table(spark):
    empty = frame(spark, rows_of({"a": 1})).where("doc_id is null")
    assert audit(empty, without_line_breaks()).collect() == []
    assert build(empty).root is None


def test_one_group_holds_most_rows_and_levels_shrink(spark):
    rows = rows_of({"hot": 700, "b": 40})
    manifest = build(frame(spark, rows))
    assert [level.count() for level in manifest.levels] == [
        234 + 14, 78 + 5, 26 + 2, 9 + 1, 3, 1
    ]
    assert manifest.root == expected(rows)[0][3]
