"""SQL of the queries that iterate, with their rounds written out (DuckDB)."""

from __future__ import annotations


def _framed(column: str) -> str:
    text = f"cast({column} as varchar)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII characters, bit by bit: -1 stands for a shift."""
    marks = (
        f"flatten(list_transform(string_split({text}, ''), lambda x:"
        " [cast(ascii(x) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))"
    )
    return (
        f"xor(4294967295, list_reduce(list_concat([4294967295], {marks}), lambda c, e:"
        " case when e >= 0 then xor(c, e)"
        " else xor(c >> 1, (c & 1) * 3988292384) end))"
    )


def _tree(name: str, leaves: str, depth: int, fanout: int) -> str:
    """``{name}_k``: nodes (tree, pos, n, h) of level k, k up to ``depth``; ``{name}_run_k``: the
    hashes of a run of siblings."""
    out = [f"{name}_0 as materialized ({leaves})"]
    for k in range(depth):
        out.append(
            f"{name}_run_{k} as materialized (select tree, pos // {fanout} as run, max(n) as n,"
            f" list(h order by pos) as hs from {name}_{k} where n > 1"
            f" group by tree, pos // {fanout})"
        )
        out.append(
            f"{name}_{k + 1} as materialized (select tree, run as pos,"
            f" (n + {fanout - 1}) // {fanout} as n, sha256(array_to_string(hs, '')) as h"
            f" from {name}_run_{k})"
        )
    return ",\n".join(out)


def _climb(name: str, tree: str, start: str, depth: int, fanout: int) -> str:
    """From ``start`` (r, tree, pos, now, proof) to the root of the tree, level by level."""
    out = [f"{name}_0 as materialized ({start})"]
    for k in range(depth):
        slot = f"(pos % {fanout})"
        left = f"array_to_string(hs[1:{slot}], '')"
        right = f"array_to_string(hs[{slot} + 2:], '')"
        out.append(
            f"{name}_{k + 1} as materialized (select r, c.tree, pos // {fanout} as pos,"
            f" case when hs is null then now else sha256({left} || now || {right}) end as now,"
            f" case when hs is null then proof else proof || {left} || {right} end as proof"
            f" from {name}_{k} c left join {tree}_run_{k} x"
            f" on c.tree = x.tree and c.pos // {fanout} = x.run)"
        )
    return ",\n".join(out)


def merkle_sql(depth: int = 16, fanout: int = 3) -> str:
    """Trees of up to fanout ** depth rows a source, and as many sources."""

    def leaf(text: str) -> str:
        parts = [_framed(c) for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"

    roots = "\nunion all ".join(f"select tree, h from s_{k} where n = 1" for k in range(depth + 1))
    top_roots = "\nunion all ".join(f"select h from t_{k} where n = 1" for k in range(depth + 1))
    number = f"case when doc_id is null then 1 else {_crc32('cast(doc_id as varchar)')} end"
    return f"""
with d as materialized (select row_number() over () as r, doc_id, source, {leaf("text")} as leaf,
  case when {number} % 2 = 0 then {leaf("replace(text, chr(10), '')")} else {leaf("text")} end
    as altered from documents),
g as materialized (select r, doc_id, leaf, altered,
  dense_rank() over (order by source nulls first) - 1 as tree,
  row_number() over (partition by source order by doc_id nulls first, leaf, r) - 1 as pos,
  count(*) over (partition by source) as n from d),
{_tree("s", "select tree, pos, n, leaf as h from g", depth, fanout)},
subroots as materialized ({roots}),
{_tree("t", "select 0 as tree, tree as pos, count(*) over () as n, h from subroots", depth, fanout)},
root as materialized ({top_roots}),
{_climb("a", "s", "select r, tree, pos, altered as now, '' as proof from g", depth, fanout)},
{_climb("b", "t", f"select r, 0 as tree, tree as pos, now, proof from a_{depth}", depth, fanout)}
select doc_id, leaf, subroots.h as subroot, root.h as root, sha256(proof) as proof_sha256,
  now as folded_root, now = root.h as verified
from g join b_{depth} using (r) join subroots on g.tree = subroots.tree, root
"""


_INTEGERS = "list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint))"
_FINITE = (
    "embedding is not null and len(list_filter(embedding,"
    " lambda x: x is null or not isfinite(x))) = 0"
)


def kmeans_sql(k: int = 40, rounds: int = 5, dimensions: int = 64) -> str:
    distance = "list_sum(list_transform(range(1, {0} + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"
    distance = distance.format(dimensions)

    def assigned(i: int) -> str:
        return f"""
a{i} as materialized (select r, any_value(vec_id) as vec_id, any_value(v) as v,
  arg_min(cluster, (d, cluster)) as cluster, min(d) as d
  from (select r, vec_id, v, cluster, {distance} as d from e, c{i}) group by r)"""

    steps = []
    for i in range(rounds):
        steps.append(assigned(i))
        steps.append(f"""
m{i} as materialized (select cluster, list((s - ((s % n) + n) % n) // n order by i) as c
  from (select cluster, i, sum(v[i]) as s, count(*) as n
        from a{i}, range(1, {dimensions} + 1) as t(i) group by cluster, i) group by cluster),
c{i + 1} as materialized (select cluster, coalesce(m{i}.c, c{i}.c) as c
  from c{i} left join m{i} using (cluster))""")
    steps.append(assigned(rounds))
    return f"""
with e as materialized (select row_number() over () as r, vec_id, {_INTEGERS} as v
  from embeddings where len(embedding) = {dimensions} and {_FINITE}),
c0 as materialized (select cast(row_number() over (
    order by sha256('2:' || cast(vec_id as varchar)) nulls last, v) - 1 as int) as cluster,
  v as c from e qualify cluster < {k}),{",".join(steps)}
select vec_id, cluster, cast(d as bigint) as distance,
  cast(sum(d) over (partition by cluster) as bigint) as cluster_inertia,
  cast(sum(d) over () as bigint) as inertia,
  sha256(array_to_string(c, ',')) as centroid_sha256
from a{rounds} join c{rounds} using (cluster)
"""


def top_products_sql(k: int = 5, every: int = 50) -> str:
    product = (
        "coalesce(list_sum(list_transform(range(1, least(len(q.v), len(e.v)) + 1),"
        " lambda i: q.v[i] * e.v[i])), 0)"
    )
    return f"""
with e as materialized (select row_number() over () as r, vec_id, {_INTEGERS} as v
  from embeddings where {_FINITE}),
p as (select q.vec_id as query_id, q.r as query, e.vec_id, e.r, {product} as score
  from e q join e on q.r <> e.r where q.vec_id % {every} = 0)
select query_id, cast(rank as int) as rank, vec_id, cast(score as bigint) as score
from (select *, row_number() over (
    partition by query order by score desc, vec_id nulls last, r) as rank from p)
where rank <= {k}
"""
