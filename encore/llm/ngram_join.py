"""Documents that share most of their word n-grams, by a blocked sparse matrix product.

The incidence matrix has a row per document and a column per word n-gram. Two rows are linked
when their overlap is at least ``similarity`` percent of their union, which is the same as

    (100 + similarity) * overlap >= similarity * (size + size').

So linked rows differ in at most H = (100 - similarity) * (size + size') / (100 + similarity)
columns. The product is not formed for all pairs of rows:

1. Rows with equal sets become one class; only classes go on. (A bitmap of class ids filters them;
   a copy that slips through is one more node of its class.)
2. The columns are cut by their hash into more than H blocks, how many follows from the sizes of
   the two rows alone. At least one block then has to be equal in both rows; pairs without one
   are discarded unseen. A row sends one hash per block, nothing else. More blocks than H + 1
   are made, so that blocks with very few columns, which unlike rows share by chance, need not
   be sent; a row with too many of those repeats the cut with another hash function. From its
   size and its unsent blocks follows how many blocks a row shares with any row it links with;
   a row that meets others in fewer goes.
   Of the others as many of the most common blocks are left out as a linked row shares for sure
   beyond one, so that passages in many texts do not join rows that are alike in little.
3. Rows that meet in a block form a family. Families are cut into chunks of bounded weight, each
   pair of chunks is a task: it accumulates the overlap counts through the postings of every
   n-gram, drops pairs below the bound given by their sizes, and returns the links that join
   what was not joined before in that task.
4. Connected components of the links name the groups.

No pair of rows is written but those that link, at most one per row and task. A hot block hash
(thousands of near copies) is combined before the shuffle and its join is split by adaptive
execution; the family it makes is cut into chunks.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from encore.llm.components import components
from encore.llm.shared import U, hashed_words, mix, stored
from encore.operators.joins import splittable

#: Weight (n-grams) of a chunk of a family; a task holds two.
CHUNK_WEIGHT = 1 << 19
#: Cuts by further hash functions for rows with too many nearly empty blocks.
SEEDS = 24
#: Documents whose blocks are sampled for hot ones, and how often a hot block is in the sample.
SAMPLE_DOCS, HOT_IN_SAMPLE = 5000, 10
#: The rows of all blocks are shuffled in so many rounds, each with its share of the hashes.
ROUNDS = 3
#: At most this many hot blocks are broadcast; windows that a hot block is dealt to.
BROADCAST_ROWS, PARTS = 200_000, 1024
_LARGEST = 10**10
#: Bytes of text that a Python worker decodes and hashes at once.
PIECE = 1 << 18
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


@dataclass(frozen=True)
class Bins:
    """Per bin of sizes: lower size, blocks, blocks that may go unsent, least n-grams to send."""

    lows: np.ndarray
    blocks: np.ndarray
    spare: np.ndarray
    least: np.ndarray


def _bins(similarity: int) -> Bins:
    lows = [1]
    while lows[-1] < _LARGEST:
        step = (100 / similarity) ** 2
        lows.append(max(lows[-1] + 1, math.ceil(lows[-1] * step)))
    chosen = []
    for low, high in zip(lows, lows[1:]):
        differing = 2 * (high - 1) * (100 - similarity) // (100 + similarity)
        options = []
        for least in (3, 2, 1):
            best = None
            extra = {*range(min(12, 2 + differing // 3)), *(differing * i // 50 for i in range(17))}
            for d in sorted(extra):
                m = differing + 1 + d
                cost = 0.0  # blocks sent by a row of the bin, and by one of the bin below
                for size, weight in ((low, 2), (low * similarity / 100, 1)):
                    rate = size / m
                    thin = sum(
                        math.exp(-rate) * rate**i / math.factorial(i) for i in range(least)
                    )
                    spread = math.sqrt(m * thin * (1 - thin)) + 1e-9
                    short = 0.5 * math.erfc((d + 0.5 - m * thin) / spread / math.sqrt(2))
                    cost += weight * m / max(1 / SEEDS, 1 - short)
                if best is None or cost < best[0]:
                    best = (cost, m, d, least)
            options.append(best)
        cheapest = min(options)[0]
        chosen.append(next(o for o in options if o[0] <= 1.25 * cheapest))
    _, blocks, spare, least = zip(*chosen)
    return Bins(np.array(lows[:-1]), np.array(blocks), np.array(spare), np.array(least))


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``hashed_words``; a very long text is hashed in pieces that end between words."""
    if sum(map(len, texts)) <= 2 * PIECE:
        return hashed_words(texts)
    hashes, counts = [], []
    for text in texts:
        own, at = [], 0
        while at < len(text):
            space = _SPACE.search(text, at + PIECE)
            end = space.start() if space else len(text)
            own.append(hashed_words([text[at:end]])[0])
            at = end
        hashes += own
        counts.append(sum(map(len, own)))
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, U)
    return hashes, np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))


def _sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of every text, one after another, and where each begins."""
    hashes, starts = _word_hashes(texts)
    count = np.diff(starts)
    grams = np.zeros(max(0, len(hashes) - n + 1), dtype=U)
    for k in range(n):
        grams = mix(grams * U(0x9E3779B97F4A7C15) + hashes[k : k + len(grams)], 0x1234567 + n)
    parts = []
    for i, words in enumerate(count):
        a = starts[i]
        if words == 0:
            own = np.zeros(0, dtype=U)
        elif words < n:
            own = np.zeros(1, dtype=U)
            for h in hashes[a : a + words]:
                own = mix(own * U(0x9E3779B97F4A7C15) + h, 0x7654321 + int(words))
        else:
            own = np.sort(grams[a : a + words - n + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        parts.append(own)
    sizes = np.fromiter((len(p) for p in parts), dtype=np.int64, count=len(parts))
    return np.concatenate(parts), np.concatenate(([0], np.cumsum(sizes)))


def _block_hashes(values, owner, owners, m, salt, everything):
    """Block hashes of sorted sets cut into m[owner] blocks: (owner, size of block, hash)."""
    top = (values >> U(32)) * m[owner].astype(U) >> U(32)
    key = np.flatnonzero(
        np.concatenate(([True], (owner[1:] != owner[:-1]) | (top[1:] != top[:-1])))
    ) if len(values) else np.zeros(0, dtype=np.int64)
    if not len(key):
        total, who, which = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, U)
    else:
        total = np.add.reduceat(mix(values, 0xABCDEF), key)
        who, which = owner[key], top[key]
    size = np.diff(np.concatenate((key, [len(values)])))
    if everything:  # the empty blocks too
        seen = set(zip(who.tolist(), which.tolist()))
        empty = [(o, j) for o in owners for j in range(int(m[o])) if (o, j) not in seen]
        who = np.concatenate((who, np.array([o for o, _ in empty], dtype=np.int64)))
        which = np.concatenate((which, np.array([j for _, j in empty], dtype=U)))
        total = np.concatenate((total, np.zeros(len(empty), dtype=U)))
        size = np.concatenate((size, np.zeros(len(empty), dtype=np.int64)))
    return who, size, mix(total + mix(which + m[who].astype(U) * U(1 << 32), salt), salt)


def _signatures(values, starts, similarity, bins: Bins):
    """For the row's own bin and the next one: hashes of the blocks that it has to send, and how
    many of them a linked row has to share."""
    sizes = np.diff(starts)
    rows = len(sizes)
    own = np.searchsorted(bins.lows, sizes, side="right") - 1
    top = len(bins.lows) - 1
    steps = []
    for step in (0, 1):  # the next bin only if a linked row can be there
        out: list[list[np.ndarray]] = [[] for _ in range(rows)]
        at = own + step
        part = (sizes > 0) & (at <= top)
        if step:
            part &= 100 * sizes >= similarity * bins.lows[np.minimum(at, top)]
        at = np.clip(at, 0, top)
        m, d, least = bins.blocks[at], bins.spare[at], bins.least[at]
        largest = np.where(at < top, bins.lows[np.minimum(at + 1, top)] - 1, _LARGEST)
        largest = np.minimum(largest, sizes * 100 // similarity)
        differing = (sizes + largest) * (100 - similarity) // (100 + similarity)
        need = np.ones(rows, dtype=np.int64)
        part &= m > 1  # one block: only equal sets link
        active = np.flatnonzero(part)
        for seed in range(SEEDS):
            if not len(active):
                break
            owner = np.repeat(active, sizes[active])
            where = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in active])
            got = values[where]
            if seed:
                got = mix(got, seed * 0x9E3779B9)
                order = np.lexsort((got, owner))
                got, owner = got[order], owner[order]
            last = seed == SEEDS - 1
            salt = 0x51ED270B + seed + (1 << 20)
            who, size, found = _block_hashes(got, owner, active, m, salt, last)
            strong = size >= least[who]
            send = strong | last
            thin = m - np.bincount(who[strong], minlength=rows)
            who, found = who[send], found[send]
            order = np.argsort(who, kind="stable")
            who, found = who[order], found[order]
            cuts = np.searchsorted(who, active), np.searchsorted(who, active, side="right")
            for i, a, b in zip(active, *cuts):
                out[i].append(found[a:b])
            if not seed:  # at least m - differing blocks are equal, at most ``thin`` unsent
                need[active] = np.maximum(1, (m - differing - thin)[active])
            again = (thin > d)[active]
            need[active[again]] = 1
            active = active[again]
        steps.append(([np.concatenate(x) if x else np.zeros(0, dtype=U) for x in out], need))
    return steps


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Consecutive rows with about PIECE bytes of text (second column), and these in lower case.

    Only these rows are decoded, so a worker's memory does not grow with the batch.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes + 1)
    start = 0
    while start < len(ends):
        limit = (ends[start - 1] if start else 0) + PIECE
        stop = max(start + 1, int(np.searchsorted(ends, limit, side="right")))
        part = batch.slice(start, stop - start)
        texts = part.column(1).cast(pa.binary()).to_pylist()
        yield part, [(t or b"").lower() for t in texts]
        start = stop


def _summaries(n: int):
    """Per row the size of its set and a 128-bit digest of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _pieces(batch):
                values, starts = _sets(texts, n)
                totals = np.zeros((2, len(values) + 1), dtype=U)
                np.cumsum(mix(values, 11), out=totals[0, 1:])
                np.cumsum(mix(values, 1 << 40), out=totals[1, 1:])
                digest = (totals[:, starts[1:]] - totals[:, starts[:-1]]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *map(pa.array, (np.diff(starts), digest[0], digest[1]))],
                    ["doc_id", "n_shingles", "hi", "lo"],
                )

    return run


def _chosen(batch: pa.RecordBatch, bitmap: np.ndarray) -> pa.RecordBatch:
    """The rows whose slot (third column) is in the bitmap."""
    slot = batch.column(2).to_numpy()
    return batch.take(pa.array(np.flatnonzero((bitmap[slot >> 3] >> (slot & 7)) & 1)))


def _blocks_sent(n: int, similarity: int, bitmap: np.ndarray, turn: int = 0, rounds: int = 1):
    """The block hashes of the chosen rows that belong to this round, one a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = _bins(similarity)
        for batch in batches:
            for part, texts in _pieces(_chosen(batch, bitmap)):
                ids = part.column(0).to_numpy()
                values, starts = _sets(texts, n)
                steps = _signatures(values, starts, similarity, bins)
                for step, (blocks, need) in enumerate(steps):
                    blocks = [x[x % U(rounds) == U(turn)] for x in blocks]
                    counts = np.array([len(x) for x in blocks])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(ids, counts)),
                            pa.array(np.full(counts.sum(), step, dtype=np.int8)),
                            pa.array(np.repeat(need, counts)),
                            pa.array(np.concatenate(blocks).view(np.int64)),
                        ],
                        ["cls", "step", "need", "block"],
                    )

    return run


def _set_bytes(n: int, bitmap: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _pieces(_chosen(batch, bitmap)):
                values, starts = _sets(texts, n)
                data = [values[s:e].tobytes() for s, e in zip(starts, starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(data, pa.binary())],
                    ["doc_id", "grams"],
                )

    return run


def _product(similarity: int):
    """Links inside one pair of chunks: rows (u, v), at most one fewer than there are rows."""

    def run(group: pa.Table) -> pa.Table:
        ids = group.column("cls").to_numpy()
        second = group.column("second").to_numpy(zero_copy_only=False)
        crossing = bool(group.column("crossing")[0].as_py())
        sets = [np.frombuffer(x, dtype=U) for x in group.column("grams").to_pylist()]
        order = np.lexsort((ids, second))
        ids, second, sets = ids[order], second[order], [sets[i] for i in order]
        sizes = np.fromiter((len(s) for s in sets), dtype=np.int64, count=len(sets))
        row = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
        value = np.concatenate(sets) if sets else np.zeros(0, U)
        del sets
        order = np.argsort(value, kind="stable")  # rows ascend, so they do within a value
        row, value = row[order], value[order]
        first = np.concatenate(([True], value[1:] != value[:-1]))
        del value
        column = np.empty(len(row), dtype=np.int32)
        column[order] = np.cumsum(first, dtype=np.int32) - 1
        del order
        begin = np.concatenate((np.flatnonzero(first), [len(row)]))
        starts = np.concatenate(([0], np.cumsum(sizes)))
        parent = np.arange(len(sizes))

        def root(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        links = []
        for i in range(1, len(sizes)):
            if crossing and not second[i]:
                continue
            own = column[starts[i] : starts[i + 1]]
            a, b = begin[own], begin[own + 1]
            length = b - a
            shared = length > 1
            a, length = a[shared], length[shared]
            if not len(a):
                continue
            at = np.repeat(a - np.concatenate(([0], np.cumsum(length)[:-1])), length)
            partners = row[at + np.arange(len(at))]
            counts = np.bincount(partners, minlength=len(sizes))
            counts[i:] = 0  # each pair once
            enough = (100 + similarity) * counts >= similarity * (sizes + sizes[i])
            enough &= counts > 0
            if crossing:
                enough &= ~second
            for j in np.flatnonzero(enough):
                x, y = root(i), root(j)
                if x != y:
                    parent[x] = y
                    links.append((ids[i], ids[j]))
        return pa.table(
            {
                "u": pa.array([int(x) for x, _ in links], pa.int64()),
                "v": pa.array([int(x) for _, x in links], pa.int64()),
            }
        )

    return run


def _marked(source: DataFrame, ids: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """``source`` with the hash slot of its id, and a bitmap of the slots of ``ids(id)``.

    A prefilter of bounded size (at most 16 MB): it may let other rows through.
    """
    bits = 1 << min(27, max(18, math.ceil(math.log2(16 * ids.count() + 1))))
    parts = (
        ids.select(F.pmod(F.xxhash64("id"), F.lit(bits)).alias("slot"))
        .select(
            F.floor(F.col("slot") / 32768).alias("bucket"), (F.col("slot") % 32768).alias("bit")
        )
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("map"))
        .collect()
    )
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    for part in parts:
        bitmap[part.bucket * 4096 : (part.bucket + 1) * 4096] = np.frombuffer(part.map, np.uint8)
    marked = source.where("doc_id is not null").select(
        "doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(bits)).alias("slot")
    )
    return marked, bitmap


def _meeting(sent: DataFrame) -> DataFrame:
    """The rows of blocks that several classes have, with the smallest class of the block and
    the number of its rows.

    These are combined before the shuffle, the join can split hot blocks.
    """
    met = (
        sent.groupBy("block")
        .agg(F.min("cls").alias("pivot"), F.max("cls").alias("last"), F.count("*").alias("rows"))
        .where("pivot < last")
        .select("block", "pivot", "rows")
    )
    return sent.join(splittable(met, ["block"]), "block").select(*_ROW, "pivot", "rows")


_ROW = ["cls", "step", "need", "block"]


def _rarest(meeting: DataFrame) -> DataFrame:
    """Of every row as few of its blocks, the rarest first, as still meet in each linked row.

    Linked rows share at least ``need`` blocks. All but the last ``need - 1`` of a row's blocks, in
    an order common to all rows, hold the first of those in both rows. Without the common ones
    (repeated passages) rows that are alike in little do not grow together into one family.
    """
    own = Window.partitionBy("cls", "step")
    return (
        meeting.withColumn("rank", F.row_number().over(own.orderBy("rows", "block")))
        .withColumn("last", F.count("*").over(own) - F.min("need").over(own) + 1)
        .where("rank <= last")
        .select(*_ROW)
    )


def _first_meeting(
    marked: DataFrame, classes: int, send: Callable[..., DataFrame], rounds: int = ROUNDS
) -> DataFrame:
    """The same for all rows, most of which meet no other, without the smallest class: a
    window per block.

    There are hundreds of blocks a row, more bytes than the texts. So they are shuffled in rounds:
    each makes all blocks anew and sends its share of them, and its files go before the next.

    Blocks that are hot in a sample of the documents are known to meet: their rows are dealt to
    many windows and all stay, so no window holds a large share of all documents. Which blocks
    the sample finds does not change the result.
    """
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("sample")), 33) / F.lit(2.0**31)
    hot = (
        send(marked.where(draw < F.lit(SAMPLE_DOCS / max(1, classes))))
        .groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") >= HOT_IN_SAMPLE)
        .select("block", F.lit(True).alias("hot"))
    )
    hot = stored(hot, "hot")  # at most a tenth of the sampled rows
    if hot.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        hot = F.broadcast(hot)
    part = F.when(F.col("hot"), F.pmod(F.xxhash64("cls"), F.lit(PARTS))).otherwise(0)
    here = Window.partitionBy("block", "part")

    def met(turn: int) -> DataFrame:
        return (
            send(marked, turn, rounds)
            .join(hot, "block", "left")
            .withColumn("part", part)
            .withColumn("apart", F.min("cls").over(here) < F.max("cls").over(here))
            .where("hot or apart")
            .select(*_ROW)
        )

    return reduce(DataFrame.union, [stored(met(turn), "meeting") for turn in range(rounds)])


def linked_components(
    docs: DataFrame,
    n: int = 5,
    similarity: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk_weight: int = CHUNK_WEIGHT,
) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of ``docs``.

    Words are maximal runs outside U+0020 and U+0009 to U+000D of the text in lower case (A-Z
    only). A document's set holds its distinct n-grams; with fewer than ``n`` words its whole
    sequence is the only one; without words it is empty and linked with nothing. Documents link
    when 100 * overlap >= ``similarity`` * union; component_id is the smallest id reachable.

    Null or empty text: n_shingles 0, its own component. Equal texts are one class. Repeated
    rows give a row each; rows that share an id are one node, linked by each of their texts.
    A null id has the component of its class (null if no row of that class has an id). An empty
    table gives no rows; other columns are ignored. N-grams are compared by 64-bit hashes.
    """
    source = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    rows = stored(
        source.mapInArrow(_summaries(n), "doc_id long, n_shingles long, hi long, lo long"), "sets"
    )
    keys = ["n_shingles", "hi", "lo"]
    classes = stored(
        rows.where("n_shingles > 0 and doc_id is not null")
        .groupBy(*keys)
        .agg(F.min("doc_id").alias("cls")),
        "classes",
    )
    marked, bitmap = _marked(source, classes.select(F.col("cls").alias("id")))
    meeting = _first_meeting(
        marked,
        classes.count(),
        lambda some, *turn: some.mapInArrow(
            _blocks_sent(n, similarity, bitmap, *turn),
            "cls long, step tinyint, need long, block long",
        ),
    )
    # Rows that meet too rarely for any link go, then those left alone. Rows that share an id are
    # counted together, against what the least of them needs.
    for _ in range(2):
        enough = (
            meeting.groupBy("cls", "step")
            .agg(F.count("*").alias("n"), F.min("need").alias("least")).where("n >= least")
            .select("cls", "step")
        )
        keys_of = ["cls", "step"]
        meeting = meeting.join(splittable(enough, keys_of), keys_of, "left_semi")
        meeting = stored(_meeting(meeting.select(*_ROW)), "meeting")
    meeting = stored(_meeting(_rarest(meeting)), "meeting")
    families = components(
        meeting.where("cls <> pivot")
        .select(F.col("cls").alias("u"), F.col("pivot").alias("v"))
    )
    families = stored(families, "families")
    weights = rows.where("n_shingles > 0").groupBy("doc_id").agg(
        F.max("n_shingles").alias("weight")
    )
    members = families.join(weights, families.node == weights.doc_id).select(
        F.col("node").alias("id"), F.col("component").alias("family"), "weight"
    )
    chunks = members.groupBy("family").agg(
        F.ceil(F.sum("weight") / F.lit(chunk_weight)).cast("int").alias("chunks")
    )
    members = stored(
        members.join(splittable(chunks, ["family"]), "family").select(
            "id",
            "family",
            "chunks",
            F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"),
        ),
        "members",
    )
    marked, bitmap = _marked(source, members)
    grams = marked.mapInArrow(_set_bytes(n, bitmap), "doc_id long, grams binary")
    grams = grams.dropDuplicates(["doc_id", "grams"]).where("length(grams) > 0")
    tasks = (
        members.join(grams, members.id == grams.doc_id)
        .select(
            F.col("id").alias("cls"),
            "family",
            "chunk",
            "grams",
            F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"),
        )
        .select(
            "cls",
            "grams",
            "family",
            F.least("chunk", "other").alias("one"),
            F.greatest("chunk", "other").alias("two"),
            (F.col("chunk") > F.col("other")).alias("second"),
            (F.col("chunk") != F.col("other")).alias("crossing"),
        )
    )
    links = stored(
        tasks.groupBy("family", "one", "two").applyInArrow(
            _product(similarity), "u long, v long"
        ),
        "links",
    )
    groups = components(links)
    named = (
        classes.join(groups, classes.cls == groups.node, "left")
        .select(*keys, F.coalesce("component", "cls").alias("component"))
    )
    return (
        rows.select("doc_id", *keys)
        .join(splittable(named, keys), keys, "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "doc_id").alias("component_id"),
        )
    )


def one_per_component(docs: DataFrame, n: int = 5, similarity: int = 80) -> DataFrame:
    """One document of each component; columns are those of ``docs``.

    Decided row by row: a row is known by a hash of its id and text, so rows without an id or
    with a repeated one are compared like all others, by their own text. The row with the
    smallest id stays (null last); of rows equal in id and text one stays, also without a word.
    Rows without words are linked with no other.
    """
    key = F.xxhash64("doc_id", "text")
    keyed = docs.select(F.struct(*docs.columns).alias("doc"), key.alias("row_key"))
    found = stored(
        linked_components(
            docs.select(key.alias("row_key"), "text"), n, similarity, id_column="row_key"
        ).select(F.col("doc_id").alias("row_key"), F.col("component_id").alias("grp")),
        "grouped",
    )
    linked = found.where("row_key <> grp").select("grp").distinct()
    members = found.join(splittable(linked, ["grp"]), "grp", "left_semi").distinct()
    ids = docs.select(key.alias("row_key"), F.col("doc_id").alias("id"))
    ids = ids.groupBy("row_key").agg(F.min("id").alias("id"))
    members = stored(members.join(splittable(ids, ["row_key"]), "row_key"), "grouped")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row_key")).alias("best")
    best = members.groupBy("grp").agg(best)
    drop = (
        members.join(splittable(best, ["grp"]), "grp")
        .where("row_key <> best.row_key").select("row_key")
    )
    repeated = (
        found.groupBy("row_key").agg(F.count("*").alias("rows")).where("rows > 1")
        .select("row_key")
    )
    repeated = stored(repeated, "repeated")
    keyed = keyed.join(splittable(drop, ["row_key"]), "row_key", "left_anti")
    once = keyed.join(splittable(repeated, ["row_key"]), "row_key", "left_anti").select("doc")
    if not repeated.isEmpty():  # combined before the shuffle, so a hot row costs one per task
        again = keyed.join(splittable(repeated, ["row_key"]), "row_key", "left_semi")
        once = once.union(again.groupBy("row_key").agg(F.first("doc").alias("doc")).select("doc"))
    return once.select("doc.*")
