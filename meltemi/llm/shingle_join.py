"""Every pair of texts whose shingle sets can reach a Jaccard similarity: an exact prefix-filter join.

Shingles have one order over all texts, rare ones first. Two texts with similarity `least` or more
share a shingle among the first n - ceil(least * n) + 1 of each one's n, so only those are joined; at
the first one they share, what follows must leave room for the overlap needed. How often a shingle
occurs is only estimated, from counts by hash; that affects the order and so the cost, never the
result. Shingles are 64-bit hashes here: a pair could only be missed if two shingles of one pair of
texts had one hash. Pairs of one group are left out.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meltemi.llm.common import Scratch
from meltemi.llm.components import Forest

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Counters of shingles by hash, and how many of them travel in one row.
SLOTS, CHUNK = 1 << 22, 1 << 13
#: Texts of one shingle compared in one go; those of a more frequent one are dealt over several cells.
BLOCK = 1024
#: Texts of one shingle up to which the first round takes all pairs; of more it takes a spanning forest.
FEW = 8

SHARED = "h long, part int, parts int, node long, comp long, size int, pos int"


def gram_hashes(text: bytes | None, words: int) -> np.ndarray:
    """Hashes of the distinct shingles of a text, sorted; the shingles are those of simhash.shingles."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    tokens = np.array([digest(t) for t in (text or b"").lower().split()], np.uint64)
    width = min(words, len(tokens))
    n = len(tokens) - width + 1 if width else 1
    name = np.full(n, width, np.uint64)
    for k in range(width):
        name = (name ^ tokens[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        name ^= name >> np.uint64(29)
    return np.unique(name)


def _slots(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def _count_batches(words: int):
    """(chunk, at, n): the counters that are not zero, once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.uint32)
        for batch in batches:
            for t in batch.column("_text"):
                np.add.at(counts, _slots(gram_hashes(t.as_py(), words)), 1)
        out: tuple[list, list, list] = ([], [], [])
        for c, own in enumerate(counts.reshape(-1, CHUNK)):
            at = np.flatnonzero(own)
            if len(at):
                for column, value in zip(out, (c, at.astype(np.uint16).tobytes(), own[at].tobytes())):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], names=["chunk", "at", "n"])

    return run


def _sum_chunk(table: pa.Table) -> pa.Table:
    total = np.zeros(CHUNK, np.uint32)
    for at, n in zip(table.column("at"), table.column("n")):
        total[np.frombuffer(at.as_py(), np.uint16)] += np.frombuffer(n.as_py(), np.uint32)
    return pa.table({"chunk": table.column("chunk")[:1], "n": pa.array([total.tobytes()], pa.binary())})


def gram_counts(texts: DataFrame, words: int) -> np.ndarray:
    """How many texts have a shingle of each slot: a fixed number of counters, whatever the input."""
    parts = texts.select("_text").mapInArrow(_count_batches(words), "chunk int, at binary, n binary")
    counts = np.zeros((SLOTS // CHUNK, CHUNK), np.uint32)
    for r in parts.groupBy("chunk").applyInArrow(_sum_chunk, "chunk int, n binary").collect():
        counts[r.chunk] = np.frombuffer(r.n, np.uint32)
    return counts.ravel()


def _prefix_batches(shared, words: int, least: float):
    """(row, size, grams, parts): the rarest shingles of a text, rare ones first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        usual = 2 * int(counts.sum()) // SLOTS
        for batch in batches:
            size, grams, parts = [], [], []
            for t in batch.column("_text"):
                own = gram_hashes(t.as_py(), words)
                often = counts[_slots(own)]
                n = len(own) - math.ceil(least * len(own) - 1e-9) + 1
                first = np.lexsort((own, often))[:n]
                size.append(len(own))
                grams.append(own[first].view(np.int64))
                parts.append((1 + np.maximum(often[first].astype(np.int64) - usual, 0) // BLOCK).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(size, pa.int32()), pa.array(grams, pa.list_(pa.int64())), pa.array(parts, pa.list_(pa.int32()))],
                names=["row", "size", "grams", "parts"])

    return run


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of whole cells (h, part), from rows sorted by them."""
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        own = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
        if not batch.num_rows:
            continue
        same = (own["h"] == own["h"][-1]) & (own["part"] == own["part"][-1])
        cut = len(same) - int(same[::-1].argmin()) if not same.all() else 0
        if cut == 0 and held and (held[0]["h"][-1] != own["h"][0] or held[0]["part"][-1] != own["part"][0]):
            yield {c: np.concatenate([x[c] for x in held]) for c in own}
            held = []
        if cut:
            yield {c: np.concatenate([*(x[c] for x in held), own[c][:cut]]) for c in own}
            held = []
        held.append({c: v[cut:] for c, v in own.items()})
    if held:
        yield {c: np.concatenate([x[c] for x in held]) for c in held[0]}


def _edges(rows: dict[str, np.ndarray]) -> np.ndarray:
    new = (np.diff(rows["h"]) != 0) | (np.diff(rows["part"]) != 0)
    return np.concatenate([[0], np.flatnonzero(new) + 1, [len(rows["h"])]])


def _shared_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Without the shingles that only one group has; those dealt over several cells all stay."""
    for rows in _by_cell(batches):
        edges = _edges(rows)
        mixed = np.minimum.reduceat(rows["comp"], edges[:-1]) != np.maximum.reduceat(rows["comp"], edges[:-1])
        kept = np.repeat(mixed, np.diff(edges)) | (rows["parts"] > 1)
        if kept.any():
            yield pa.RecordBatch.from_arrays([pa.array(v[kept]) for v in rows.values()], names=list(rows))


def shared_grams(texts: DataFrame, groups: DataFrame, words: int, least: float, scratch: Scratch) -> DataFrame:
    """Rows (SHARED) of the shingles by which texts (row, _text) of different groups (node, comp) may be alike."""
    spark = texts.sparkSession
    counts = spark.sparkContext.broadcast(gram_counts(texts, words))
    first = texts.select("row", "_text").mapInArrow(
        _prefix_batches(counts, words, least), "row long, size int, grams array<long>, parts array<int>")
    placed = first.join(groups, first.row == groups.node).select(
        "node", "comp", "size", F.posexplode(F.arrays_zip("grams", "parts")).alias("pos", "at"))
    placed = placed.select(
        F.col("at.grams").alias("h"), F.pmod(F.xxhash64("node"), F.col("at.parts")).cast("int").alias("part"),
        F.col("at.parts").alias("parts"), "node", "comp", "size", "pos")
    return scratch.write(_sorted(placed).mapInArrow(_shared_batches, SHARED), "shared")


def _sorted(rows: DataFrame, *more: str) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "h", "part").sortWithinPartitions("h", "part", *more)


def _possible(rows: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Whether two rows of a cell are of different groups and, if they share no earlier shingle, may be alike."""
    room = np.minimum(rows["size"][x] - rows["pos"][x], rows["size"][y] - rows["pos"][y])
    enough = room * (1 + least) >= least * (rows["size"][x].astype(np.int64) + rows["size"][y]) - 1e-6
    return enough & (rows["comp"][x] != rows["comp"][y])


def _pairs_of(rows: dict[str, np.ndarray], lo: int, hi: int, least: float, spanning: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a cell: of those at home, and of each visitor with those at home."""
    home = np.arange(lo, lo + int((rows["role"][lo:hi] == 0).sum())) if "role" in rows else np.arange(lo, hi)
    if spanning:
        _, group = np.unique(rows["comp"][lo:hi], return_inverse=True)
        forest = Forest(int(group.max()) + 1)
    for at in range(lo, hi, 256):
        block = np.arange(at, min(at + 256, hi))
        x, y = np.repeat(block, len(home)), np.tile(home, len(block))
        fits = (x > y) & _possible(rows, x, y, least)
        x, y = x[fits], y[fits]
        if not spanning:
            yield x, y
            continue
        for e in forest.unite(group[x - lo], group[y - lo]):
            yield x[e], y[e]


def _pair_batches(least: float, spanning: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_cell(batches):
            edges = _edges(rows)
            sizes, found = np.diff(edges), []
            mixed = np.minimum.reduceat(rows["comp"], edges[:-1]) != np.maximum.reduceat(rows["comp"], edges[:-1])
            for n in range(2, FEW + 1):
                lo = edges[:-1][mixed & (sizes == n)]
                i, j = np.triu_indices(n, 1)
                x, y = (lo[:, None] + i).ravel(), (lo[:, None] + j).ravel()
                fits = _possible(rows, x, y, least)
                found.append((x[fits], y[fits]))
            for c in np.flatnonzero(mixed & (sizes > FEW)):
                found.extend(_pairs_of(rows, edges[c], edges[c + 1], least, spanning))
            x, y = (rows["node"][np.concatenate(side)] for side in zip(*found))
            if not len(x):
                continue
            pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in pairs], names=["a", "b"])

    return run


def some_pairs(shared: DataFrame, least: float) -> DataFrame:
    """(a, b): few pairs that would join the groups of each cell, if all were alike."""
    return _sorted(shared).mapInArrow(_pair_batches(least, True), "a long, b long").distinct()


def all_pairs(shared: DataFrame, groups: DataFrame, least: float) -> DataFrame:
    """(a, b): every pair that may be alike, of nodes that `groups` (node, comp) holds apart.

    Of a shingle dealt over several cells, all texts but those of its largest group visit every
    other cell; so a crowd that is one group already is neither copied nor compared with itself.
    """
    rows = shared.drop("comp").join(groups, "node").select("h", "part", "parts", "node", "comp", "size", "pos")
    hot = rows.filter("parts > 1")
    groups_of = hot.groupBy("h", "comp").agg(F.count("*").alias("n")).groupBy("h").agg(
        F.max_by("comp", "n").alias("largest"), F.count("*").alias("apart")).filter("apart > 1")
    hot = hot.join(groups_of.select("h", "largest"), "h")
    home = rows.filter("parts = 1").unionByName(hot.drop("largest")).withColumn("role", F.lit(0))
    visits = hot.filter("comp <> largest").withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    visits = visits.filter("cell <> part").withColumn("part", F.col("cell")).withColumn("role", F.lit(1))
    cells = home.unionByName(visits.select(*home.columns))
    return _sorted(cells, "role").mapInArrow(_pair_batches(least, False), "a long, b long").distinct()
