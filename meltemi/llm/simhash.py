"""SimHash near-duplicates by anchor-point covering.

Fingerprints are compared at the words of a covering code, the anchors. A fingerprint's home is
its nearest anchor, at most the covering radius away. For two fingerprints that differ in at most
t bits, the one farther from its own home, at distance h, lies within h + t of the other's home;
so each fingerprint visits every anchor within its own h + t, which is at most the covering radius
plus t, and is compared with the fingerprints at home there. No link is missed, whatever the data.

The code is a product of two equal codes over 32-bit halves: the first-order Reed-Muller code
(64 words, covering radius 12), widened by quadratic words as fingerprints grow in number.
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

from meltemi.llm import shingle_join
from meltemi.llm.common import Scratch
from meltemi.llm.components import Forest, connected_components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 42
#: Fingerprints at home in one cell; an anchor with more is compared in several cells.
CELL_HOMES = 8192
#: Distinct fingerprints up to which the smallest code serves; it affects cost, never results.
SMALL_CODE = 1 << 23


# ---- fingerprints -------------------------------------------------------------------------------

def fingerprint(text: bytes | None, words: int, bits: np.ndarray) -> int:
    """SimHash of the shingles of a text: a bit is set if set in over half of their hashes."""
    import xxhash

    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        grams = [b" ".join(tokens)]
    else:
        line, ends = b" ".join(tokens), np.cumsum([len(t) + 1 for t in tokens]).tolist()
        grams = [line[s:e - 1] for s, e in zip([0, *ends], ends[words - 1:])]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, SEED) for g in grams], dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(hashes[:, i], minlength=256) @ bits for i in range(8)])
    return int(np.packbits(2 * counts > len(grams), bitorder="little").view("<i8")[0])


def vocabulary_fingerprint(text: bytes | None, least: int, bits: np.ndarray) -> int:
    """SimHash of the distinct words of `least` bytes or more, or of all words if none is that long.

    Near copies differ in few of their words but in several shingles for each, so this fingerprint
    moves less between them than one of shingles.
    """
    import xxhash

    words = set((text or b"").lower().split())
    words = {w for w in words if len(w) >= least} or words
    if not words:
        return 0
    hashes = np.array([xxhash.xxh64_intdigest(w, SEED) for w in words], dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(hashes[:, i], minlength=256) @ bits for i in range(8)])
    return int(np.packbits(2 * counts > len(words), bitorder="little").view("<i8")[0])


def _fingerprint_batches(words: int, vocabulary: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
        for batch in batches:
            texts = batch.column("_text")
            prints = [(vocabulary_fingerprint if vocabulary else fingerprint)(t.as_py(), words, bits) for t in texts]
            kept = [c for c in batch.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(prints, pa.int64())], names=[*kept, "fp"])

    return run


def fingerprints(docs: DataFrame, words: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp) of every row: fp holds the 64 bits as a signed long; no word gives zero."""
    rows = docs.select(F.col(key), F.col(text).cast("binary").alias("_text"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(_fingerprint_batches(words), f"`{key}` {kind}, fp long")


# ---- the code -----------------------------------------------------------------------------------

def half_code(extra: int) -> np.ndarray:
    """Words of a linear code of length 32: affine functions of five bits, and `extra` products of two."""
    point = np.arange(32)
    rows = [np.ones(32, dtype=np.int64), *((point >> i) & 1 for i in range(5))]
    pairs = [(i, j) for i in range(5) for j in range(i + 1, 5)]
    rows += [((point >> i) & (point >> j)) & 1 for i, j in pairs[:extra]]
    words = np.zeros(1, dtype=np.uint32)
    for row in rows:
        word = np.uint32(int((row.astype(np.uint64) << point.astype(np.uint64)).sum()))
        words = np.concatenate([words, words ^ word])
    return words


def code_size(distinct: int) -> int:
    """Quadratic rows per half, so that an anchor's share stays about as large as input grows."""
    return min(10, max(0, math.ceil(math.log2(max(1, distinct / SMALL_CODE)) / 2)))


def distances(prints: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distance of each half to every word over its least one, and each row's home anchor."""
    low, high = (prints & 0xFFFFFFFF).astype(np.uint32), (prints >> 32).astype(np.uint32)
    first, second = (np.bitwise_count(h[:, None] ^ words[None, :]) for h in (low, high))
    home = first.argmin(axis=1) * len(words) + second.argmin(axis=1)
    return first - first.min(axis=1, keepdims=True), second - second.min(axis=1, keepdims=True), home


def visits(prints: np.ndarray, words: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor) of every visit, and each row's home anchor."""
    over_1, over_2, home = distances(prints, words)
    rows, anchors = [], []
    # The excess over the nearest word is dealt between the halves.
    for excess in range(radius + 1):
        r1, w1 = np.nonzero(over_1 == excess)
        r2, w2 = np.nonzero(over_2 <= radius - excess)
        start, stop = np.searchsorted(r2, r1), np.searchsorted(r2, r1, side="right")
        n = stop - start
        take = np.repeat(start - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())
        rows.append(np.repeat(r1, n))
        anchors.append(np.repeat(w1, n) * len(words) + w2[take])
    return np.concatenate(rows), np.concatenate(anchors), home


def _visit_batches(extra: int, radius: int, cells: dict[int, int]):
    """Rows (anchor, cell, role, prints): fingerprints at home (role 0) or visiting (role 1), as packed bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = half_code(extra)
        step = max(64, (1 << 19) // len(words))
        for batch in batches:
            prints = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            keys, values = [], []
            homes_key, homes_value = [], []
            for lo in range(0, len(prints), step):
                part = prints[lo:lo + step]
                row, anchor, home = visits(part, words, radius)
                keys.append(anchor)
                values.append(part[row])
                homes_key.append(home)
                homes_value.append(part)
            if not keys:
                continue
            yield from _packed(np.concatenate(homes_key), np.concatenate(homes_value), 0, cells)
            yield from _packed(np.concatenate(keys), np.concatenate(values), 1, cells)

    return run


def _packed(anchor: np.ndarray, prints: np.ndarray, role: int, cells: dict[int, int]) -> Iterator[pa.RecordBatch]:
    order = np.argsort(anchor, kind="stable")
    anchor, prints = anchor[order], prints[order]
    edges = np.flatnonzero(np.diff(anchor, prepend=-1))
    out: tuple[list, list, list, list] = ([], [], [], [])
    for lo, hi in zip(edges, [*edges[1:], len(anchor)]):
        a, part = int(anchor[lo]), prints[lo:hi]
        n = cells.get(a, 1)
        deal = _deal(part, n) if n > 1 and role == 0 else None
        for c in range(n):
            own = part if deal is None else part[deal == c]
            if len(own):
                for column, value in zip(out, (a, c, role, own.tobytes())):
                    column.append(value)
    yield pa.RecordBatch.from_arrays(
        [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()),
         pa.array(out[3], pa.binary())], names=["anchor", "cell", "role", "prints"])


def _deal(prints: np.ndarray, n: int) -> np.ndarray:
    return ((prints * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(n)


# ---- comparison ---------------------------------------------------------------------------------

class Cell:
    """Fingerprints at home in a cell; visitors stream past, and a spanning forest of the links comes out."""

    BLOCK = 1 << 20

    def __init__(self, radius: int):
        self.radius, self.homes, self.forest = radius, np.empty(0, np.uint64), Forest(0)

    def settle(self, prints: np.ndarray) -> None:
        self.homes = np.concatenate([self.homes, prints])
        self.forest = Forest(len(self.homes))

    def meet(self, visitors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links of a spanning forest, closest first; visitors are forgotten once their links have joined the homes."""
        n = len(self.homes)
        if not n:
            return
        step = max(1, self.BLOCK // n)
        for lo in range(0, len(visitors), step):
            block = visitors[lo:lo + step]
            apart = np.bitwise_count(block[:, None] ^ self.homes[None, :])
            who, home = np.nonzero(apart <= self.radius)
            if not len(who):
                continue
            near = apart[who, home]
            both = Forest(n + len(block))
            both.root[:n] = self.forest.root
            for distance in np.unique(near):
                at = np.flatnonzero(near == distance)
                for e in both.unite(n + who[at], home[at]):
                    yield block[who[at[e]]], self.homes[home[at[e]]]
            # A set that holds a home has a home as its root, homes being numbered first.
            self.forest.root = both.root[:n]


def _compare_batches(radius: int):
    """Rows come sorted by (anchor, cell, role): homes before visitors, one cell in memory at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, cell = None, Cell(radius)
        for batch in batches:
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for a, c, role, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (a, c) != here:
                    here, cell = (a, c), Cell(radius)
                prints = np.frombuffer(raw, np.uint64)
                if role == 0:
                    cell.settle(prints)
                else:
                    found.extend(cell.meet(prints))
            if found:
                x, y = (np.concatenate(side) for side in zip(*found))
                pairs = [side[x != y].view(np.int64) for side in (x, y)]
                yield pa.RecordBatch.from_arrays([pa.array(p) for p in pairs], names=["a", "b"])

    return run


def link_forest(prints: DataFrame, radius: int, scratch: Scratch) -> DataFrame:
    """(a, b): links between distinct fingerprints, as many as keep every component connected.

    Groups of k fingerprints that all link give about k rows per anchor met, not k squared.
    """
    spark = prints.sparkSession
    distinct = scratch.write(prints.select("fp").distinct(), "prints")
    extra = code_size(distinct.count())
    homes = distinct.mapInArrow(_home_batches(extra), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    # At most one row per anchor over the cell size.
    crowded = {r.anchor: -(-r.n // CELL_HOMES) for r in homes.filter(F.col("n") > CELL_HOMES).collect()}
    placed = distinct.mapInArrow(_visit_batches(extra, radius, crowded), "anchor long, cell int, role int, prints binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartition(parts, "anchor", "cell").sortWithinPartitions("anchor", "cell", "role")
    forest = scratch.write(placed.mapInArrow(_compare_batches(radius), "a long, b long"), "links")
    scratch.drop(distinct)
    return forest


def _home_batches(extra: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = half_code(extra)
        for batch in batches:
            prints = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            anchors = np.concatenate([np.empty(0, np.int64), *(
                distances(prints[lo:lo + 512], words)[2] for lo in range(0, len(prints), 512))])
            which, n = np.unique(anchors, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(n.astype(np.int64))], names=["anchor", "n"])

    return run


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id, fp): every row with its fingerprint and the smallest key it can reach.

    Fingerprints link at `radius` or fewer differing bits. A null or blank text has fingerprint zero
    and links like any other. Equal texts and repeated rows share a component. A null key is never a
    component's smallest; a component of null keys alone has a null id. Other columns are not read.
    An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    prints = scratch.write(fingerprints(docs, words, key, text), "fingerprints")
    forest = link_forest(prints, radius, scratch)
    roots = connected_components(forest, "a", "b", scratch)
    classes = prints.groupBy("fp").agg(F.min(key).alias("least"))
    classes = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = scratch.write(classes.select("fp", "root").join(least, "root").select("fp", "component_id"), "labels")
    scratch.drop(forest)
    out = prints.join(labels, "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp")
    scratch.later()
    return out


# ---- near copies by shingles --------------------------------------------------------------------

def shingles(text: bytes | None, words: int) -> set[bytes]:
    """Distinct shingles of a text; with fewer words its whole sequence, without any the empty shingle."""
    tokens = (text or b"").lower().split()
    return {b" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))}


def _alike_batches(words: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike, last, y = [], None, set()
            for a, b in zip(batch.column("text_a"), batch.column("text_b")):
                # Rows come joined by b, so that one text often follows itself.
                x, other = shingles(a.as_py(), words), b.as_py()
                if other != last:
                    last, y = other, shingles(other, words)
                both = len(x & y)
                alike.append(both >= least * (len(x) + len(y) - both))
            yield batch.filter(pa.array(alike, pa.bool_())).select(["a", "b"])

    return run


def similar_documents(
    rows: DataFrame, words: int = 5, least: float = 0.8, radius: int = 7, shortest: int = 5, key: str = "_row", text: str = "text",
) -> DataFrame:
    """(key, root): rows whose word shingles are alike share a root, the smallest key of their group.

    A pair is a link if the Jaccard similarity of the distinct shingles is `least` or more, computed
    exactly. Most links come from texts whose vocabulary fingerprints differ in at most `radius`
    bits: of each crowd a spanning forest is checked, closest pairs first, and each text of a
    fingerprint with the first one. Of the texts still apart, every pair that can reach `least` is
    then found by shingle_join and checked, so a root is that of all links, whatever the fingerprints
    do. Equal texts always share a root. The key must be a unique long; null and blank texts are alike.
    """
    scratch = Scratch(rows.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    named = rows.select(F.col(key).alias("row"), F.sha2(body, 256).alias("t"), body.cast("binary").alias("_text"))
    prints = named.mapInArrow(_fingerprint_batches(shortest, vocabulary=True), "row long, t string, fp long")
    prints = scratch.write(prints, "vocabulary")
    # One row stands for equal texts, and one text for equal fingerprints.
    nodes = scratch.write(prints.groupBy("t", "fp").agg(F.min("row").alias("node")), "nodes")
    first = nodes.groupBy("fp").agg(F.min("node").alias("first"))
    forest = link_forest(nodes, radius, scratch)
    ends = first.withColumnsRenamed({"fp": "a", "first": "x"}), first.withColumnsRenamed({"fp": "b", "first": "y"})
    crossing = forest.join(ends[0], "a").join(ends[1], "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    inside = nodes.join(first, "fp").filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    pairs = scratch.write(crossing.unionByName(inside).distinct(), "candidates")
    links = [_alike(named, pairs, words, least, scratch)]
    groups = _groups(nodes, links, scratch)
    shared = shingle_join.shared_grams(named, groups, words, least, scratch)
    some = scratch.write(shingle_join.some_pairs(shared, least), "some")
    links.append(_alike(named, some, words, least, scratch))
    groups = _groups(nodes, links, scratch)
    rest = shingle_join.all_pairs(shared, groups, least).join(some, ["a", "b"], "left_anti")
    rest = scratch.write(rest, "rest")
    links.append(_alike(named, rest, words, least, scratch))
    groups = _groups(nodes, links, scratch)
    known = scratch.write(nodes.join(groups, "node").select("t", F.col("comp").alias("root")), "roots")
    scratch.drop(forest, pairs, shared, some, rest, *links)
    out = prints.join(known, "t").select(F.col("row").alias(key), "root")
    scratch.later()
    return out


def _alike(named: DataFrame, pairs: DataFrame, words: int, least: float, scratch: Scratch) -> DataFrame:
    """(a, b): those pairs of rows whose shingles are alike."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    texts = scratch.write(named.select("row", "_text").join(needed, "row", "left_semi"), "texts")
    sides = texts.withColumnsRenamed({"row": "a", "_text": "text_a"}), texts.withColumnsRenamed({"row": "b", "_text": "text_b"})
    links = scratch.write(pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "text_a", "text_b").mapInArrow(
        _alike_batches(words, least), "a long, b long"), "alike")
    scratch.drop(texts)
    return links


def _groups(nodes: DataFrame, links: list[DataFrame], scratch: Scratch) -> DataFrame:
    """(node, comp): the smallest node that each node reaches over the links."""
    edges = links[0]
    for more in links[1:]:
        edges = edges.unionByName(more)
    roots = connected_components(edges, "a", "b", scratch).withColumnRenamed("node", "at")
    return scratch.write(nodes.join(roots, nodes.node == roots.at, "left").select("node", F.coalesce("root", "node").alias("comp")), "groups")
