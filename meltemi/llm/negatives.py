"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Candidates are ordered by label and by a Hilbert curve through their most spread dimensions and
stored in Parquet, one row per block of near vectors of one label, with the smallest and largest
component per dimension beside the packed vectors. Interval arithmetic over these zone maps bounds
every score between an anchor and a block: only blocks whose interval meets a window some anchor of a
group asks for are read, and inside a block's task each anchor is held against the interval again,
with the bar its best five have reached by then.

Anchors go through the blocks in groups of bounded size. A cell of the work is one group of anchors
and one part of the blocks, sent to one task anchors first; a task holds a group and a block.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meltemi.llm.common import BATCH_BYTES, Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a block, anchors of a group, blocks of a cell.
BLOCK, GROUP, CELL = 512, 4096, 256
#: Dimensions the curve runs through, and bits for each.
CURVE_DIMS, CURVE_BITS = 8, 8
SCALE = 256.0
#: Scaled components stay inside this, so that products of up to 2,048 dimensions fit in 64 bits.
LARGEST = 1 << 26
LEAST, MOST = -(1 << 62), 1 << 62


def quantise(vector: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * vector), -LARGEST, LARGEST).astype(np.int32)


def _row_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, size, raw) of rows that take part."""
    for batch in batches:
        kept, sizes, raw = [], [], []
        for k, v in enumerate(batch.column("vector")):
            own = v.as_py()
            if own is None or None in own:
                continue
            own = np.array(own, np.float64)
            if np.isfinite(own).all():
                kept.append(k)
                sizes.append(len(own))
                raw.append(quantise(own).tobytes())
        rows = batch.take(pa.array(kept, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [rows.column("id"), rows.column("label"), pa.array(sizes, pa.int32()), pa.array(raw, pa.binary())],
            names=["id", "label", "size", "raw"])


def _spread_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(size, dim, n, total, squares): sums over the rows of a task."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        raw = batch.column("raw").to_pylist()
        for size in {len(r) // 4 for r in raw} - {0}:
            own = np.stack([np.frombuffer(r, np.int32) for r in raw if len(r) == 4 * size]).astype(np.float64)
            sums[size] = sums.get(size, 0) + np.stack([np.full(size, len(own)), own.sum(axis=0), (own * own).sum(axis=0)])
    rows = [(size, dim, *s[:, dim]) for size, s in sums.items() for dim in range(size)]
    kinds = [pa.int32(), pa.int32(), *[pa.float64()] * 3]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["size", "dim", "n", "total", "squares"])


def curve(vectors: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By vector size, the dimensions the curve runs through and their mean and deviation: one row per dimension."""
    sums = vectors.select("raw").mapInArrow(_spread_batches, "size int, dim int, n double, total double, squares double")
    rows = sums.groupBy("size", "dim").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")]).collect()
    found = {}
    for size in {r["size"] for r in rows}:
        own = sorted((r for r in rows if r["size"] == size), key=lambda r: r.dim)
        mean = np.array([r.total / r.n for r in own])
        deviation = np.sqrt(np.maximum(np.array([r.squares / r.n for r in own]) - mean * mean, 0))
        dims = np.argsort(-deviation, kind="stable")[:CURVE_DIMS]
        found[size] = (dims, mean[dims], np.maximum(deviation[dims], 1e-9))
    return found


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of rows of cell numbers, as integers of bits * dimensions bits.

    Skilling's transform: Gray-coded axes, with the reflections and exchanges of every level undone
    from the highest bit down, then the bits of all axes interleaved.
    """
    x = cells.T.astype(np.uint64).copy()
    n, one = len(x), np.uint64(1)
    for level in range(bits - 1, 0, -1):
        top = np.uint64(1 << level)
        below = top - one
        for i in range(n):
            high = (x[i] & top) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(high, below, swap)
            x[i] ^= swap if i else np.uint64(0)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    mask = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        mask ^= np.where((x[n - 1] & np.uint64(1 << level)) != 0, np.uint64((1 << level) - 1), np.uint64(0))
    x ^= mask
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << one) | ((x[i] >> np.uint64(level)) & one)
    return place


def _place_batches(through: dict):
    """Adds `place`, the row's place along the curve of its vector size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("raw").to_pylist()
            places = np.zeros(len(raw), np.int64)
            for size in {len(r) // 4 for r in raw} - {0}:
                rows = [k for k, r in enumerate(raw) if len(r) == 4 * size]
                dims, mean, deviation = through[size]
                own = np.stack([np.frombuffer(raw[k], np.int32) for k in rows])[:, dims]
                share = np.clip((own - mean) / (6 * deviation) + 0.5, 0, 1)
                cells = np.minimum(share * (1 << CURVE_BITS), (1 << CURVE_BITS) - 1).astype(np.uint64)
                # The highest bit is flipped, so that the order of signed numbers is that of the curve.
                places[rows] = (hilbert(cells, CURVE_BITS) ^ np.uint64(1 << 63)).view(np.int64) if len(dims) * CURVE_BITS == 64 \
                    else hilbert(cells, CURVE_BITS).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places)], names=[*batch.schema.names, "place"])

    return run


BLOCKS = "block long, label long, size int, n int, low binary, high binary, ids binary, vectors binary"


def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts rows sorted by label, size and place into blocks of one label and size."""
    task, count, kind, ids, raw = TaskContext.get().partitionId(), 0, None, [], []

    def block() -> tuple:
        own = np.frombuffer(b"".join(raw), np.int32).reshape(len(raw), kind[1])
        return ((task << 32) + count, *kind, len(ids), own.min(axis=0).tobytes(), own.max(axis=0).tobytes(),
                np.array(ids, np.int64).tobytes(), own.tobytes())

    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    for batch in batches:
        rows = []
        for i, label, size, own in zip(*(batch.column(c).to_pylist() for c in ("id", "label", "size", "raw"))):
            if ids and (kind != (label, size) or len(ids) == BLOCK):
                rows.append(block())
                count, ids, raw = count + 1, [], []
            kind = (label, size)
            ids.append(i)
            raw.append(own)
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(block(), kinds)], names=names)


def _matrix(packed: list[bytes], size: int, largest: int) -> np.ndarray:
    """Vectors as numbers whose products are exact: float32 or float64 while sums stay in their integers, else int64."""
    own = np.stack([np.frombuffer(p, np.int32) for p in packed]).reshape(len(packed), size)
    return own.astype(np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else np.int64)


def interval(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest score each anchor can have with a vector inside a zone; exact."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ low + down @ high, up @ high + down @ low


class Group:
    """A group's anchors of one vector size, with the windows each still looks for.

    A window is (floor, ceiling): the `most` best scores inside are wanted, of rows with the anchor's
    label where `same`, else of others.
    """

    def __init__(self, rows: list[tuple], same: bool, most: int):
        self.same, self.most = same, most
        self.ids, self.labels = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        self.packed = [r[3] for r in rows]
        self.size = rows[0][2]
        windows = [np.frombuffer(r[4], np.int64).reshape(-1, 2) for r in rows]
        self.owner = np.repeat(np.arange(len(rows)), [len(w) for w in windows])
        self.rank = np.concatenate([np.arange(len(w)) for w in windows])
        self.floor, self.ceiling = (np.concatenate([w[:, k] for w in windows]) for k in (0, 1))
        self.best: list[list[tuple]] = [[] for _ in self.owner]
        # The least score a row must have to be among a window's best so far.
        self.bar = self.floor.copy()
        self.numbers: dict[int, np.ndarray] = {}
        self.norm = max(int((np.frombuffer(p, np.int32).astype(object) ** 2).sum()) if p else 0 for p in self.packed)

    def anchors(self, largest: int) -> np.ndarray:
        kind = 0 if largest < 1 << 24 else 1 if largest < 1 << 53 else 2
        if kind not in self.numbers:
            self.numbers[kind] = _matrix(self.packed, self.size, largest)
        return self.numbers[kind]

    def wanting(self, label: int, low: bytes, high: bytes) -> np.ndarray:
        """Numbers of the windows that a block's interval meets."""
        ends = np.stack([np.frombuffer(low, np.int32), np.frombuffer(high, np.int32)]).astype(np.int64)
        # Sums of |anchor| * |zone| stay below the product of lengths.
        zone = np.abs(ends).max(axis=0, initial=0).astype(object)
        numbers = self.anchors(_bound(self.norm, int((zone * zone).sum())))
        least, most = interval(numbers, *ends.astype(numbers.dtype))
        meets = (most[self.owner] >= self.bar) & (least[self.owner] <= self.ceiling)
        right = (self.labels == label) if self.same else (self.labels != label)
        return np.flatnonzero(meets & right[self.owner])

    def read(self, windows: np.ndarray, ids: bytes, vectors: bytes) -> None:
        """Hold a block's rows against the windows that want it."""
        names = np.frombuffer(ids, np.int64)
        own = np.frombuffer(vectors, np.int32).reshape(len(names), self.size)
        norm = int((own.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) + 1
        largest = _bound(self.norm, norm)
        used, at = np.unique(self.owner[windows], return_inverse=True)
        numbers = self.anchors(largest)
        scores = numbers[used] @ own.astype(numbers.dtype).T
        for lo in range(0, len(windows), 256):
            part = windows[lo:lo + 256]
            s = scores[at[lo:lo + 256]]
            good = (s >= self.bar[part, None]) & (s <= self.ceiling[part, None])
            if self.same:
                good &= names[None, :] != self.ids[used[at[lo:lo + 256]], None]
            for k in np.flatnonzero(good.any(axis=1)):
                w = part[k]
                rows = np.flatnonzero(good[k])
                found = self.best[w] + list(zip((-s[k, rows].astype(np.int64)).tolist(), names[rows].tolist()))
                found.sort()
                self.best[w] = found[:self.most]
                if len(found) >= self.most:
                    self.bar[w] = max(self.bar[w], -found[self.most - 1][0])

    def found(self) -> list[tuple]:
        return [(int(self.ids[o]), int(self.labels[o]), self.packed[o], int(r), i, -s)
                for o, r, best in zip(self.owner, self.rank, self.best) for s, i in best]


def _bound(one: int, other: int) -> int:
    """No sum of products is larger, by Cauchy-Schwarz."""
    return int(np.ceil(np.sqrt(float(one)) * np.sqrt(float(other)))) + 1


CELLS = "grp int, part int, kind int, turn long, id long, label long, size int, raw binary, windows binary, low binary, high binary, ids binary"
FOUND = "id long, label long, raw binary, place int, other long, score long"
NEEDED = "grp int, block long, turn long"


def _cell_rows(batches: Iterator[pa.RecordBatch], same: bool, most: int, reads: bool):
    """Rows of cells, anchors first. Without `reads`, the blocks a group needs; with it, the best of every window."""
    names = [c.split()[0] for c in (FOUND if reads else NEEDED).split(", ")]
    kinds = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]] for c in (FOUND if reads else NEEDED).split(", ")]

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=names)

    # A cell's groups are made when its first block comes; all its anchors have come by then.
    here, waiting, groups, out = None, [], None, []
    for batch in batches:
        for g, part, kind, turn, i, label, size, raw, windows, low, high, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (g, part) != here:
                if reads:
                    out += [f for x in (groups or {}).values() for f in x.found()]
                here, waiting, groups = (g, part), [], None
            if kind == 0:
                waiting.append((i, label, size, raw, windows))
                continue
            if groups is None:
                groups = {s: Group([w for w in waiting if w[2] == s], same, most) for s in {w[2] for w in waiting}}
            group = groups.get(size)
            if group is None:
                continue
            wanting = group.wanting(label, low, high)
            if not len(wanting):
                continue
            if reads:
                group.read(wanting, ids, raw)
            else:
                out.append((g, i, turn))
        if not reads and out:
            yield rows(out)
            out = []
    if reads:
        out += [f for x in (groups or {}).values() for f in x.found()]
    yield rows(out)


def _cell_batches(same: bool, most: int, reads: bool):
    return lambda batches: _cell_rows(batches, same, most, reads)


def _windows_found(anchors: DataFrame, blocks: DataFrame, zones: DataFrame, shape: tuple[int, int], same: bool, most: int, scratch: Scratch):
    """FOUND rows for the windows of all anchors: zone maps choose the blocks, then those are read."""
    spark = anchors.sparkSession
    groups, count = shape
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    parts = max(-(-count // CELL), min(count, tasks) // groups, 1)
    part = F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part")
    none = F.lit(None).cast("binary")
    every_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    asking = anchors.select(
        "grp", every_part, F.lit(0).alias("kind"), F.lit(0).cast("long").alias("turn"), "id", "label", "size", "raw", "windows",
        none.alias("low"), none.alias("high"), none.alias("ids"))

    def cells(of_blocks: DataFrame, reads: bool, schema: str) -> DataFrame:
        rows = asking.unionByName(of_blocks).select(*[c.split()[0] for c in CELLS.split(", ")])
        by = ["grp", "part"]
        rows = rows.repartition(min(groups * parts, 4 * tasks + groups * parts // 8), *by).sortWithinPartitions(*by, "kind", "turn")
        return rows.mapInArrow(_cell_batches(same, most, reads), schema)

    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp")
    mapped = zones.select(
        every_group, part, F.lit(1).alias("kind"), F.col("block").alias("turn"), F.col("block").alias("id"), "label", "size",
        none.alias("raw"), none.alias("windows"), "low", "high", none.alias("ids"))
    needed = scratch.write(cells(mapped, False, NEEDED), "needed")
    chosen = needed.join(blocks, "block").select(
        "grp", part, F.lit(1).alias("kind"), "turn", F.col("block").alias("id"), "label", "size", F.col("vectors").alias("raw"),
        none.alias("windows"), "low", "high", "ids")
    return cells(chosen, True, FOUND)


def _grouped(anchors: DataFrame, parts: int, scratch: Scratch) -> DataFrame:
    """Anchors near along the curve share a group: they are sorted, and numbered by their task's offset and their place in it."""
    spark = anchors.sparkSession
    by = ["label", "size", "place", "id"]
    at = F.monotonically_increasing_id()
    ordered = anchors.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumns(
        {"task": F.shiftright(at, 33), "turn": at.bitwiseAND((1 << 33) - 1)})
    ordered = scratch.write(ordered, "anchors")
    offsets, before = [], 0
    # One row per task.
    for row in sorted(ordered.groupBy("task").count().collect()):
        offsets.append((row.task, before))
        before += row["count"]
    return ordered.join(spark.createDataFrame(offsets, "task long, before long"), "task").select(
        "id", "label", "size", "raw", F.floor((F.col("before") + F.col("turn")) / GROUP).cast("int").alias("grp"))


def mine(
    vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows take part whose key and label are not null and whose vector is not null and holds finite
    numbers only; those whose key is divisible by `every` are anchors. Components become
    floor(256 * x), kept inside 2^26. A score is the integer inner product; vectors of different sizes
    have none. An anchor's positives are its best `positives` rows of the same label and another key;
    a positive's negatives the best `negatives` rows of another label whose score times 100 is from
    `low` to `high` times the positive's. Higher scores come first, then smaller keys. Rows equal in key,
    label and vector count once; other rows that share a key all take part, each under that key. An
    empty vector scores zero with its like. Anchors without positives, and positives without
    negatives, give no row, nor does an empty table. Other columns are not read. Keys and labels are
    integers.
    """
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    scratch = Scratch(spark)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"))
    rows = rows.filter("id is not null and label is not null and vector is not null")
    rows = rows.mapInArrow(_row_batches, "id long, label long, size int, raw binary")
    rows = scratch.write(rows.dropDuplicates(["id", "label", "raw"]), "quantised")
    placed = rows.mapInArrow(_place_batches(curve(rows)), "id long, label long, size int, raw binary, place long")
    by = ["label", "size", "place", "id"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # The id parts rows of one place, so copies do not end in one task.
    ordered = placed.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    blocks = scratch.write(ordered.mapInArrow(_block_batches, BLOCKS), "blocks")
    zones = blocks.select("block", "label", "size", "low", "high")
    anchors = scratch.write(_grouped(placed.filter(F.col("id") % every == 0), parts, scratch), "grouped")
    shape = (anchors.agg(F.max("grp")).first()[0], blocks.count())
    if shape[0] is None:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    shape = (shape[0] + 1, shape[1])
    whole = F.lit(bytearray(np.array([[LEAST, MOST]], np.int64).tobytes()))
    best = Window.partitionBy("id", "label", "raw", "place").orderBy(F.col("score").desc(), "other")
    near = _windows_found(anchors.withColumn("windows", whole), blocks, zones, shape, True, positives, scratch)
    near = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= positives)
    near = scratch.write(near.select(
        "id", "label", "raw", (F.col("rank") - 1).alias("place"), F.col("other").alias("positive_id"),
        F.col("score").alias("positive_score")), "near")
    # Of scores s with low * p <= 100 * s <= high * p, the smallest and the largest; div cuts towards zero.
    floor = F.expr(f"({low} * positive_score) div 100 + if({low} * positive_score % 100 > 0, 1, 0)")
    ceiling = F.expr(f"({high} * positive_score) div 100 - if({high} * positive_score % 100 < 0, 1, 0)")
    windows = near.groupBy("id", "label", "raw").agg(F.sort_array(F.collect_list(
        F.struct("place", floor.alias("floor"), ceiling.alias("ceiling")))).alias("w"))  # `positives` at most
    windows = windows.mapInArrow(_window_batches, "id long, label long, raw binary, windows binary")
    windows = scratch.write(anchors.join(windows, ["id", "label", "raw"]), "windows")
    far = _windows_found(windows, blocks, zones, shape, False, negatives, scratch)
    far = far.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
    found = far.join(near, ["id", "label", "raw", "place"]).select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
    scratch.later()
    return found


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of an anchor in order of its positives, packed."""
    for batch in batches:
        packed = [np.array([(w["floor"], w["ceiling"]) for w in row], np.int64).tobytes() for row in batch.column("w").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("id", "label", "raw")] + [pa.array(packed, pa.binary())],
                                         names=["id", "label", "raw", "windows"])
