"""Ranked lexical search over impact vectors in buckets of like length.

A document's impact vector has w * s for each term of the items, w the term's weight and s its
saturated frequency; an item's has one at each of its terms, so their product is the score. Vectors
are ordered by length and cut into buckets. An item passes over a bucket whose longest vector cannot
reach its tenth score (Cauchy-Schwarz). Inside, its heaviest coordinates are summed first; what the
others can add is bounded by the rest of a vector's length and by each coordinate's largest value in
the bucket. Whoever may still reach the tenth score is scored again in integers, over all terms.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meltemi.llm.common import BATCH_BYTES, Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Terms of the items that are searched for in one pass over the documents; more items take more passes.
PASS_TERMS = 500_000
#: A bucket's vectors and their coordinates at most; one longer vector is a bucket of its own.
BUCKET_ROWS, BUCKET_CELLS = 1024, 1 << 18
#: Buckets of the longest vectors, whose scores give the others a bar to reach.
FIRST_BUCKETS = 16
#: Coordinates summed before the rest is bounded.
FOCUS = 8
#: Text bytes split at a time.
SEGMENT = 1 << 20
#: Floats only decide what is scored again; their rounding stays far below this share.
SLACK = 1e-6

_CLEAN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_parts(text: bytes | None) -> Iterator[list[bytes]]:
    """Terms of a text in order, SEGMENT bytes at a time, cut between terms."""
    clean, at = (text or b"").translate(_CLEAN), 0
    while at < len(clean):
        end = clean.find(b" ", at + SEGMENT)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def term_weight(total: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * total + 2) / (2 * holding + 1)))


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [list({t: None for part in term_parts(v.as_py()) for t in part}) for v in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item"), batch.column("name"), pa.array(own, pa.list_(pa.binary()))], names=["item", "name", "terms"])


def _count_batches(vocabulary):
    """(doc, n, terms, counts) of documents with a term: n terms in all, and how often it has each of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in batches:
            docs, ns, terms, counts, ends = [], [], [], [], [0]
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text")):
                n, held = 0, Counter()
                for part in term_parts(text.as_py()):
                    n += len(part)
                    held.update(map(number, part))
                if not n:
                    continue
                held.pop(None, None)
                docs.append(doc)
                ns.append(n)
                terms += held.keys()
                counts += held.values()
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(ns, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))], names=["doc", "n", "terms", "counts"])

    return run


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _sizes(column: pa.Array) -> np.ndarray:
    return np.diff(column.offsets.to_numpy())


def _impacts(batch: pa.RecordBatch, weights: np.ndarray, total: int, all_terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Impact of every coordinate of the batch, and the coordinates of each vector."""
    sizes = _sizes(batch.column("terms"))
    # In Python's integers, as 90 * n * N can pass 64 bits.
    m = np.array([10 + 90 * n * total // all_terms for n in batch.column("n").to_pylist()], np.int64)
    counts = _flat(batch.column("counts"))
    own = weights[_flat(batch.column("terms"))] * ((1_000_000_000 * counts) // (1000 * counts + 8 * np.repeat(m, sizes)))
    return own, sizes


def _lengths(impacts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    rows = np.repeat(np.arange(len(sizes)), sizes)
    return np.sqrt(np.bincount(rows, impacts.astype(np.float64) ** 2, len(sizes)))


def _length_batches(weights, total: int, all_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _lengths(*_impacts(batch, weights.value, total, all_terms))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], names=[*batch.schema.names, "length"])

    return run


def _bucket_batches(weights, total: int, all_terms: int):
    """One row per bucket; rows come by falling length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, cells = [], 0, 0
        for batch in batches:
            at, sizes = 0, _sizes(batch.column("terms"))
            for k, size in enumerate(sizes.tolist()):
                if rows + k - at and (rows + k - at >= BUCKET_ROWS or cells + size > BUCKET_CELLS):
                    yield _bucket([*held, batch.slice(at, k - at)], weights.value, total, all_terms)
                    held, rows, cells, at = [], 0, 0, k
                cells += size
            held.append(batch.slice(at))
            rows += batch.num_rows - at
        if rows:
            yield _bucket(held, weights.value, total, all_terms)

    return run


def _bucket(parts: list[pa.RecordBatch], weights: np.ndarray, total: int, all_terms: int) -> pa.RecordBatch:
    # The slices are copied, so that their lists start at zero.
    batch = pa.Table.from_batches(parts).take(np.arange(sum(p.num_rows for p in parts))).combine_chunks().to_batches()[0]
    impacts, sizes = _impacts(batch, weights, total, all_terms)
    lengths = _lengths(impacts, sizes)
    packed = [sizes.astype(np.int32), _flat(batch.column("terms")).astype(np.int32), impacts]
    return pa.RecordBatch.from_arrays(
        [pa.array([float(lengths.max())]), pa.array([batch.column("doc").to_pylist()], pa.list_(pa.int64())),
         *(pa.array([x.tobytes()], pa.binary()) for x in packed)], names=["longest", "docs", "sizes", "terms", "impacts"])


class Bucket:
    """Vectors of like length, by row and by coordinate."""

    def __init__(self, sizes: bytes, terms: bytes, impacts: bytes):
        self.sizes = np.frombuffer(sizes, np.int32).astype(np.int64)
        self.terms, self.impacts = np.frombuffer(terms, np.int32), np.frombuffer(impacts, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        rows = np.repeat(np.arange(len(self.sizes)), self.sizes)
        by_term = np.argsort(self.terms, kind="stable")
        self.rows, self.values = rows[by_term], self.impacts[by_term].astype(np.float64)
        self.present, first = np.unique(self.terms[by_term], return_index=True)
        self.ends = np.append(first, len(by_term))
        self.most = np.maximum.reduceat(self.values, first) if len(first) else np.zeros(0)
        self.squares = np.bincount(rows, self.impacts.astype(np.float64) ** 2, len(self.sizes))
        self.length = math.sqrt(self.squares.max()) if len(self.sizes) else 0.0

    def may_reach(self, terms: np.ndarray, bar: int) -> np.ndarray:
        """Rows whose product with an item's terms, heaviest first, may be `bar` or more; never leaves one out."""
        everyone = np.arange(len(self.sizes))
        if bar <= 0:
            return everyone
        low = bar * (1 - SLACK)
        if self.length * math.sqrt(len(terms)) < low or not len(self.present):
            return everyone[:0]
        at = np.searchsorted(self.present, terms)
        at[at == len(self.present)] = 0
        at = at[self.present[at] == terms]
        if self.most[at].sum() < low:
            return everyone[:0]
        focus, rest = at[:FOCUS], at[FOCUS:]
        spans = [slice(self.ends[k], self.ends[k + 1]) for k in focus]
        rows = np.concatenate([self.rows[s] for s in spans])
        values = np.concatenate([self.values[s] for s in spans])
        reached = np.bincount(rows, values, len(self.sizes))
        others = np.maximum(self.squares - np.bincount(rows, values * values, len(self.sizes)), 0) + SLACK**2 * self.squares
        more = np.minimum(np.sqrt(len(rest) * others), self.most[rest].sum())
        return np.flatnonzero(reached + more >= low)

    def scores(self, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Exact products of rows with the terms marked in `wanted`."""
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        cells = np.arange(sizes.sum()) + np.repeat(self.starts[rows] - ends + sizes, sizes)
        own = np.where(wanted[self.terms[cells]], self.impacts[cells], 0)
        return np.diff(np.concatenate([[0], np.cumsum(own)])[np.concatenate([[0], ends])])


def _search_batches(items, bars: dict[int, int], size: int, top: int):
    """(item, doc, score): the best of this task's buckets for each item, none below the item's bar."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}
        reach = dict(bars)
        wanted = np.zeros(size, bool)
        for batch in batches:
            for docs, *packed in zip(*(batch.column(c).to_pylist() for c in ("docs", "sizes", "terms", "impacts"))):
                bucket = Bucket(*packed)
                for item, terms in items.value.items():
                    bar = reach.get(item, 0)
                    rows = bucket.may_reach(terms, bar)
                    if not len(rows):
                        continue
                    wanted[terms] = True
                    scores = bucket.scores(rows, wanted)
                    wanted[terms] = False
                    good = np.flatnonzero((scores > 0) & (scores >= bar))
                    if not len(good):
                        continue
                    own = best.get(item, []) + [(-int(scores[k]), _late(docs[rows[k]])) for k in good]
                    own.sort()
                    best[item] = own[:top]
                    if len(own) >= top:
                        reach[item] = max(bar, -own[top - 1][0])
        found = [(item, doc[1], -low) for item, own in best.items() for low, doc in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[k] for f in found], pa.int64()) for k in range(3)], names=["item", "doc", "score"])

    return run


def _late(doc: int | None) -> tuple:
    """Sorts a null name last."""
    return (doc is None, doc)


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _search_pass(docs: DataFrame, own: list, top: int, scratch: Scratch) -> DataFrame:
    """Best documents of the items in `own`, whose terms fit in memory."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    vocabulary: dict[bytes, int] = {}
    for row in own:
        for t in row.terms:
            vocabulary.setdefault(bytes(t), len(vocabulary))
    empty = spark.createDataFrame([], "item long, doc long, score long, rank int")
    if not vocabulary:
        return empty
    counted = scratch.write(docs.mapInArrow(
        _count_batches(share(vocabulary)), "doc long, n long, terms array<int>, counts array<bigint>"), "counted")
    total, all_terms, cells = counted.agg(F.count("*"), F.sum("n"), F.sum(F.size("terms"))).first()
    if not cells:
        return empty
    holding = np.zeros(len(vocabulary), np.int64)
    # One row per term of the items.
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holding[row.term] = row["count"]
    weights = np.array([term_weight(total, h) for h in holding.tolist()], np.int64)
    items = {}
    for row in own:
        terms = np.array([vocabulary[bytes(t)] for t in row.terms], np.int64)
        terms = terms[holding[terms] > 0]
        if len(terms):
            items[row.item] = terms[np.argsort(-weights[terms], kind="stable")]
    shared, weights = share(items), share(weights)

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-cells // (8 * BUCKET_CELLS)))
    holders = counted.filter(F.size("terms") > 0)
    measured = holders.mapInArrow(
        _length_batches(weights, total, all_terms), holders.schema.simpleString()[7:-1] + ",length:double")
    by = [F.col("length").desc(), F.col("row")]
    # The row's number parts vectors of equal length.
    measured = measured.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(parts, *by).sortWithinPartitions(*by)
    buckets = scratch.write(measured.drop("row", "length").mapInArrow(
        _bucket_batches(weights, total, all_terms),
        "longest double, docs array<bigint>, sizes binary, terms binary, impacts binary"), "buckets")

    longest = buckets.select("longest").orderBy(F.col("longest").desc()).limit(FIRST_BUCKETS).collect()
    cut = longest[-1].longest
    schema = "item long, doc long, score long"
    first = buckets.filter(F.col("longest") >= cut).mapInArrow(_search_batches(shared, {}, len(vocabulary), top), schema)
    first = scratch.write(_best(first, top), "first")
    bars = {r.item: r.score for r in first.filter(F.col("rank") == top).collect()}  # one per item of this pass
    rest = buckets.filter(F.col("longest") < cut)
    if len(bars) == len(items):
        # No shorter vector reaches any bar.
        rest = rest.filter(F.col("longest") >= min(bars[i] / math.sqrt(len(t)) for i, t in items.items()) * (1 - SLACK))
    rest = rest.mapInArrow(_search_batches(shared, bars, len(vocabulary), top), schema)
    return _best(first.drop("rank").unionByName(rest), top)


def search(
    docs: DataFrame, items: DataFrame, top: int = 10, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_key, rank, key, score): the `top` documents of highest positive score for each row of items.

    Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. Every row of
    docs is a document of its own, also one whose key is null (last among equals) or repeated; a null
    or blank text has no terms and is not counted. Every row of items is an item of its own, so a
    repeated one gets its ranks again; one without terms, or whose terms no document has, gets none.
    Fewer than `top` rows come back where fewer documents score. Empty tables give an empty result.
    Other columns are not read. Keys of documents are integers.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    scratch = Scratch(docs.sparkSession)
    asked = items.select(
        F.col(item_key).alias("name"), F.col(item_text).cast("binary").alias("text"), F.monotonically_increasing_id().alias("item"))
    kind = items.schema[item_key].dataType.simpleString()
    asked = scratch.write(asked.mapInArrow(_item_batches, f"item long, name {kind}, terms array<binary>"), "items")
    terms = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    passes = max(1, -(-terms // PASS_TERMS))
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("binary").alias("text"))
    found = []
    for k in range(passes):
        own = asked.filter(F.pmod(F.xxhash64("item"), F.lit(passes)) == k).select("item", "terms").collect()
        found.append(_search_pass(texts, own, top, scratch))
    ranked = reduce(DataFrame.unionByName, found)
    scratch.later()
    return ranked.join(asked.select("item", "name"), "item").select(
        F.col("name").alias(item_key), "rank", F.col("doc").alias(key), "score")
