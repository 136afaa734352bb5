"""Repeated byte strings by blockwise suffix sorting with a difference cover.

A byte is removed if a string of `depth` bytes that covers it also starts somewhere else. That asks
which suffixes agree on their first `depth` bytes, so suffixes are sorted only that far. The same goes
for words in the place of bytes, with suffixes that start at words, which finds shorter passages:

1. Cover sample. Positions whose residue modulo v is in a difference cover are ranked by their first
   depth - v + 1 bytes. Whatever the offsets of two equal strings, some shift below v puts both on
   the sample, so a string that repeats has a tied sample position within its first v bytes; about
   one position in eleven is sampled, and only tied ones lead on.
2. Suffix buckets. The suffixes that start within v bytes before a tied sample position are dealt
   into buckets and sorted one bucket at a time; neighbours that agree to the full depth repeat.

Ranks are fingerprints of the bytes compared: equal bytes get equal ranks, and only the order among
unequal ones is arbitrary, on which nothing here depends. Sample ranks only choose what is sorted.
Suffix keys have 64 bits and the bucket's number, by another fingerprint; n suffixes make a false tie
with probability n**2 / 2**65 / buckets. Ranks and keys travel packed by block of texts, each value
once per block, and come back as bits in the same order, so neither texts nor positions are shuffled
with them, and a string that fills a third of the corpus is one value per block.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meltemi.llm.common import Scratch, unused

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text in a block, and bytes of one text hashed at a time.
BLOCK, SEGMENT = 2 << 20, 1 << 20
#: Buckets per shuffle partition. A block sends a row to every bucket, so more buckets mean more and shorter rows.
BUCKETS = 1
PACKED = "bucket int, block long, ranks binary"
BLOCKS = "block long, keys array<string>, texts array<binary>, copies array<long>"
RESULT = "name string, n_removed long, n_spans long, kept_sha256 string, kept_text string"


def difference_cover(depth: int) -> tuple[np.ndarray, int]:
    """The Colbourn-Ling cover with the largest modulus of at most half of depth; every residue is a difference."""
    r, best = 0, (np.array([0]), 1)
    while 24 * r * r + 36 * r + 13 <= max(13, depth // 2):
        gaps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
        best = np.cumsum([0, *gaps]), 24 * r * r + 36 * r + 13
        r += 1
    return best if best[1] < depth else (np.array([0]), 1)


class Windows:
    """Fingerprints of all n-byte strings of a text: differences of running sums, shifted to a common power.

    A text may also be an array of 64-bit word fingerprints, whose strings are of n words.
    """

    def __init__(self, n: int, seed: int):
        rng = np.random.default_rng([seed, 77])
        self.n = n
        self.value = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(1, 1 << 61)) * 8 + 3
        size = SEGMENT + n
        self.power = np.cumprod(np.full(size, base, np.uint64))
        self.inverse = np.cumprod(np.full(size, pow(base, -1, 1 << 64), np.uint64))

    def at(self, text: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
        """Of the strings at `places`, in order, or at every place with n bytes left."""
        last = len(text) - self.n + 1
        if last <= 0:
            return np.zeros(0, np.uint64)
        out = []
        for lo in range(0, last, SEGMENT):
            part = text[lo:lo + SEGMENT + self.n - 1]
            total = np.zeros(len(part) + 1, np.uint64)
            own = self.value[part] if part.dtype == np.uint8 else part
            np.cumsum(own * self.power[:len(part)], out=total[1:])
            if places is None:
                own = slice(0, len(part) - self.n + 1)
                sums = total[self.n:] - total[:-self.n]
            else:
                a, b = np.searchsorted(places, (lo, lo + SEGMENT))
                own = places[a:b] - lo
                sums = total[own + self.n] - total[own]
            out.append(_mix(sums * self.inverse[own]))
        return np.concatenate(out)


class Words:
    """Words of a text, which are runs without ASCII white space: their fingerprints, and where each begins and ends."""

    def __init__(self, seed: int = 4):
        self.bytes = Windows(1, seed)

    def of(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        space = (text == 32) | ((text >= 9) & (text <= 13))
        edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
        starts, stops = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        out, lo = [np.zeros(0, np.uint64)], 0
        while lo < len(starts):
            # Words whose bytes fit the table of powers together; a longer one is hashed by parts of itself.
            hi = max(lo + 1, int(np.searchsorted(stops, starts[lo] + SEGMENT, "right")))
            a, b = int(starts[lo]), int(stops[hi - 1])
            if b - a > SEGMENT:
                import xxhash

                out.append(np.array([xxhash.xxh3_64_intdigest(text[a:b].tobytes())], np.uint64) | np.uint64(1))
            else:
                part = text[a:b]
                total = np.zeros(len(part) + 1, np.uint64)
                np.cumsum(self.bytes.value[part] * self.bytes.power[:len(part)], out=total[1:])
                s, e = starts[lo:hi] - a, stops[lo:hi] - a
                out.append(_mix((total[e] - total[s]) * self.bytes.inverse[s]) | np.uint64(1))
            lo = hi
        return np.concatenate(out), starts, stops


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Ranks:
    """Values of a block, each once, ordered by bucket; which are tied is told back as bits in that order."""

    def __init__(self, values: np.ndarray, bucket: np.ndarray):
        """bucket: of each value; equal values share one."""
        self.unique, first, self.place, count = np.unique(values, return_index=True, return_inverse=True, return_counts=True)
        self.here = count > 1
        own = bucket[first]
        self.order = np.argsort(own, kind="stable")
        self.bucket = own[self.order]

    def packed(self) -> Iterator[tuple[int, np.ndarray]]:
        edge = np.flatnonzero(np.diff(self.bucket, prepend=-1))
        for lo, hi in zip(edge, [*edge[1:], len(self.bucket)]):
            yield int(self.bucket[lo]), self.unique[self.order[lo:hi]]

    def tied(self, bits: dict[int, bytes]) -> np.ndarray:
        """Of each value given: whether it is in the block twice or in another block."""
        out = self.here.copy()
        edge = np.flatnonzero(np.diff(self.bucket, prepend=-1))
        for lo, hi in zip(edge, [*edge[1:], len(self.bucket)]):
            raw = bits.get(int(self.bucket[lo]))
            if raw is not None:
                out[self.order[lo:hi]] |= np.unpackbits(np.frombuffer(raw, np.uint8), count=hi - lo).astype(bool)
        return out[self.place]


class Sorter:
    """What both passes over the blocks need: cover, fingerprints, buckets."""

    def __init__(self, depth: int, buckets: int, words: bool = False):
        self.depth, self.buckets = depth, np.uint64(buckets)
        self.words = Words() if words else None
        self.cover, self.modulus = difference_cover(depth)
        self.head = Windows(depth - self.modulus + 1, 1)
        self.full, self.other = Windows(depth, 2), Windows(depth, 3)

    def symbols(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """What suffixes are made of: bytes or words."""
        if not self.words or not texts:
            return texts
        # All at once, with a space between.
        gap = np.full(1, 32, np.uint8)
        values, starts, _ = self.words.of(np.concatenate([part for t in texts for part in (t, gap)]))
        return np.split(values, np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts])[:-1]))

    def span(self, text: np.ndarray, gone: np.ndarray) -> np.ndarray:
        """Bytes that go with the symbols that go; with a word goes the white space behind it."""
        if not self.words:
            return gone
        _, starts, stops = self.words.of(text)
        ends = np.append(starts[1:], len(text)) if len(starts) else starts
        return union(starts[gone], ends[gone], len(text))

    def sample(self, texts: list[np.ndarray]) -> tuple[list[np.ndarray], Ranks]:
        places, values = [], [np.zeros(0, np.uint64)]
        for text in texts:
            at = (np.arange(0, len(text), self.modulus)[:, None] + self.cover).ravel()
            at = np.sort(at[at <= len(text) - self.head.n])
            places.append(at)
            values.append(self.head.at(text, at))
        h = np.concatenate(values)
        bucket = (h >> np.uint64(32)) % self.buckets
        # 32 bits within a bucket: a false tie of the sample only costs work.
        return places, Ranks(bucket << np.uint64(32) | h & np.uint64(0xFFFFFFFF), bucket.astype(np.int64))

    def suffixes(self, texts: list[np.ndarray], bits: dict[int, bytes]) -> tuple[list[np.ndarray], Ranks]:
        """Per text, the places of suffixes near a tied sample position, and their keys."""
        places, ranks = self.sample(texts)
        tied, done = ranks.tied(bits), 0
        out, keys, buckets = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for text, at in zip(texts, places):
            own = at[tied[done:done + len(at)]]
            done += len(at)
            near = np.zeros(0, np.int64)
            if len(own):
                near = np.flatnonzero(union(np.maximum(0, own - self.modulus + 1), own + 1, max(0, len(text) - self.depth + 1)))
                keys.append(self.full.at(text, near))
                buckets.append(self.other.at(text, near))
            out.append(near)
        return out, Ranks(np.concatenate(keys), (np.concatenate(buckets) % self.buckets).astype(np.int64))


def union(starts: np.ndarray, stops: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in some half-open span."""
    edge = np.bincount(np.minimum(starts, n), minlength=n + 1) - np.bincount(np.minimum(stops, n), minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


# ---- tasks --------------------------------------------------------------------------------------

def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, text, copies) to rows of about BLOCK bytes of text; a longer text is a block of its own."""
    from pyspark import TaskContext

    base, done = TaskContext.get().partitionId() << 32, 0
    rows: tuple[list, list, list] = ([], [], [])
    size = 0

    def block() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([base + done]), pa.array([rows[0]], pa.list_(pa.string())), pa.array([rows[1]], pa.list_(pa.binary())),
             pa.array([rows[2]], pa.list_(pa.int64()))], names=["block", "keys", "texts", "copies"])

    for batch in batches:
        for key, text, copies in zip(*(batch.column(c) for c in ("key", "text", "copies"))):
            text = text.as_py()
            if size and size + len(text) > BLOCK:
                yield block()
                done, size, rows = done + 1, 0, ([], [], [])
            for column, value in zip(rows, (key.as_py(), text, copies.as_py())):
                column.append(value)
            size += len(text)
    if size:
        yield block()


def _arrays(texts: pa.Scalar) -> list[np.ndarray]:
    return [np.frombuffer(t.as_buffer(), np.uint8) for t in texts]


def _bits(told: pa.Scalar) -> dict[int, bytes]:
    return {x["bucket"]: x["bits"] for x in told.as_py()} if told.is_valid else {}


def _pack_batches(depth: int, buckets: int, words: bool, second: bool):
    """Ranks of the cover sample of each block or, once its ties are known, keys of the suffixes near them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorter = Sorter(depth, buckets, words)
        for batch in batches:
            for i in range(batch.num_rows):
                texts = sorter.symbols(_arrays(batch.column("texts")[i]))
                ranks = (sorter.suffixes(texts, _bits(batch.column("told")[i])) if second else sorter.sample(texts))[1]
                rows = [(b, (own if second else own.astype(np.uint32)).tobytes()) for b, own in ranks.packed()]
                if rows:
                    block = [batch.column("block")[i].as_py()] * len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in rows], pa.int32()), pa.array(block, pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                        names=["bucket", "block", "ranks"])

    return run


def _sort_bucket(kind: str):
    """Sort one bucket; a bit per value of each block that another block has too."""
    def run(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(r.as_buffer(), kind) for r in table.column("ranks")]
        every = np.sort(np.concatenate(parts))
        twice = every[1:][every[1:] == every[:-1]]
        twice = twice[np.diff(twice, prepend=twice[:1] ^ twice.dtype.type(1)) != 0]
        rows = []
        for part, block in zip(parts, table.column("block").to_pylist()):
            at = np.searchsorted(twice, part)
            hit = np.zeros(len(part), bool)
            if len(twice):
                hit = twice[np.minimum(at, len(twice) - 1)] == part
            if hit.any():
                rows.append((block, np.packbits(hit).tobytes()))
        bucket = [table.column("bucket")[0].as_py()] * len(rows)
        return pa.table({
            "block": pa.array([r[0] for r in rows], pa.int64()), "bucket": pa.array(bucket, pa.int32()),
            "bits": pa.array([r[1] for r in rows], pa.binary())})

    return run


def _cut_batches(depth: int, buckets: int, words: bool, kept: bool):
    """Rows of RESULT for the texts that lose something."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorter = Sorter(depth, buckets, words)
        for batch in batches:
            for i in range(batch.num_rows):
                texts = _arrays(batch.column("texts")[i])
                symbols = sorter.symbols(texts)
                places, ranks = sorter.suffixes(symbols, _bits(batch.column("told")[i]))
                tied, done, rows = ranks.tied(_bits(batch.column("repeats")[i])), 0, []
                for key, text, own, copies, at in zip(batch.column("keys")[i].as_py(), texts, symbols, batch.column("copies")[i].as_py(), places):
                    repeated = at[tied[done:done + len(at)]]
                    done += len(at)
                    if copies > 1 and len(own) >= depth:
                        gone = np.ones(len(own), bool)
                    elif len(repeated):
                        gone = union(repeated, repeated + depth, len(own))
                    else:
                        continue
                    rows.append((key, *_cut(text, sorter.span(text, gone), kept)))
                if rows:
                    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                        names=["name", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    return run


def _cut(text: np.ndarray, gone: np.ndarray, kept: bool) -> tuple[int, int, str, str | None]:
    import hashlib

    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    rest = text[~gone].tobytes()
    body = None
    if kept:
        # A character that lost a byte is left out whole.
        character = np.cumsum((text & 0xC0) != 0x80)
        whole = np.bincount(character[gone], minlength=character[-1] + 1) == 0
        body = text[whole[character]].tobytes().decode("utf-8", "replace")
    return int(gone.sum()), spans, hashlib.sha256(rest).hexdigest(), body


# ---- the operator -------------------------------------------------------------------------------

class _Blocks:
    """The blocks as a table bucketed by block, so that what is told about them joins without shuffling texts."""

    def __init__(self, spark: SparkSession, rows: DataFrame, scratch: Scratch):
        import uuid

        from meltemi.session import scratch_path

        self.spark, self.name, self.path = spark, f"suffix_blocks_{uuid.uuid4().hex}", scratch_path(spark, "blocks")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        scratch.keep(self.path)
        writer = rows.write.bucketBy(parts, "block").option("path", self.path).option("compression", "zstd")
        writer.saveAsTable(self.name)

    def told(self, **bits: DataFrame) -> DataFrame:
        out = self.spark.table(self.name)
        for name, rows in bits.items():
            lists = rows.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))
            out = out.join(lists.hint("shuffle_hash"), "block", "left")
        return out

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _repeats(blocks: _Blocks, scratch: Scratch, depth: int, buckets: int, words: bool, texts: bool) -> DataFrame:
    """Rows of RESULT for the texts that have a repeat, written."""
    tie = "block long, bucket int, bits binary"
    sample = blocks.told().select("block", "texts").mapInArrow(_pack_batches(depth, buckets, words, False), PACKED)
    told = scratch.write(sample.groupBy("bucket").applyInArrow(_sort_bucket("<u4"), tie), "sample-ties")
    near = blocks.told(told=told).select("block", "texts", "told").mapInArrow(_pack_batches(depth, buckets, words, True), PACKED)
    repeats = scratch.write(near.groupBy("bucket").applyInArrow(_sort_bucket("<u8"), tie), "suffix-ties")
    return scratch.write(blocks.told(told=told, repeats=repeats).mapInArrow(_cut_batches(depth, buckets, words, texts), RESULT), "cut")


def remove_repeats(
    docs: DataFrame, depth: int = 400, text: str = "text", texts: bool = True, unit: str = "bytes", passage: int | None = None,
) -> DataFrame:
    """Every row with n_bytes, n_removed, n_spans, kept_sha256 and kept_text (null unless `texts`).

    Texts are taken as UTF-8 bytes, a null one as empty; no string reaches from one row into another.
    Each byte covered by a string of `depth` bytes that also starts at another place, in the same or
    another row, is removed, as judged on the input. n_spans counts the maximal removed runs.
    kept_sha256 is of the remaining bytes; kept_text leaves out characters that lost some of theirs.
    Equal texts, repeated rows too, of `depth` bytes or more go entirely. Other columns are kept, save
    those named as an output. An empty table gives an empty result.

    With unit="words", strings are of `depth` words (runs without ASCII white space), whatever stands
    between them; each word covered by one that also starts at another place is removed, with the white
    space behind it. Counts stay in bytes.

    With `passage`, n_passage_bytes tells how much unit="words" would remove at a depth of so many words, and
    has_passage whether it is anything; the other columns are as without it.

    A task holds one block of texts, or one longer text, and one bucket.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    if unit not in ("bytes", "words"):
        raise ValueError("unit is bytes or words")
    words = unit == "words"
    # So many words have so many bytes at least.
    least = min([2 * depth - 1 if words else depth, *([2 * passage - 1] if passage else [])])
    long = docs.select(F.sha2(body, 256).alias("key"), body.alias("text")).filter(F.octet_length("text") >= least).groupBy("key").agg(
        F.first("text").alias("text"), F.count("*").alias("copies"))
    blocks = _Blocks(spark, long.mapInArrow(_block_batches, BLOCKS), scratch)
    cut = _repeats(blocks, scratch, depth, buckets, words, texts)
    passages = _repeats(blocks, scratch, passage, buckets, True, False) if passage else None
    blocks.drop()
    outputs = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    more = ["n_passage_bytes", "has_passage"] if passage else []
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in (*outputs, *more)]
    name, whole = unused(docs, "_name", "_whole")
    rows = docs.select(*kept, F.sha2(body, 256).alias(name), F.octet_length(body).cast("long").alias("n_bytes"),
                       *([F.coalesce(F.col(text), F.lit("")).alias(whole)] if texts else []))
    found = cut.select(F.col("name").alias(name), *outputs[1:])
    untouched = F.when(F.col("n_removed").isNull(), F.col(whole)).otherwise(F.col("kept_text")) if texts else F.lit(None).cast("string")
    out = rows.join(found, name, "left").withColumns({
        "kept_text": untouched, "n_removed": F.coalesce("n_removed", F.lit(0)), "n_spans": F.coalesce("n_spans", F.lit(0)),
        "kept_sha256": F.coalesce("kept_sha256", name)})
    if passage:
        out = out.join(passages.select(F.col("name").alias(name), F.col("n_removed").alias("n_passage_bytes")), name, "left")
        out = out.withColumn("n_passage_bytes", F.coalesce("n_passage_bytes", F.lit(0))).withColumn("has_passage", F.col("n_passage_bytes") > 0)
    scratch.later()
    return out.drop(name, whole)
