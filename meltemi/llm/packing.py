"""Best-fit packing of tokenized documents, improved by swap-based local search.

Pieces are dealt into shards of bounded size by a hash of their row; a shard is packed best-fit
decreasing, then the emptiest sequence gives its pieces away, by moves, one-for-one and two-for-one
exchanges that each raise the sum of squared fills, until it is empty. The search ends at the least
possible number or when no underfull sequence can give any more. The emptiest sequence of every shard
is then taken apart, and those pieces are packed once more together. Only piece lengths and keys are
shuffled, never tokens.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meltemi.llm.common import Scratch, ddl_of, unused, worker_state

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pieces packed together in one task.
SHARD = 16384
#: Odd words and pretokens a worker remembers before it starts anew, and text bytes taken at a time.
WORDS, PRETOKENS, SEGMENT = 200_000, 400_000, 1 << 20

PIECE = "piece int, start long, length long, ids_crc32 long"


# ---- tokens -------------------------------------------------------------------------------------

class WordIds:
    """Token ids of white-space separated words, as little-endian unsigned 32-bit bytes.

    The vocabulary's own normalizer and splitter never reach across ASCII white space, and its
    merges never leave a pretoken; so a text's ids are its words' ids, and a word's its pretokens'.
    Texts of ASCII and Latin-1 letters are split into pretokens here. Of any other text the words are
    taken one by one, and those with other characters split by the tokenizer's own rules.
    """

    def __init__(self, path: str):
        import re

        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.whole.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        letters = "A-Za-zÀ-ÖØ-öø-ÿ"
        self.odd = re.compile(rf"[^!-;=?-~{letters}\t-\r ]").search
        self.pretokens = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[0-9]|[^{letters}0-9\t-\r ]+").findall
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _encode_parts(self, parts: list[str]) -> dict[str, bytes]:
        if not parts:
            return {}
        lines = [" ".join(parts[i:i + 500]) for i in range(0, len(parts), 500)]
        ids = np.concatenate([np.array(e.ids, "<u4") for e in self.plain.encode_batch_fast(lines, add_special_tokens=False)])
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(parts):
            raise ValueError("the vocabulary does not end each pretoken with an end-of-word token")
        raw, cuts = ids.tobytes(), (4 * stops).tolist()
        return {p: raw[a:b] for p, a, b in zip(parts, [0, *cuts], cuts)}

    def _known(self, parts: set[str]) -> dict[str, bytes]:
        """A table that has the ids of these pretokens."""
        if len(self.parts) > PRETOKENS:
            self.parts = {}
        self.parts.update(self._encode_parts(list(parts - self.parts.keys())))
        return self.parts

    def _learn(self, unknown: set[bytes]) -> None:
        """Put words into the table of words."""
        split, odd = {}, []
        for w in unknown:
            s = w.decode("utf-8", "replace")
            if self.odd(s):
                odd.append((w, s))
            else:
                split[w] = self.pretokens(s.lower())
        have = self._known({p for parts in split.values() for p in parts})
        self.words.update({w: b"".join([have[p] for p in parts]) for w, parts in split.items()})
        if odd:
            codes = self.whole.encode_batch_fast([s for _, s in odd], add_special_tokens=False)
            self.words.update({w: np.array(e.ids, "<u4").tobytes() for (w, _), e in zip(odd, codes)})

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text; about SEGMENT bytes of text are split into words at a time."""
        group, size = [], 0
        for t in texts:
            if group and size + len(t) > SEGMENT:
                yield from self._group(group)
                group, size = [], 0
            group.append(t)
            size += len(t)
        yield from self._group(group)

    def _group(self, texts: list[bytes]) -> Iterator[bytes]:
        if len(texts) == 1 and len(texts[0]) > SEGMENT:
            yield b"".join(x for s in segments(texts[0], SEGMENT) for x in self._group([s]))
            return
        split: list[tuple[bool, list]] = []
        for t in texts:
            s = t.decode("utf-8", "replace")
            odd = self.odd(s) is not None
            split.append((odd, t.split() if odd else self.pretokens(s.lower())))
        parts = self._known(set().union(*(x for odd, x in split if not odd)))
        if len(self.words) > WORDS:
            self.words = {}
        unknown = set().union(*(x for odd, x in split if odd)) - self.words.keys()
        ready = [b"".join(map(parts.__getitem__, x)) if not odd else None for odd, x in split]
        if unknown:
            self._learn(unknown)
        for (_, x), raw in zip(split, ready):
            yield b"".join(map(self.words.__getitem__, x)) if raw is None else raw


def segments(text: bytes, size: int) -> Iterator[bytes]:
    """Parts of about `size` bytes, cut after a space, tab or line feed only."""
    lo = 0
    while lo < len(text):
        hi = min(lo + size, len(text))
        if hi < len(text):
            cuts = [c for c in (text.find(b, hi) for b in (b" ", b"\n", b"\t")) if c >= 0]
            hi = min(cuts) + 1 if cuts else len(text)
        yield text[lo:hi]
        lo = hi


def _piece_batches(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        import zlib

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        state = worker_state()
        coder = state.get(path) or state.setdefault(path, WordIds(path))
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            texts = (t.as_py() or b"" for t in batch.column("_text"))
            row, piece, start, length, crc = [], [], [], [], []
            for i, raw in enumerate(coder.encode(texts)):
                raw += end
                for k, lo in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[lo:lo + 4 * capacity]
                    for column, value in zip((row, piece, start, length, crc), (i, k, lo // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
            kept = [c for c in batch.schema.names if c != "_text"]
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(take) for c in kept), pa.array(piece, pa.int32()),
                 *(pa.array(c, pa.int64()) for c in (start, length, crc))],
                names=[*kept, "piece", "start", "length", "ids_crc32"])

    return run


def token_pieces(
    docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(key, piece, start, length, ids_crc32): each text's ids and the end id, cut after `capacity` ids.

    A null text is empty and gives one piece of the end id alone. Other columns are not read.
    """
    rows = docs.select(F.col(key), F.col(text).cast("binary").alias("_text"))
    return rows.mapInArrow(_piece_batches(path, end_id, capacity), f"`{key}` {rows.schema[key].dataType.simpleString()}, {PIECE}")


# ---- packing ------------------------------------------------------------------------------------

def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Bin of each item by best fit decreasing, and the number of bins."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has r left
    bins, used = np.empty(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fit = rooms >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, b, used = capacity, used, used + 1
        bins[i] = b
        left = room - n
        if left:
            open_bins[left].append(b)
            rooms |= 1 << left
    return bins, used


def local_search(lengths: np.ndarray, bins: np.ndarray, used: int, capacity: int) -> np.ndarray:
    """Empty bins by moves and exchanges that raise the sum of squared fills; the new bin of each item.

    The emptiest bin gives: the largest amount that an exchange of one or two of its items for one
    item of a fuller bin, or for none, can carry over without overflow, is carried over, again and
    again. Each step raises the sum of squares, a bounded whole number, so the search ends.
    """
    fill = np.bincount(bins, lengths, minlength=used).astype(np.int64)
    stuck = np.zeros(used, dtype=bool)
    least = -(-int(fill.sum()) // capacity)
    alive = int((fill > 0).sum())
    while alive > least:
        free = np.flatnonzero((fill > 0) & (fill < capacity) & ~stuck)
        if len(free) < 2:
            break
        source = free[fill[free].argmin()]
        # Items of underfull bins, and one empty place in each.
        gap = capacity - fill
        items = np.flatnonzero((gap[bins] > 0) & (bins != source))
        holes = np.flatnonzero((gap > 0) & (fill > 0))
        holes = holes[holes != source]
        take = np.concatenate([lengths[items], np.zeros(len(holes), np.int64)])
        home = np.concatenate([bins[items], holes])
        while True:
            own = np.flatnonzero(bins == source)
            if not len(own):
                break
            one = lengths[own]
            i, j = np.triu_indices(len(own), 1)
            sums = np.concatenate([one, one[i] + one[j]])
            order = np.argsort(sums, kind="stable")
            ranked = sums[order]
            best = np.searchsorted(ranked, take + gap[home], side="right") - 1
            carried = np.where(best >= 0, ranked[best] - take, 0)
            # Squares rise only if the taker ends fuller than the giver was.
            carried[carried <= fill[source] - fill[home]] = 0
            k = int(carried.argmax())
            if carried[k] <= 0:
                break
            pick, target = int(order[best[k]]), int(home[k])
            given = own[[pick]] if pick < len(own) else own[[i[pick - len(own)], j[pick - len(own)]]]
            if k < len(items):
                bins[items[k]] = source
            bins[given] = target
            fill[source] -= carried[k]
            fill[target] += carried[k]
            gap[source], gap[target] = capacity - fill[source], capacity - fill[target]
            if fill[source] == 0:
                break
            items = np.flatnonzero((gap[bins] > 0) & (bins != source))
            holes = holes[gap[holes] > 0]
            take = np.concatenate([lengths[items], np.zeros(len(holes), np.int64)])
            home = np.concatenate([bins[items], holes])
        if fill[source] == 0:
            alive -= 1
            stuck[:] = False
        else:
            stuck[source] = True
    return bins


def pack_lengths(lengths: np.ndarray, capacity: int) -> np.ndarray:
    bins, used = best_fit(lengths, capacity)
    part = lengths < capacity
    inner, renamed = np.unique(bins[part], return_inverse=True)
    if len(inner):
        bins[part] = inner[local_search(lengths[part], renamed, len(inner), capacity)]
    return bins


def _pack_shard(capacity: int, row: str, shard: str, last: str):
    """Packs a shard; `last` marks the pieces of its emptiest sequence."""
    def run(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy().astype(np.int64)
        # One order whatever order the shuffle brought the rows in.
        order = np.lexsort((table.column(row).to_numpy(), -lengths))
        lengths = lengths[order]
        bins = pack_lengths(lengths, capacity)
        line = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[line])
        first = np.concatenate([[True], np.diff(bins[line]) != 0])
        base = np.maximum.accumulate(np.where(first, ends - lengths[line], 0))
        fill = np.bincount(bins, lengths)
        emptiest = np.where(fill > 0, fill, capacity + 1).argmin()
        number = table.column(shard)[0].as_py()
        placed = table.drop_columns([shard]).take(pa.array(order[line]))
        for name, value in ((last, bins[line] == emptiest), ("sequence_id", (number << 32) + bins[line]), ("offset", ends - lengths[line] - base)):
            placed = placed.append_column(name, pa.array(value))
        return placed

    return run


def pack(pieces: DataFrame, capacity: int = 2048, shard: int = SHARD) -> DataFrame:
    """Every row with sequence_id and offset: rows of one sequence lie gapless from offset 0, at most `capacity` long.

    Needs a `length` of 1 to `capacity`; all other columns are kept, whatever they hold, save those
    named as an output. Repeated rows are packed each on its own. An empty table gives an empty result.
    """
    scratch = Scratch(pieces.sparkSession)
    pieces = pieces.drop("sequence_id", "offset")
    row, dealt, last = unused(pieces, "_row", "_shard", "_last")
    rows = scratch.write(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    kinds = f"{ddl_of(rows)}, `{last}` boolean, sequence_id long, offset long"

    def packed(of: DataFrame, shards: int, before: int) -> DataFrame:
        numbered = of.withColumn(dealt, F.pmod(F.xxhash64(row), F.lit(shards)) + before)
        return numbered.groupBy(dealt).applyInArrow(_pack_shard(capacity, row, dealt, last), kinds)

    shards = max(1, -(-rows.count() // shard))
    out = packed(rows, shards, 0)
    if shards > 1:
        out = scratch.write(out, "packed")
        again = out.filter(last).drop(last, "sequence_id", "offset")
        out = out.filter(~F.col(last)).unionByName(packed(again, -(-again.count() // shard), shards))
    scratch.later()
    return out.drop(row, last)


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """token_pieces, packed."""
    return pack(token_pieces(docs, path, capacity, end_id, key, text), capacity)
