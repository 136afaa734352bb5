"""SentencePiece encoding and decoding with a suffix array of the text.

A text is cut before each run of spaces, across which no piece reaches. The distinct parts not met
before are laid end to end and their suffixes sorted; every piece of the vocabulary is looked up by
binary search, and the range of suffixes it begins gives all places where it stands. Those
occurrences are the edges of a graph over places, sorted by position. Relaxation then takes, best
score first and leftmost among equals, the edge that spans exactly two neighbouring symbols, until
none is left, which is the merge order of a BPE model.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meltemi.llm.common import Recent, unused, worker_state

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACE = "▁"
#: Bytes of new parts indexed together, characters of text cut into parts at a time, and parts remembered.
INDEX, SEGMENT, PARTS = 1 << 19, 1 << 20, 250_000
#: Leading bytes by which suffixes are sorted; longer pieces are compared to their end in the range found.
DEPTH = 16
#: Symbols from which a part is relaxed alone, and bits for a place in the line.
LONG, SHIFT = 48, 31


def _word(line: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number, first byte highest; the line has room behind."""
    out = np.zeros(len(at), np.uint64)
    for j in range(8):
        out = out << np.uint64(8) | line[at + j]
    return out


class Pieces:
    """A BPE vocabulary with byte fallback, read by the library; piece texts as UTF-8, ordered by bytes."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        reserved = [i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)]
        special = set(reserved)
        usual = [i for i in range(size) if i not in special]
        self.text = {i: model.id_to_piece(i).encode() for i in usual}
        self.ids = np.array(usual, np.int64)
        self.score = {i: model.get_score(i) for i in usual}
        self.byte_id = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.of_byte = {i: bytes([b]) for b, i in enumerate(self.byte_id) if model.is_byte(i)}
        if len(self.of_byte) != 256:
            raise ValueError("the model needs all byte pieces")
        self.unknown = model.unk_id()
        self.size = np.array([len(self.text[i]) for i in usual], np.int64)
        self.symbols = np.array([len(self.text[i].decode()) for i in usual], np.int64)
        # Rank of the score: smaller is better; equal scores share a rank.
        scores = np.array([self.score[i] for i in usual])
        self.rank = np.unique(-scores, return_inverse=True)[1]
        self.low, self.high = self._bounds(usual, b"\0"), self._bounds(usual, b"\xff")

    def _bounds(self, usual: list[int], fill: bytes) -> tuple[np.ndarray, np.ndarray]:
        line = np.frombuffer(b"".join(self.text[i][:DEPTH].ljust(DEPTH, fill) for i in usual), np.uint8)
        at = np.arange(len(usual)) * DEPTH
        return _word(np.concatenate([line, np.zeros(8, np.uint8)]), at), _word(np.concatenate([line, np.zeros(8, np.uint8)]), at + 8)

    # ---- matching -------------------------------------------------------------------------------

    def edges(self, line: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(place, index of piece) of every occurrence of every piece, by place; 0xFF in the line parts texts."""
        n = len(line)
        data = np.frombuffer(line + bytes(DEPTH), np.uint8)
        every = np.arange(n)
        first, second = _word(data, every), _word(data, every + 8)
        order = np.lexsort((second, first))
        first, second = first[order], second[order]
        lo = np.searchsorted(first, self.low[0], side="left")
        hi = np.searchsorted(first, self.high[0], side="right")
        found = []
        for k in np.flatnonzero((hi > lo) & (self.size > 8)).tolist():
            a, b = int(lo[k]), int(hi[k])
            lo[k] = a + np.searchsorted(second[a:b], self.low[1][k], side="left")
            hi[k] = a + np.searchsorted(second[a:b], self.high[1][k], side="right")
            if self.size[k] > DEPTH and hi[k] > lo[k]:
                text = self.text[int(self.ids[k])]
                at = [p for p in order[lo[k]:hi[k]].tolist() if line.startswith(text, p)]
                found.append((np.array(at, np.int64), np.full(len(at), k)))
                hi[k] = lo[k]
        count = np.maximum(hi - lo, 0)
        which = np.repeat(np.arange(len(lo)), count)
        start = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        place = order[start + np.arange(len(which))]
        if found:
            place = np.concatenate([place, *(f[0] for f in found)])
            which = np.concatenate([which, *(f[1] for f in found)])
        by = np.argsort(place, kind="stable")
        return place[by], which[by]

    def encode_parts(self, parts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each part; parts have no byte 0xFF, being UTF-8, and are not empty."""
        line = b"\xff".join(parts)
        data = np.frombuffer(line, np.uint8)
        place, which = self.edges(line)
        single = np.full(len(line), -1, np.int64)
        alone = self.symbols[which] == 1
        single[place[alone]] = self.ids[which[alone]]
        place, which = place[~alone], which[~alone]
        # An edge joins symbols from one place to another; of equal spans there is one piece.
        span = place << SHIFT | (place + self.size[which])
        by = np.argsort(span)
        joins = span[by], self.rank[which[by]], self.ids[which[by]]
        start = np.flatnonzero(((data & 0xC0) != 0x80) & (data != 0xFF))
        heads = np.cumsum([0, *(len(p) + 1 for p in parts)])
        part = np.searchsorted(heads, start, side="right") - 1
        stop = np.append(start[1:], len(line))
        last = np.append(part[1:] != part[:-1], True)
        stop[last] = heads[part[last] + 1] - 1
        done = list(self._relax_short(start, stop, part, single[start], joins))
        start, stop, part, token = (np.concatenate(x) for x in zip(*done))
        by = np.argsort(start)
        start, stop, part, token = start[by], stop[by], part[by], token[by]
        # A character without a piece becomes its bytes.
        raw = token < 0
        n = np.where(raw, stop - start, 1)
        at = np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        ids = np.where(np.repeat(raw, n), np.array(self.byte_id)[data[np.minimum(at, len(data) - 1)]], np.repeat(token, n))
        cuts = (4 * np.searchsorted(np.repeat(part, n), np.arange(len(parts) + 1))).tolist()
        flat = ids.astype("<u4").tobytes()
        return [flat[x:y] for x, y in zip(cuts, cuts[1:])]

    def _relax_short(self, start, stop, part, token, joins) -> Iterator[tuple]:
        """Relax all parts side by side, each its best edge a round; long parts, which take many rounds, one by one.

        Yields (start, stop, part, token) of symbols that no edge joins any more.
        """
        spans, ranks, tokens = joins
        none = np.int64(1 << 40)

        def join(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if not len(spans):
                return np.full(len(lo), none), np.full(len(lo), -1)
            key = lo << SHIFT | hi
            at = np.minimum(np.searchsorted(spans, key), len(spans) - 1)
            hit = spans[at] == key
            return np.where(hit, ranks[at], none), np.where(hit, tokens[at], -1)

        size = np.bincount(part)
        long = size[part] > LONG
        if long.any():
            rank_of = dict(zip(spans.tolist(), zip(ranks.tolist(), tokens.tolist())))
            for p in np.unique(part[long]).tolist():
                own = part == p
                yield self._relax(start[own], stop[own], p, token[own], rank_of)
            start, stop, part, token = (x[~long] for x in (start, stop, part, token))
        best, joined = np.full(len(start), none), np.full(len(start), -1)
        if len(start) > 1:
            best[:-1], joined[:-1] = join(start[:-1], stop[1:])
        while len(start):
            first = np.flatnonzero(np.diff(part, prepend=-1))
            count = np.diff(np.append(first, len(part)))
            least = np.repeat(np.minimum.reduceat(best, first), count)
            open_ = least < none
            if not open_.all():
                yield start[~open_], stop[~open_], part[~open_], token[~open_]
                start, stop, part, token, best, joined, least = (x[open_] for x in (start, stop, part, token, best, joined, least))
                if not len(start):
                    return
            hit = np.flatnonzero(best == least)
            hit = hit[np.diff(part[hit], prepend=-1) != 0]
            token[hit], stop[hit] = joined[hit], stop[hit + 1]
            keep = np.ones(len(start), bool)
            keep[hit + 1] = False
            moved = hit - np.arange(len(hit))
            start, stop, part, token, best, joined = (x[keep] for x in (start, stop, part, token, best, joined))
            # Only the pairs on both sides of a new symbol changed.
            renew = np.concatenate([moved, moved[moved > 0] - 1])
            within = renew[renew + 1 < len(start)]
            best[renew] = none
            best[within], joined[within] = join(start[within], stop[within + 1])

    def _relax(self, starts, stops, part: int, token, edges: dict[int, tuple[int, int]]) -> tuple:
        """Take the best edge of one part from a heap until none is left."""
        import heapq

        after = dict(zip(starts.tolist(), stops.tolist()))
        before = dict(zip(stops.tolist(), starts.tolist()))
        whole = dict(zip(starts.tolist(), token.tolist()))
        ready: list[tuple[int, int, int]] = []

        def offer(s: int, e: int) -> None:
            edge = edges.get(s << SHIFT | e)
            if edge:
                heapq.heappush(ready, (edge[0], s, e))

        for s, e in zip(starts[:-1].tolist(), stops[1:].tolist()):
            offer(s, e)
        while ready:
            _, s, e = heapq.heappop(ready)
            middle = after.get(s)
            # Stale unless both symbols still stand as they did.
            if middle is None or after.get(middle) != e:
                continue
            after[s], before[e], whole[s] = e, s, edges[s << SHIFT | e][1]
            del after[middle], before[middle], whole[middle]
            if s in before:
                offer(before[s], e)
            if e in after:
                offer(s, after[e])
        left = np.array(sorted(after), np.int64)
        return (left, np.array([after[x] for x in left.tolist()], np.int64), np.full(len(left), part),
                np.array([whole[x] for x in left.tolist()], np.int64))

    def decode(self, ids: list[int]) -> str:
        """Pieces and bytes joined, the space in front of the text taken off; control pieces are silent."""
        raw = b"".join(self.of_byte.get(i) or self.text.get(i) or (b" \xe2\x81\x87 " if i == self.unknown else b"") for i in ids)
        text = raw.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if ids and self.text.get(ids[0], b"").startswith(SPACE.encode()) else text


class Coder:
    """Encodes texts, remembering the parts met lately."""

    def __init__(self, path: str):
        import re

        self.pieces, self.recent = Pieces(path), Recent(PARTS)
        self.cut = re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+").findall

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        group, size = [], 0
        for t in texts:
            if group and size + len(t) > SEGMENT:
                yield from self._group(group)
                group, size = [], 0
            group.append(t)
            size += len(t)
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        split = [self.cut(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        known, new = self.recent.take({p for parts in split for p in parts})
        raw = [p.encode("utf-8", "replace") for p in new]
        lo = 0
        while lo < len(new):
            hi, size = lo, 0
            while hi < len(new) and (hi == lo or size + len(raw[hi]) <= INDEX):
                size += len(raw[hi]) + 1
                hi += 1
            for p, ids in zip(new[lo:hi], self.pieces.encode_parts(raw[lo:hi])):
                known[p] = self.recent.new[p] = ids
            lo = hi
        for parts in split:
            yield b"".join([known[p] for p in parts])


def _coder(path: str) -> Coder:
    state = worker_state()
    return state.get(path) or state.setdefault(path, Coder(path))


def _encode_batches(path: str, digest: bool, body: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        coder = _coder(path)
        for batch in batches:
            texts = [(t.as_py() or b"").decode("utf-8", "replace") for t in batch.column(body)]
            kept = [c for c in batch.schema.names if c != body]
            columns = [batch.column(c) for c in kept]
            if digest:
                rows = []
                for text, raw in zip(texts, coder.encode(texts)):
                    ids = np.frombuffer(raw, "<u4")
                    # A text's own U+2581 reads as a space, the one thing that does not come back.
                    same = coder.pieces.decode(ids.tolist()) == text.replace(SPACE, " ")
                    rows.append((len(ids), zlib.crc32(raw), same))
                new = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.bool_())]
                yield pa.RecordBatch.from_arrays([*columns, *new], names=[*kept, "n_tokens", "ids_crc32", "round_trip"])
            else:
                ids = pa.array([np.frombuffer(raw, "<u4").astype(np.int32) for raw in coder.encode(texts)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*columns, ids], names=[*kept, "ids"])

    return run


def _decode_batches(path: str, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _coder(path).pieces
        for batch in batches:
            texts = [None if not v.is_valid else pieces.decode([i for i in v.as_py() if i is not None]) for v in batch.column(column)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return run


def _kinds(rows: DataFrame, without: str) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields if f.name != without)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Every row with ids: what the library gives for the text, without start and end pieces.

    A null or empty text has no ids. Other columns are kept, save `ids`.
    """
    (body,) = unused(docs, "_text")
    rows = docs.withColumn(body, F.col(text).cast("binary")).drop("ids")
    return rows.mapInArrow(_encode_batches(path, False, body), _kinds(rows, body) + "ids array<int>")


def digest(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_crc32, round_trip): count and CRC of the ids, and whether they decode to the text."""
    (body,) = unused(docs, "_text")
    rows = docs.select(key, F.col(text).cast("binary").alias(body))
    return rows.mapInArrow(_encode_batches(path, True, body), _kinds(rows, body) + "n_tokens long, ids_crc32 long, round_trip boolean")


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Every row with decoded: the text of its ids; null for null ids, empty for none. Ids outside the vocabulary are silent."""
    rows = encoded.drop("decoded")
    return rows.mapInArrow(_decode_batches(path, ids), _kinds(rows, "") + "decoded string")
