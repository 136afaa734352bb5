"""Convolutional toxicity classifier: hashed word embeddings, three filter widths, max pooling.

A word's embedding is the sum of hashed vectors of the word and of its first letters, so words never
seen in training share what their stems learned. Filters of width 1, 2 and 3 slide over whole texts,
each keeps its largest response, and a logistic layer turns those into a score. Every labelled row
teaches. A few are learned from on the driver; more are learned from in tasks, each of which goes over
a shard of the rows, and after each pass their weights are averaged. Cuts come from counts of the
scores of rows kept back. Scoring runs in the tasks.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meltemi.llm.common import Scratch, ddl_of, doc_fold, unused

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTHS = (1, 2, 3)
#: Text bytes whose words are in memory at a time.
SEGMENT = 1 << 20
#: Rows, and bytes of text, that are learned from on the driver; of more, rows in a shard.
LOCAL_ROWS, LOCAL_BYTES, SHARD_ROWS = 5000, 32 << 20, 8192
#: Times that few rows are gone over, and that many are.
EPOCHS, LEAST_EPOCHS = 12, 3
BATCH, RATE, SEED = 48, 0.02, 7
#: Places of a line of words that is learned from at a time.
LINE = 1 << 18
#: Buckets whose weights travel in one row, and steps of the logit that scores are counted by.
CHUNK, STEPS = 1 << 10, 256
_SPACED = bytes.maketrans(bytes(range(48)) + b":;<=>?@[\\]^_`{|}~", b" " * (48 + 17))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters, digits and non-ASCII characters."""
    return text.decode("utf-8", "replace").lower().encode().translate(_SPACED).split()


def features(word: bytes, buckets: int) -> list[int]:
    """Buckets of the word and of its first 3 to 7 characters; a short word repeats its own."""
    whole = zlib.crc32(b"=" + word) % buckets
    if len(word) < 3:
        return [whole] * 6
    letters = word.decode("utf-8", "replace")
    return [whole, *(zlib.crc32(letters[:n].encode()) % buckets for n in range(3, 8))]


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC, _MARKED = _crc_table(), zlib.crc32(b"=")


def all_features(words: list[bytes], buckets: int) -> np.ndarray:
    """features() of many words, a row for each."""
    whole = np.fromiter((zlib.crc32(w, _MARKED) for w in words), np.uint32, len(words))
    out = np.repeat((whole % np.uint32(buckets)).astype(np.int64)[:, None], 6, axis=1)
    plain = np.fromiter((len(w) if w.isascii() else 0 for w in words), np.int64, len(words))
    for rows, most in ((np.flatnonzero(plain >= 3), 7), (np.array([i for i in np.flatnonzero(plain == 0) if len(words[i]) >= 3], int), 28)):
        if not len(rows):
            continue
        heads = np.frombuffer(b"".join(words[i][:most].ljust(most, b"\0") for i in rows), np.uint8).reshape(-1, most)
        length = np.fromiter((len(words[i]) for i in rows), np.int64, len(rows))
        letter = np.cumsum((heads & 0xC0) != 0x80, axis=1)
        value = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for j in range(most):
            live = j < length
            value = np.where(live, _CRC[(value ^ heads[:, j]) & 0xFF] ^ (value >> 8), value)
            bucket = (~value % np.uint32(buckets)).astype(np.int64)
            # The first n letters, or all of a shorter word.
            for n in range(3, 8):
                now = live & (letter[:, j] <= n)
                out[rows[now], n - 2] = bucket[now]
    return out


@dataclass
class Model:
    """Weights; filters[w][j] maps the j-th embedding under a filter of width w to its responses."""

    embedding: np.ndarray
    filters: dict[int, list[np.ndarray]]
    shift: dict[int, np.ndarray]
    out: np.ndarray
    bias: float
    #: Multiplies and moves the raw logit so that 0.5 is the best cut over all languages.
    scale: float = 1.0
    centre: float = 0.0
    #: Score from which a document of a language is rejected; None holds for every other language.
    thresholds: dict[str | None, float] = field(default_factory=lambda: {None: 0.5})
    #: Without both classes to learn from, every score is this.
    constant: float | None = None

    def score(self, pooled: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(pooled), self.constant)
        logit = np.maximum(pooled + np.concatenate([self.shift[w] for w in WIDTHS]), 0) @ self.out + self.bias
        return 1 / (1 + np.exp(-np.clip(self.scale * (logit - self.centre), -30, 30)))


class Responses:
    """Largest filter responses of texts, from a table with every bucket's response to every filter."""

    def __init__(self, model: Model):
        self.count = len(model.out) // len(WIDTHS)
        self.buckets = len(model.embedding)
        blocks = [m for w in WIDTHS for m in model.filters[w]]
        self.table = np.concatenate([model.embedding @ m for m in blocks], axis=1).astype(np.float32)

    def _pool(self, words: list[list[bytes]], limit: int | None = None) -> np.ndarray:
        """Three empty places follow each text. A window starts at a word, so that a filter may hang over the end, or at
        the first empty place; at the other two it would reach into the next text. Only the first `limit` windows count."""
        index: dict[bytes, int] = {}
        line: list[int] = []
        starts, outside = [], []
        for own in words:
            starts.append(len(line))
            line += [index.setdefault(w, len(index) + 1) for w in own]
            line += (0, 0, 0)
            outside += (len(line) - 2, len(line) - 1)
        rows = np.zeros((len(index) + 1, self.table.shape[1]), np.float32)
        if index:
            for column in all_features(list(index), self.buckets).T:
                rows[1:] += self.table[column]
        at = np.array([*line, 0, 0])
        n, f, block, out = len(line), self.count, 0, []
        for w in WIDTHS:
            total = np.zeros((n, f), np.float32)
            for j in range(w):
                total += rows[at[j:j + n], block * f:(block + 1) * f]
                block += 1
            total[outside] = -np.inf
            out.append(np.maximum.reduceat(total[:limit], starts, axis=0))
        return np.concatenate(out, axis=1)

    def pool(self, texts: list[bytes]) -> np.ndarray:
        """One row per text, SEGMENT bytes at a time; parts of a longer text overlap by two words."""
        out, group, size = [], [], 0
        for t in texts:
            if group and size + len(t) > SEGMENT:
                out.append(self._pool(group))
                group, size = [], 0
            own = words_of(t)
            if len(t) > SEGMENT:
                step = SEGMENT // 8
                # Only the last part has an end over which filters may hang.
                parts = [
                    self._pool([own[lo:lo + step + 2]], step if lo + step < len(own) else None)
                    for lo in range(0, max(1, len(own)), step)
                ]
                if group:
                    out.append(self._pool(group))
                    group, size = [], 0
                out.append(np.max(parts, axis=0))
            else:
                group.append(own)
                size += len(t)
        if group:
            out.append(self._pool(group))
        return np.concatenate(out) if out else np.empty((0, self.count * len(WIDTHS)), np.float32)


# ---- training -----------------------------------------------------------------------------------

def _fresh(buckets: int, size: int, count: int, rng) -> Model:
    return Model(
        rng.normal(0, 0.1, (buckets, size)), {w: [rng.normal(0, 0.3, (size, count)) for _ in range(w)] for w in WIDTHS},
        {w: np.zeros(count) for w in WIDTHS}, np.abs(rng.normal(0, 0.3, count * len(WIDTHS))), -1.0)


class Learner:
    """A model in training: its weights with the sums that Adam and AdaGrad keep."""

    def __init__(self, model: Model):
        self.model = model
        self.params = [m for w in WIDTHS for m in model.filters[w]] + [model.shift[w] for w in WIDTHS] + [model.out]
        self.first, self.second = [np.zeros_like(p) for p in self.params], [np.zeros_like(p) for p in self.params]
        self.table = np.concatenate([model.embedding, np.zeros((1, model.embedding.shape[1]))])
        self.grown, self.step = np.full(len(model.embedding) + 1, 1e-6), 0

    def words(self, texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        """Texts as numbers of their words, three empty places (number 0) behind each; and the buckets of each number."""
        index: dict[bytes, int] = {}
        docs = [np.array([index.setdefault(w, len(index) + 1) for w in words_of(t)] + [0, 0, 0]) for t in texts]
        blank = len(self.table) - 1
        return docs, np.concatenate([np.full((1, 6), blank), all_features(list(index), blank)])

    def learn(self, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray, hashed: np.ndarray, rate: float = RATE) -> None:
        """One Adam step for the dense weights and one AdaGrad step for the touched embeddings."""
        self.step += 1
        model, count = self.model, len(self.model.out) // len(WIDTHS)
        top, where = self._tops(docs, hashed)
        raw = np.concatenate([top[k] + model.shift[w] for k, w in enumerate(WIDTHS)], axis=1)
        active = np.maximum(raw, 0)
        p = 1 / (1 + np.exp(-np.clip(active @ model.out + model.bias, -30, 30)))
        error = (p - y) * weight / len(docs)
        back = (error[:, None] * model.out) * (raw > 0)
        grads, pulls, rows = [], [], []
        for k, w in enumerate(WIDTHS):
            g = back[:, k * count:(k + 1) * count]
            for j in range(w):
                at = where[k][:, :, j]
                grads.append(np.einsum("bf,bfd->df", g, self.table[hashed[at]].sum(axis=2)))
                pulls.append((g[:, :, None] * model.filters[w][j].T[None]).reshape(-1, self.table.shape[1]))
                rows.append(at.ravel())
        grads += [back[:, k * count:(k + 1) * count].sum(axis=0) for k in range(len(WIDTHS))] + [active.T @ error]
        model.bias -= rate * float(error.sum())
        for p_, g, m, v in zip(self.params, grads, self.first, self.second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p_ -= rate * (m / (1 - 0.9 ** self.step)) / (np.sqrt(v / (1 - 0.999 ** self.step)) + 1e-8)
        pull, row = np.concatenate(pulls), np.concatenate(rows)
        live = np.any(pull != 0, axis=1)
        touched, back_to = np.unique(hashed[row[live]].ravel(), return_inverse=True)
        change = np.zeros((len(touched), self.table.shape[1]))
        np.add.at(change, back_to, np.repeat(pull[live], hashed.shape[1], axis=0))
        self.grown[touched] += (change ** 2).mean(axis=1)
        self.table[touched] -= rate * change / np.sqrt(self.grown[touched])[:, None]
        self.table[-1] = 0

    def _tops(self, docs: list[np.ndarray], hashed: np.ndarray) -> tuple:
        """By width, the largest response of each filter in each text and the words of its first window that has it.

        A window starts at any place but a text's last two. A text longer than LINE goes in parts that
        overlap by two words, and lines of more than LINE places are made one after the other.
        """
        if sum(len(d) for d in docs) <= LINE:
            return tuple(zip(*self._line(docs, hashed)))
        parts = [(i, d[lo:lo + LINE + 2]) for i, d in enumerate(docs) for lo in range(0, max(1, len(d) - 2), LINE)]
        top, where = [None] * len(WIDTHS), [None] * len(WIDTHS)
        while parts:
            n = max(1, int(np.searchsorted(np.cumsum([len(d) for _, d in parts]), LINE, "right")))
            own, parts = parts[:n], parts[n:]
            for k, (best, window) in enumerate(self._line([d for _, d in own], hashed)):
                if top[k] is None:
                    top[k] = np.full((len(docs), best.shape[1]), -np.inf)
                    where[k] = np.zeros((len(docs), *window.shape[1:]), window.dtype)
                for r, (i, _) in enumerate(own):
                    more = best[r] > top[k][i]
                    top[k][i, more], where[k][i, more] = best[r, more], window[r, more]
        return top, where

    def _line(self, docs: list[np.ndarray], hashed: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        sizes = [len(d) for d in docs]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        line = np.concatenate([*docs, [0, 0]])
        n = len(line) - 2
        outside = np.concatenate([ends - 1, ends - 2])
        seen, place = np.unique(line, return_inverse=True)
        vectors = self.table[hashed[seen]].sum(axis=1)[place]
        out = []
        for w in WIDTHS:
            total = sum(vectors[j:j + n] @ self.model.filters[w][j] for j in range(w))
            total[outside] = -np.inf
            best = np.maximum.reduceat(total, starts, axis=0)
            rows = np.where(total == np.repeat(best, sizes, axis=0), np.arange(n)[:, None], n)
            out.append((best, line[np.minimum.reduceat(rows, starts, axis=0)[:, :, None] + np.arange(w)]))
        return out

    def done(self) -> Model:
        self.model.embedding = self.table[:-1]
        return self.model

    # What a shard has learned travels as rows: one for each CHUNK of buckets, and one, numbered -1, for the rest.

    def packed(self, before: Learner, taught: int) -> Iterator[tuple[int, float, bytes]]:
        """Number, weight, values. A bucket counts by what its AdaGrad sum has grown, so shards without its words do not hold it back."""
        rest = [*self.params, *self.first, *self.second, np.array([self.model.bias, self.step])]
        yield -1, float(taught), np.concatenate([x.ravel() for x in rest]).tobytes()
        grown = self.grown - before.grown
        for lo in range(0, len(self.table), CHUNK):
            at = slice(lo, lo + CHUNK)
            yield lo // CHUNK, float(taught), np.column_stack([grown[at], (self.table - before.table)[at]]).astype(np.float32).tobytes()

    def take(self, rows: dict[int, bytes]) -> None:
        """Go on from the mean of the shards."""
        rest, at = np.frombuffer(rows[-1]), 0
        for own in (*self.params, *self.first, *self.second):
            own[...] = rest[at:at + own.size].reshape(own.shape)
            at += own.size
        self.model.bias, self.step = float(rest[at]), round(float(rest[at + 1]))
        size = 1 + self.table.shape[1]
        moved = np.concatenate([np.frombuffer(rows[k]).reshape(-1, size) for k in range(len(rows) - 1)])
        self.grown += moved[:, 0]
        self.table += moved[:, 1:]
        self.table[-1] = 0


def _balance(labels: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Weights by which both classes count the same."""
    return np.where(labels == 1, (toxic + clean) / (2 * toxic), (toxic + clean) / (2 * clean))


def train(
    texts: list[bytes], labels: np.ndarray, langs: list[str | None], buckets: int = 1 << 15, size: int = 12, count: int = 6,
    epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = SEED,
) -> Model:
    """Fit on four fifths of the rows, calibrate on the rest. Without both classes the model is constant."""
    rng = np.random.default_rng(seed)
    model = _fresh(buckets, size, count, rng)
    if len(np.unique(labels)) < 2:
        model.constant = float(labels[0]) if len(labels) else 0.0
        return model
    learner = Learner(model)
    docs, hashed = learner.words(texts)
    order = rng.permutation(len(docs))
    inner, outer = order[len(order) // 5:], order[:len(order) // 5]
    weight = _balance(labels, labels.sum(), (1 - labels).sum())
    for _ in range(epochs):
        for lo in range(0, len(inner), batch):
            own = inner[lo:lo + batch]
            learner.learn([docs[i] for i in own], labels[own], weight[own], hashed, rate)
        inner = rng.permutation(inner)
    _calibrate(learner.done(), [texts[i] for i in outer], labels[outer], [langs[i] for i in outer])
    return model


def best_cut(scores: np.ndarray, labels: np.ndarray) -> float:
    """The cut with the fewest errors; among equals the one in the middle of the widest gap."""
    order = np.argsort(scores)
    return _best_cut(scores[order], labels[order], 1 - labels[order])


def _best_cut(s: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """From ascending scores, and how many of either class have each."""
    wrong = np.concatenate([[0], np.cumsum(toxic)]) + np.concatenate([np.cumsum(clean[::-1])[::-1], [0]])
    edges = np.concatenate([[s[0] - 1], (s[1:] + s[:-1]) / 2, [s[-1] + 1]])
    room = np.concatenate([[0], np.diff(s), [0]])
    best = np.flatnonzero(wrong == wrong.min())
    return float(edges[best[room[best].argmax()]])


#: A language with few of either class keeps the common cut.
LEAST_OF_LANG = 10


def _bounded(cut: float) -> float:
    return min(0.95, max(0.05, cut))


def _logit(model: Model, pooled: np.ndarray) -> np.ndarray:
    return np.maximum(pooled + np.concatenate([model.shift[w] for w in WIDTHS]), 0) @ model.out + model.bias


def _calibrate(model: Model, texts: list[bytes], labels: np.ndarray, langs: list[str | None]) -> None:
    """Move the logit so that the best cut over all rows scores 0.5; then cut each language on its own."""
    if len(np.unique(labels)) < 2:
        return
    pooled = Responses(model).pool(texts)
    model.centre = best_cut(_logit(model, pooled), labels)
    scores = model.score(pooled)
    for lang in {x for x in langs if x is not None}:
        own = np.array([x == lang for x in langs])
        if min(labels[own].sum(), (1 - labels[own]).sum()) >= LEAST_OF_LANG:
            model.thresholds[lang] = _bounded(best_cut(scores[own], labels[own]))


def _calibrate_counts(model: Model, counts: list[tuple[str | None, int, int, int]]) -> None:
    """The same from counts: language, step of the logit, toxic rows, clean rows."""
    def ascending(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        step, toxic, clean = (np.array(c, np.int64) for c in zip(*rows))
        steps, back = np.unique(step, return_inverse=True)
        return (steps + 0.5) / STEPS, np.bincount(back, toxic, len(steps)), np.bincount(back, clean, len(steps))

    def both(rows, least: int) -> bool:
        return min(sum(r[2] for r in rows), sum(r[3] for r in rows)) >= least

    if not both(counts, 1):
        return
    model.centre = _best_cut(*ascending([r[1:] for r in counts]))
    by_lang: dict[str, list] = {}
    for r in counts:
        if r[0] is not None:
            by_lang.setdefault(r[0], []).append(r)
    for lang, own in by_lang.items():
        if both(own, LEAST_OF_LANG):
            logit, toxic, clean = ascending([r[1:] for r in own])
            model.thresholds[lang] = _bounded(_best_cut(1 / (1 + np.exp(-np.clip(logit - model.centre, -30, 30))), toxic, clean))


# ---- training in tasks --------------------------------------------------------------------------

def _learn_batches(shared, turn: int, toxic: int, clean: int):
    """One pass over a shard; a batch of rows is in memory at a time, and its rows are learned from in any order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rng = np.random.default_rng([SEED, turn, TaskContext.get().partitionId()])
        before: Learner = cloudpickle.loads(shared.value)
        learner: Learner = cloudpickle.loads(shared.value)
        taught = 0
        for rows in batches:
            labels = rows.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            docs, hashed = learner.words([t.as_py() or b"" for t in rows.column("text")])
            weight, order = _balance(labels, toxic, clean), rng.permutation(len(docs))
            for lo in range(0, len(order), BATCH):
                own = order[lo:lo + BATCH]
                learner.learn([docs[i] for i in own], labels[own], weight[own], hashed)
            taught += len(docs)
        if taught:
            out = list(zip(*learner.packed(before, taught)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, (pa.int32(), pa.float64(), pa.binary()))], names=["part", "taught", "weights"])

    return run


def _mean(size: int):
    """The mean of what the shards say of one part."""
    def run(table: pa.Table) -> pa.Table:
        part, taught = table.column("part")[0].as_py(), table.column("taught").to_numpy()
        if part < 0:
            every = np.stack([np.frombuffer(w.as_buffer()) for w in table.column("weights")])
            out = taught @ every / taught.sum()
        else:
            every = np.stack([np.frombuffer(w.as_buffer(), np.float32).reshape(-1, size) for w in table.column("weights")]).astype(float)
            grown = every[:, :, 0]
            total, shards = grown.sum(axis=0), np.maximum(1, (grown > 0).sum(axis=0))
            moved = (grown[:, :, None] * every[:, :, 1:]).sum(axis=0) / np.where(total > 0, total, 1)[:, None]
            out = np.column_stack([total / shards, moved])
        return pa.table({"part": pa.array([part], pa.int32()), "weights": pa.array([out.astype(float).tobytes()], pa.binary())})

    return run


def _logit_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = cloudpickle.loads(shared.value)
        responses = Responses(model)
        for rows in batches:
            logit = _logit(model, responses.pool([t.as_py() or b"" for t in rows.column("text")]))
            step = np.floor(np.clip(logit, -30, 30) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([rows.column("lang"), rows.column("toxic"), pa.array(step)], names=["lang", "toxic", "step"])

    return run


def _train_in_tasks(rows: DataFrame, toxic: int, clean: int, buckets: int = 1 << 15, size: int = 12, count: int = 6) -> Model:
    """train() on rows (doc_id, text, lang, toxic) as a table: a fifth is kept back by hash of doc_id, the rest dealt into shards.

    Few rows are gone over EPOCHS times and more of them fewer times, but every one at least LEAST_EPOCHS
    times. After each pass the driver gets one set of weights, whatever the number of shards.
    """
    spark = rows.sparkSession
    kept_back = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("kept back")), F.lit(5)) == 0
    learner = Learner(_fresh(buckets, size, count, np.random.default_rng(SEED)))
    shards = rows.filter(~kept_back).select("doc_id", "text", "toxic").coalesce(-(-(toxic + clean) * 4 // 5 // SHARD_ROWS))
    # The same order each time, which has nothing to do with how the rows lie.
    shards = shards.sortWithinPartitions(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").drop("doc_id")
    for turn in range(min(EPOCHS, max(LEAST_EPOCHS, -(-EPOCHS * LOCAL_ROWS // (toxic + clean))))):
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(learner))
        said = shards.mapInArrow(_learn_batches(shared, turn, toxic, clean), "part int, taught double, weights binary")
        means = said.groupBy("part").applyInArrow(_mean(1 + size), "part int, weights binary").collect()
        if means:
            learner.take({r.part: bytes(r.weights) for r in means})
        shared.destroy()
    model = learner.done()
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(model))
    steps = rows.filter(kept_back).select("text", "lang", "toxic").mapInArrow(_logit_batches(shared), "lang string, toxic int, step int")
    counts = steps.groupBy("lang", "step").agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).collect()
    shared.destroy()
    _calibrate_counts(model, [tuple(r) for r in counts])
    return model


def fit(docs: DataFrame, labels: DataFrame, fold: int = 5, held: int = 0) -> Model:
    """Train on every labelled document.

    Labels are read only from rows whose crc32 of doc_id, as text, modulo `fold` is not `held`.
    Rows of `labels` with a null doc_id or toxic, and those without a document, teach nothing. Of
    documents with one doc_id the one with the smallest text teaches. Up to LOCAL_ROWS rows are
    learned from on the driver, more of them in tasks.
    """
    scratch = Scratch(docs.sparkSession)
    usable = labels.select("doc_id", "toxic").filter((doc_fold(fold) != held) & F.col("toxic").isin(0, 1))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # One row per key before any join, so that a key which comes often is no large group.
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"), "lang").filter(doc_fold(fold) != held)
    texts = texts.groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("row")).select("doc_id", "row.*")
    rows = scratch.write(texts.join(usable, "doc_id"), "labelled")
    total = rows.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"), F.sum(F.octet_length("text")).alias("bytes")).first()
    few = total.n <= LOCAL_ROWS and (total.bytes or 0) <= LOCAL_BYTES
    if not few and 0 < total.toxic < total.n:
        model = _train_in_tasks(rows, total.toxic, total.n - total.toxic)
    else:
        # Where all are of one class, one row tells which.
        own = rows.collect() if few else rows.limit(1).collect()
        own.sort(key=lambda r: (r.doc_id, r.text or b""))
        model = train([bytes(r.text or b"") for r in own], np.array([r.toxic for r in own], dtype=np.int64), [r.lang for r in own])
    scratch.drop(rows)
    scratch.later()
    return model


def _score_batches(shared, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = cloudpickle.loads(shared.value)
        responses = Responses(model)
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(column)]
            kept = [c for c in batch.schema.names if c != column]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(model.score(responses.pool(texts)), pa.float64())],
                names=[*kept, "score"])

    return run


def score(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """Every row with score (0 to 1) and rejected: the score reaches its language's threshold.

    A null or empty text has no words and gets the score of no evidence. A language not seen in
    calibration, or null, has the common threshold. Other columns are kept, save `score` and
    `rejected`. The language takes no part in the score.
    """
    # A few megabytes of weights, by value: executors need no copy of this package.
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    (body,) = unused(docs, "_text")
    rows = docs.withColumn(body, F.col(text).cast("binary")).drop("score", "rejected")
    out = rows.mapInArrow(_score_batches(shared, body), f"{ddl_of(rows, body)}, score double")
    cut = F.lit(model.thresholds[None])
    if lang in docs.columns:
        for name, value in sorted((k, v) for k, v in model.thresholds.items() if k is not None):
            cut = F.when(F.col(lang) == name, value).otherwise(cut)
    return out.withColumn("rejected", F.col("score") >= cut)
