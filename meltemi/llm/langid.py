"""Language identification by error-correcting output codes over character n-grams.

Each language has a codeword of bits; one linear classifier over hashed n-gram frequencies learns each
bit. A text's margins are decoded to the codeword with the least loss, bits weighted by how well they
were told apart on rows kept back, and a text whose two nearest codewords are close is flagged.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meltemi.llm.common import ddl_of, doc_fold, unused

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS, ORDERS = 1 << 14, (1, 2, 3)
UNKNOWN = "und"
#: Bytes turned into n-grams at a time.
SEGMENT = 1 << 20
_LETTERS = bytes.maketrans(bytes(range(97)) + b"{|}~\x7f", b" " * (97 + 5))


def histogram(text: bytes) -> np.ndarray:
    """Counts of hashed n-grams of the lower-cased text; ASCII other than letters counts as a space."""
    total = np.zeros(BUCKETS, np.int64)
    # A part takes up the last bytes of the one before, so that no n-gram is lost or counted twice.
    line = b" " + text.decode("utf-8", "replace").lower().encode().translate(_LETTERS) + b" "
    for lo in range(0, len(line), SEGMENT):
        for n in ORDERS:
            own = np.frombuffer(line[max(0, lo - n + 1):lo + SEGMENT], np.uint8).astype(np.uint32)
            if len(own) < n:
                continue
            gram = np.full(len(own) - n + 1, n, np.uint32)
            for j in range(n):
                gram = gram * np.uint32(257) + own[j:len(own) - n + 1 + j]
            gram = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14)
            total += np.bincount(gram, minlength=BUCKETS)
    return total


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """(n, bits) of +1 and -1: every split of few languages, else the farthest-apart of random codes."""
    if n <= 6:
        bits = np.arange(1, 1 << (n - 1)) if n > 1 else np.array([1])
        return np.array([[1 if i == n - 1 or not (b >> i) & 1 else -1 for b in bits] for i in range(n)])
    rng, best = np.random.default_rng(seed), None
    size = 8 * int(np.ceil(np.log2(n)))
    for _ in range(200):
        code = rng.choice([-1, 1], (n, size))
        # A bit that parts no two languages has nothing to learn: one of them is turned.
        code[0, np.abs(code.sum(axis=0)) == n] *= -1
        apart = ((code[:, None] != code[None]).sum(axis=2) + size * np.eye(n, dtype=int)).min()
        if best is None or apart > best[0]:
            best = (apart, code)
    return best[1]


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray
    #: Loss between the two nearest codewords under which a text is ambiguous.
    margin: float = 0.5

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the codeword with the least weighted logistic loss, its share of belief, and ambiguity."""
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None]) @ self.trust
        order = np.sort(loss, axis=1)
        belief = np.exp(-(loss - order[:, :1]))
        near = order[:, 1] - order[:, 0] < self.margin if loss.shape[1] > 1 else np.zeros(len(loss), bool)
        return loss.argmin(axis=1), belief.max(axis=1) / belief.sum(axis=1), near

    def margins(self, counts: np.ndarray) -> np.ndarray:
        return counts @ self.weights / counts.sum(axis=1, keepdims=True) + self.bias


def train(texts: list[bytes], langs: list[str], steps: int = 300, decay: float = 1e-3, seed: int = 3) -> Model | None:
    """Logistic classifiers, fitted in the span of the training rows; None without a row."""
    if not texts:
        return None
    names = sorted(set(langs))
    code = codewords(len(names))
    if len(names) == 1:
        return Model(names, code, np.zeros((BUCKETS, 1)), np.ones(1), np.ones(1))
    rows = np.stack([histogram(t).astype(np.float32) for t in texts])
    rows /= rows.sum(axis=1, keepdims=True)
    mean = rows.mean(axis=0)
    spread = np.sqrt(mean + 1e-6)
    rows = (rows - mean) / spread
    target = code[[names.index(x) for x in langs]]
    order = np.random.default_rng(seed).permutation(len(rows))
    inner, outer = order[len(rows) // 5:], order[:len(rows) // 5]
    alpha, kernel = np.zeros((len(inner), code.shape[1])), (rows[inner] @ rows[inner].T).astype(np.float64)
    constant = 0.05 * np.trace(kernel) / len(inner)
    kernel += constant  # a bias, learned with the rest
    rate = 4 / np.linalg.norm(kernel, 2) * len(inner)
    speed = np.zeros_like(alpha)
    for _ in range(steps):
        pull = target[inner] / (1 + np.exp(np.clip(target[inner] * (kernel @ alpha), -30, 30))) / len(inner)
        speed = 0.9 * speed + rate * (pull - decay * alpha)
        alpha += 0.1 * speed
    weights = rows[inner].T.astype(np.float64) @ alpha / spread[:, None]
    model = Model(names, code, weights, constant * alpha.sum(axis=0) - mean @ weights, np.ones(code.shape[1]))
    if len(outer):
        got = (rows[outer] * spread + mean) @ model.weights + model.bias
        right = (np.sign(got) == target[outer]).mean(axis=0)
        model.trust = np.maximum(2 * right - 1, 0.05)
    return model


def fit(docs: DataFrame, rows_per_lang: int = 400, fold: int = 4, held: int = 2) -> Model | None:
    """Train on at most rows_per_lang documents of each lang, drawn by a hash of doc_id.

    Only rows with a lang and a text, whose crc32 of doc_id, as text, modulo `fold` is not `held`. Of
    documents with one doc_id and lang the one with the smallest text teaches.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (doc_fold(fold) != held))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # Repeated keys go before the draw. Only those below a bar of the hash are ranked, so that a lang with most
    # of the rows sends a few times rows_per_lang keys to one task, however many tasks there are.
    keys = usable.select("doc_id", "lang").distinct()
    counts = keys.groupBy("lang").agg(F.count("*").alias("_count"))
    share = 2.0**32 * 4 * rows_per_lang / F.col("_count")
    keys = keys.join(counts, "lang").filter(F.pmod(F.xxhash64("doc_id", F.lit("bar")), F.lit(2**32)) < share).drop("_count")
    picked = keys.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= rows_per_lang)
    picked = F.broadcast(picked.select("doc_id", "lang"))
    rows = usable.select("doc_id", "lang", F.col("text").cast("binary").alias("text")).join(picked, ["doc_id", "lang"])
    rows = rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r.doc_id, r.lang, r.text))
    return train([bytes(r.text) for r in rows], [r.lang for r in rows])


def _predict_batches(shared, body: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = cloudpickle.loads(shared.value)
        for batch in batches:
            texts = [t.as_py() for t in batch.column(body)]
            langs, scores, flags = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
            told = [i for i, t in enumerate(texts) if t and model and any(map(str.isalpha, t.decode("utf-8", "replace")))]
            if told:
                margins = np.concatenate([model.margins(histogram(texts[i])[None]) for i in told])
                for i, which, score, near in zip(told, *(x.tolist() for x in model.decode(margins))):
                    langs[i], scores[i], flags[i] = model.langs[which], score, near
            kept = [c for c in batch.schema.names if c != body]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(flags, pa.bool_())],
                names=[*kept, "lang_pred", "score", "ambiguous"])

    return run


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Every row with lang_pred, score (0 to 1) and ambiguous.

    A null text, or one without a letter, is `und` with score 0, and so is every text if there was
    nothing to learn from. With a single language learned, all others are that one with score 1.
    Other columns are kept, save those named as an output.
    """
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    (body,) = unused(docs, "_text")
    rows = docs.withColumn(body, F.col(text).cast("binary")).drop("lang_pred", "score", "ambiguous")
    return rows.mapInArrow(_predict_batches(shared, body), f"{ddl_of(rows, body)}, lang_pred string, score double, ambiguous boolean")
