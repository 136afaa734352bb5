"""Quality rules over a word suffix array: how much of a text repeats, and how long its longest repeat is.

The suffix array of a group of texts is built by prefix doubling on the suffixes still tied, longest
common prefixes of neighbours come from the doubling ranks, and the deepest prefix interval that
holds a suffix gives the longest repeated substring that starts there. The union of those spans, of
`min_words` words or more, is the repeated part of the text.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meltemi.llm.common import ddl_of, unused

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Text bytes whose suffixes are sorted together; a longer text is sorted alone.
GROUP = 1 << 20
_SYMBOLS = b"#*$%&|<>"
COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered double, longest long"


@dataclass(frozen=True)
class Rules:
    """A text fails if it breaks a base rule, repeats more than max_covered of its characters, or has too long a repeat."""

    least_words: int = 50
    repeat_percent: int = 50
    min_words: int = 8
    max_covered: float = 0.4
    max_longest: int = 50


def longest_repeats(words: np.ndarray) -> np.ndarray:
    """For each position the length of the longest run of words from there that also starts elsewhere.

    Texts are told apart by giving each its own word numbers.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    # A rank is the place of a suffix's group in sorted order; level k has compared 2**k words.
    line = np.argsort(words, kind="stable")
    start = np.flatnonzero(np.diff(words[line], prepend=words[line[0]] - 1))
    rank = np.empty(n, np.int64)
    rank[line] = np.repeat(start, np.diff([*start, n]))
    # Levels are kept at half the width; n words take about log2 of the longest repeat of them.
    levels, step = [rank.astype(np.int32)], 1
    size = np.bincount(rank, minlength=n)
    tied = np.flatnonzero(size[rank] > 1)
    while len(tied):
        # Past the end comes before everything.
        follow = np.where(tied + step < n, rank[np.minimum(tied + step, n - 1)], -1)
        order = np.lexsort((follow, rank[tied]))
        own, base, after = tied[order], rank[tied][order], follow[order]
        new_base = np.diff(base, prepend=-1) != 0
        new_part = new_base | (np.diff(after, prepend=-2) != 0)
        at = np.arange(len(own))
        first = np.maximum.accumulate(np.where(new_base, at, 0))
        part = np.maximum.accumulate(np.where(new_part, at, 0))
        rank = rank.copy()
        rank[own] = base + part - first
        levels.append(rank.astype(np.int32))
        step *= 2
        size = np.bincount(rank[tied], minlength=n)
        tied = tied[size[rank[tied]] > 1]
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    # Longest common prefix of each suffix with the one before it in the array.
    common = np.zeros(n + 1, np.int64)
    pair = np.flatnonzero(levels[0][suffixes[1:]] == levels[0][suffixes[:-1]]) + 1
    a, b, length = suffixes[pair - 1], suffixes[pair], np.zeros(len(pair), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + length, b + length
        inside = (i < n) & (j < n)
        same = np.zeros(len(pair), bool)
        same[inside] = levels[k][i[inside]] == levels[k][j[inside]]
        length += same.astype(np.int64) << k
    common[pair] = length
    deepest = np.empty(n, np.int64)
    deepest[suffixes] = np.maximum(common[:-1], common[1:])
    return deepest


def spans_union(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in some span."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: list[bytes], rules: Rules) -> list[tuple]:
    """The columns of COLUMNS for each text."""
    numbers: list[int] = []
    sizes: list[int] = []
    starts, base = [0], 0
    for text in texts:
        own: dict[bytes, int] = {}
        words = text.split()
        numbers += [base + own.setdefault(w, len(own)) for w in words]
        if text.isascii():
            sizes += map(len, words)
        else:
            sizes += [len(w) if w.isascii() else len(w.decode("utf-8", "replace")) for w in words]
        base += len(own)
        starts.append(len(numbers))
    n, chars = len(numbers), np.array(sizes, np.int64)
    deepest = longest_repeats(np.array(numbers, np.int64))
    thrice = np.flatnonzero(deepest >= 3)
    repeat = spans_union(thrice, np.full(len(thrice), 3), n)
    long = np.flatnonzero(deepest >= rules.min_words)
    covered = spans_union(long, deepest[long], n)
    out = []
    for text, lo, hi in zip(texts, starts, starts[1:]):
        total = int(chars[lo:hi].sum())
        share = float(chars[lo:hi][covered[lo:hi]].sum() / total) if total else 0.0
        longest = int(deepest[lo:hi].max()) if hi > lo else 0
        lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
        symbols = len(text) - len(text.translate(None, _SYMBOLS))
        out.append((hi - lo, total, symbols, len(lines) - len(set(lines)), int(repeat[lo:hi].sum()), share, longest))
    return out


def _measure_batches(rules: Rules, body: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            group: list[bytes] = []
            size = 0
            for text in batch.column(body):
                own = text.as_py() or b""
                if group and size + len(own) > GROUP:
                    rows += measure(group, rules)
                    group, size = [], 0
                group.append(own)
                size += len(own)
            rows += measure(group, rules)
            kept = [c for c in batch.schema.names if c != body]
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64()] * 5 + [pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=[*kept, *(c.split()[0] for c in COLUMNS.split(", "))])

    return run


def judge(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """Every row with its measures, base_failed and kept.

    Words are runs without ASCII white space. A null or empty text has no words and fails the base
    rule. `covered` is the share of word characters inside repeats of min_words words or more, in
    the same text; `longest` the words of the longest repeat. Repeated rows are judged alike. Other
    columns are kept, save those named as an output.
    """
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    (body,) = unused(docs, "_text")
    rows = docs.withColumn(body, F.col(text).cast("binary")).drop(*names, "base_failed", "kept")
    out = rows.mapInArrow(_measure_batches(rules, body), f"{ddl_of(rows, body)}, {COLUMNS}")
    failed = (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))
    fine = (F.col("covered") <= rules.max_covered) & (F.col("longest") <= rules.max_longest)
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & fine)
