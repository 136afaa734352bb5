"""The near-copy stage finds every pair of texts at the similarity, whatever their fingerprints."""

import random

import numpy as np
import pytest

from meltemi.llm import shingle_join, simhash
from tests.llm.test_dedup import find
from tests.llm.test_pipeline import slow_similar


def long_words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(5, 9))) for _ in range(n)]


def partners():
    """Texts and copies of them with a new tail, a replaced passage, or few words: similar at 0.8 or just under."""
    rng, texts = random.Random(4), []
    for _ in range(60):
        base = long_words(rng, rng.randint(100, 250))
        n = len(base)
        at = rng.randint(0, n - n // 10)
        texts += [base, base + long_words(rng, int(n * rng.uniform(0.1, 0.27))),
                  base[:at] + long_words(rng, int(n * rng.uniform(0.02, 0.1))) + base[at + n // 14:]]
        short = long_words(rng, rng.randint(5, 24))
        texts += [short, short + long_words(rng, rng.randint(1, 4))]
    return [" ".join(t) for t in texts]


def templated():
    """One vocabulary of long words, so one fingerprint, and short fields that differ or nearly agree."""
    rng, texts = random.Random(5), []
    for _ in range(30):
        fields = [[str(rng.randint(0, 99)) for _ in range(3)] for _ in range(40)]
        texts.append([f"field{k:02} {' '.join(v)}" for k, v in enumerate(fields)])
        for _ in range(2):
            texts.append(list(texts[-1]))
            at = rng.randint(0, 39)
            texts[-1][at] = f"field{at:02} {rng.randint(100, 999)} 0 0"
    return [" ".join(t) for t in texts]


def groups_of(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "_row long, text string")
    got = {r._row: r.root for r in simhash.similar_documents(rows).collect()}
    assert len(got) == len(texts)
    return [got[k] for k in range(len(texts))]


def test_appended_replaced_and_short_copies_are_all_found(spark):
    texts = partners()
    assert groups_of(spark, texts) == slow_similar(texts)


def test_copies_within_one_fingerprint_are_all_found(spark):
    texts = templated()
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
    assert len({simhash.vocabulary_fingerprint(t.encode(), 5, bits) for t in texts}) == 1
    want = slow_similar(texts)
    assert 1 < len(set(want)) < len(texts)
    assert groups_of(spark, texts) == want


@pytest.mark.parametrize("block, few", [(3, 2)])
def test_crowds_dealt_over_cells(spark, monkeypatch, block, few):
    monkeypatch.setattr(shingle_join, "BLOCK", block)
    monkeypatch.setattr(shingle_join, "FEW", few)
    rng = random.Random(6)
    base = long_words(rng, 120)
    texts = partners()[:60] + [None, "", " \n", "a", "A", "a b"]
    # A chain of copies, each like its neighbours, around one text and another chain away from it.
    for k in range(60):
        own = list(base)
        for at in range(k % 30, k % 30 + 9 + k // 30 * 6):
            own[at * 3 % 120] = f"changed{k % 7}"
        texts.append(" ".join(own))
    want = slow_similar(texts)
    assert groups_of(spark, texts) == want
    assert len({find(list(want), k) for k in range(len(want))}) > 5


def test_pairs_alone_are_complete(spark, monkeypatch):
    """Without a candidate from fingerprints, the join alone finds the groups."""
    monkeypatch.setattr(simhash, "link_forest", lambda nodes, radius, scratch: scratch.write(
        spark.createDataFrame([], "a long, b long"), "none"))
    texts = partners()
    assert groups_of(spark, texts) == slow_similar(texts)
