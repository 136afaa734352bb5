"""The pipeline: every stage's decisions against a plain version of them, and odd tables."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from meltemi.llm import queries, sql, suffix_dedup, toxicity
from meltemi.llm.common import table
from tests.conftest import SMALL
from tests.llm.conftest import words
from tests.llm.test_dedup import LOWER, find, slow_lines


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_and_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_neardup", "suffix_dedup", "packing"]
    assert [re.match(r"op(\d+)_", k)[1] for k in queries.QUERIES] == [str(n) for n in range(1, 14)]
    assert "pipeline" in entry.queries() and set(queries.QUERIES) <= set(entry.queries()) and set(sql.ORACLE) <= set(queries.QUERIES)


def test_toxicity_stage_rejects_by_threshold(spark):
    docs = table(spark, SMALL, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, SMALL, "labels")))
    want = {r.doc_id for r in scored.filter("NOT rejected").collect()}
    assert {r.doc_id for r in stage("toxicity")(spark, docs, SMALL).collect()} == want


def test_text_stages_match_brute_force(spark):
    docs = table(spark, SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    lines = stage("line_dedup")(spark, docs, SMALL)
    assert lines.columns == docs.columns
    assert {(r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in lines.collect()} == {(k[0], k[3]) for k in slow_lines(rows)}
    passages = stage("suffix_dedup")(spark, docs, SMALL).collect()
    assert {r.doc_id: r.text for r in passages} == slow_passages(rows, 51)
    assert all(r.n_chars == len(r.text) for r in passages)


@pytest.mark.parametrize("block, segment", [(2 << 20, 1 << 20), (900, 64)])
def test_passages_of_many_lengths_match_brute_force(spark, odd_docs, monkeypatch, block, segment):
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
    shared = words(77, 130).split()
    rng = random.Random(4)
    rows = [(r.doc_id, r.text) for r in odd_docs.filter("doc_id >= 100").select("doc_id", "text").collect()]
    for k in range(90):
        lo = rng.randrange(60)
        part = " ".join(shared[lo:lo + rng.choice((30, 45, 50, 51, 52, 60, 70))])
        own = [words(1000 + k, rng.randrange(30)), part.replace(" ", rng.choice((" ", "\n", "\t  "))), words(2000 + k, rng.randrange(30))]
        rows.append((5000 + k, rng.choice(("", " ", "\n")).join(["", *own]) if k % 7 else part))
    rows.append((9000, words(5, 40) + " " + "x" * 300 + " " + words(6, 60)))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], odd_docs.select(*corpus_pipeline.COLUMNS).schema)
    got = {r.doc_id: r.text or "" for r in stage("suffix_dedup")(spark, docs, SMALL).collect()}
    want = slow_passages(rows, 51)
    assert got == want and len(want) < len(rows) and sum(want[i] != (t or "") for i, t in rows if i in want) > 20


def slow_passages(rows, n):
    """Texts without the words of passages of n words that stand anywhere else; one of which nothing is left is out."""
    pieces = {i: re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", t or "") for i, t in rows}
    keys = {i: [p.rstrip(" \t\n\x0b\x0c\r") for p in own] for i, own in pieces.items()}
    seen = Counter(tuple(k[j:j + n]) for k in keys.values() for j in range(len(k) - n + 1))
    out = {}
    for i, t in rows:
        gone = set()
        for j in range(len(keys[i]) - n + 1):
            if seen[tuple(keys[i][j:j + n])] > 1:
                gone |= set(range(j, j + n))
        head = (t or "")[:len(t or "") - sum(map(len, pieces[i]))]
        left = head + "".join(p for j, p in enumerate(pieces[i]) if j not in gone)
        if not gone or left.strip(" \t\n\x0b\x0c\r"):
            out[i] = left
    return out


def slow_similar(texts, words=5, least=0.8):
    """Group of each text: the first index it reaches over pairs with similar shingles."""
    sets = []
    for t in texts:
        tokens = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))})
    parent = list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= least * len(sets[i] | sets[j]):
                a, b = find(parent, i), find(parent, j)
                parent[max(a, b)] = min(a, b)
    return [find(parent, i) for i in range(len(texts))]


def test_one_of_each_group_stays(spark, odd_docs):
    base = [words(k, 300) for k in range(40, 60)]
    near = [" ".join("changed" if k % 90 == n else w for k, w in enumerate(b.split())) for n, b in enumerate(base)]
    unlike = [" ".join(w if k % 12 else f"other{k}" for k, w in enumerate(b.split())) for b in base]
    crowd = [base[0] + f" tail{k}" for k in range(200)]
    more = [(1000 + k, t, "en", "s", 1) for k, t in enumerate(base + near + unlike + crowd)]
    docs = odd_docs.select(*corpus_pipeline.COLUMNS).unionByName(spark.createDataFrame(more, odd_docs.select(*corpus_pipeline.COLUMNS).schema))
    rows = docs.collect()
    by = {}
    for r, g in zip(rows, slow_similar([r.text for r in rows])):
        by.setdefault(g, []).append(r.doc_id)
    want = sorted(str(min((i for i in ids if i is not None), default=None)) for ids in by.values())
    kept = Counter(str(r.doc_id) for r in stage("simhash_neardup")(spark, docs, SMALL).collect())
    # Nothing that is like no other goes; equal texts, the crowd and near copies leave one each.
    assert kept == Counter(want)


def test_near_copies_of_the_given_documents(spark):
    docs = table(spark, SMALL.replace("0.001", "0.01"), "documents")
    rows = docs.collect()
    groups = slow_similar([r.text for r in rows])
    kept = {r.doc_id for r in stage("simhash_neardup")(spark, docs, SMALL).collect()}
    firsts = {rows[g].doc_id for g in set(groups)}
    assert kept == firsts


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, odd_docs, name):
    for docs in (odd_docs, odd_docs.limit(0)):
        out = stage(name)(spark, docs, SMALL)
        if name != "packing":
            assert out.columns == corpus_pipeline.COLUMNS
        assert (out.count() == 0) == (docs.count() == 0)


def test_run_loses_no_document_after_the_filters(spark):
    got = corpus_pipeline.run(spark, SMALL)
    docs = table(spark, SMALL, "documents")
    for name, run in corpus_pipeline.STAGES[:4]:
        docs = run(spark, docs, SMALL)
    want = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {r.doc_id for r in got.filter(F.col("piece") == 0).collect()} == want
