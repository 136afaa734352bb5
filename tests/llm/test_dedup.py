"""SimHash, embedding, line and suffix dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from meltemi.llm import embeddings, line_dedup, queries, simhash, suffix_dedup
from meltemi.llm.common import Scratch
from meltemi.llm.components import connected_components
from tests.conftest import SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def slow_fingerprint(text, n=4):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not tokens:
        return 0
    grams = [" ".join(tokens[i:i + n]) for i in range(max(1, len(tokens) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints, radius):
    parent = list(range(len(prints)))
    values = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= radius):
            a, b = find(parent, i), find(parent, i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    return [find(parent, i) for i in range(len(prints))]


def test_fingerprint_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    prints = [slow_fingerprint(r.text) for r in docs]
    want = {r.doc_id: (format(p, "016x"), docs[g].doc_id) for r, p, g in zip(docs, prints, slow_groups(prints, 4))}
    got = queries.QUERIES["op1_simhash_neardup"](spark, SMALL).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want and len(got) == len(want)


def test_simhash_on_odd_rows(odd_docs, no_docs):
    rows = odd_docs.collect()
    got = simhash.near_duplicates(odd_docs).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((r.doc_id, format(slow_fingerprint(r.text), "016x")) for r in rows)
    # No word: one group, whose smallest id is not the null one.
    assert {r.component_id for r in got if int(r.fingerprint, 16) == 0} == {-5}
    assert simhash.near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize("extra", [0, 2])
def test_every_close_pair_meets_at_an_anchor(spark, monkeypatch, extra):
    rng = random.Random(extra)
    prints = [rng.getrandbits(64) for _ in range(300)]
    prints += [p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for p in prints[:200]]
    # A crowd around one value, over the size of a cell.
    prints += [prints[0] ^ 1 << a ^ 1 << b for a in range(0, 64, 2) for b in range(0, 64, 3)]
    monkeypatch.setattr(simhash, "CELL_HOMES", 40)
    monkeypatch.setattr(simhash, "code_size", lambda n: extra)
    rows = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    scratch = Scratch(spark)
    roots = connected_components(simhash.link_forest(rows, 4, scratch), "a", "b", scratch).collect()
    root = {r.node % (1 << 64): r.root % (1 << 64) for r in roots}
    prints = sorted(set(prints))
    slow = slow_groups(prints, 4)
    by_root, by_slow = {}, {}
    for p, g in zip(prints, slow):
        by_root.setdefault(root.get(p, p), set()).add(p)
        by_slow.setdefault(g, set()).add(p)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_slow.values()))


def test_code_covers():
    words = simhash.half_code(0)
    assert len(set(words.tolist())) == 64
    rng = np.random.default_rng(0)
    points = rng.integers(0, 1 << 32, 20000, dtype=np.uint64).astype(np.uint32)
    assert np.bitwise_count(points[:, None] ^ words[None]).min(axis=1).max() <= 12
    assert [simhash.code_size(n) for n in (0, 10, 1 << 23, 1 << 25, 1 << 60)] == [0, 0, 0, 1, 10]


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(201, 200), (202, 201), (200, 202), (5, 5), (300, 300)]
    frame = spark.createDataFrame([*edges, (None, 3), (4, None)], "a long, b long")
    got = {r.node: r.root for r in connected_components(frame, "a", "b", Scratch(spark)).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 160)}, **{k: 200 for k in (200, 201, 202)}}


def slow_vectors(rows, least=0.93):
    def usable(r):
        v = r[1]
        return r[2] is not None and bool(v) and None not in v and np.isfinite(v).all() and any(v)

    n = len(rows)
    links, parent = [0] * n, list(range(n))
    for i in range(n):
        for j in range(i):
            if usable(rows[i]) and usable(rows[j]) and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                    links[i] += 1
                    links[j] += 1
                    x, y = find(parent, i), find(parent, j)
                    parent[max(x, y)] = min(x, y)
    return links, [find(parent, i) for i in range(n)]


def test_embeddings_with_hot_bucket_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    near = base[0] + 0.02 * rng.normal(size=(90, 16))
    some = base[1:20] + 0.05 * rng.normal(size=(19, 16))
    vectors = [v.tolist() for v in np.concatenate([base, near, some])]
    rows = [(k, v, k % 2) for k, v in enumerate(vectors)]
    rows += [(1000 + k, vectors[0], 0) for k in range(20)]
    rows += [(2000, None, 0), (2001, [], 0), (2002, [0.0] * 16, 0), (2003, [None, *vectors[0][1:]], 0), (2004, vectors[0], None),
             (2005, [float("nan"), *vectors[0][1:]], 0), (2006, [float("inf")] * 16, 0), (2007, vectors[0][:8], 0), (2008, [x * 1e150 for x in vectors[0]], 0)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, kept string")
    links, group = slow_vectors(rows[:-1])
    got = {r.vec_id: r for r in embeddings.near_duplicates(frame).collect()}
    assert len(got) == len(rows)
    exact = sum(got[r[0]].n_links == n + (r[2] == 0 and n > 50) for r, n in zip(rows, links))
    found, there = sum(got[r[0]].n_links for r in rows), sum(links)
    assert found >= 0.9 * there and exact >= 0.9 * len(links)
    for r, g in zip(rows[:-1], group):
        assert got[r[0]].component_id == rows[g][0] and got[r[0]].kept == (rows[g][0] == r[0])
    assert all(got[k].n_links == 0 for k in range(2000, 2008)) and got[2008].n_links > 60
    assert embeddings.near_duplicates(frame.limit(0)).collect() == []


def slow_lines(rows, least=10):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    seen = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if seen[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("batches, fan_out", [(1, 2), (5, 2), (4, 4)])
def test_lines_on_odd_rows(spark, odd_docs, batches, fan_out):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows += [(1000 + k, f"Shared LINE \n own {k}\n  shared line\n{'pair' if k % 2 else 'é'}") for k in range(12)]
    docs = odd_docs.select("doc_id", "text", "kept_text").unionByName(spark.createDataFrame([(*r, "x") for r in rows[-12:]], "doc_id long, text string, kept_text string"))
    got = line_dedup.drop_common_lines(docs, 10, batches=batches, fan_out=fan_out).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == slow_lines(rows)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got)
    assert line_dedup.drop_common_lines(docs.limit(0)).collect() == []


def test_runs_are_compacted_by_level(spark):
    runs = line_dedup.LineRuns(spark, 3, fan_out=2)
    docs = spark.createDataFrame([("a\nb",), ("a",)], "text string")
    for _ in range(5):
        runs.add(line_dedup.line_hashes(docs))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert runs.common().count() == 2
    runs.drop()
    assert runs.common().count() == 0


def test_batches_meet_the_runs_as_they_lie(spark):
    """One shuffle deals a batch, whatever the number of runs; runs are merged without any, and are read as sorted."""
    runs = line_dedup.LineRuns(spark, 3, fan_out=9)
    docs = spark.createDataFrame([(f"line {k}\nline {k % 7}",) for k in range(60)], "text string")
    for _ in range(3):
        runs.add(line_dedup.line_hashes(docs))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    batch = plan(runs.unsettled(line_dedup.line_hashes(docs)))
    assert batch.count("Exchange hashpartitioning") == 1 and batch.count("SortMergeJoin") == 3 and "Broadcast" not in batch
    assert batch.count("Sort [") == 1  # of the batch; the runs are sorted
    assert "Exchange" not in plan(runs.counts())
    held = Counter(x for k in range(60) for x in {f"line {k}", f"line {k % 7}"})
    # A line that one run has often enough is not counted again.
    assert sorted(r.n_docs for r in runs.counts().collect()) == sorted(n if n >= 3 else 3 * n for n in held.values())
    runs.drop()


@pytest.mark.parametrize("low, high, least", [(0.93, 0.94, 0.93), (0.94, 0.95, 0.96), (0.95, 0.99, 0.985)])
def test_recall_of_embedding_links_by_cosine(spark, low, high, least):
    """Pairs planted at a cosine of low to high are found with the chance the hashing gives; none below 0.93 is linked."""
    rng = np.random.default_rng(17)
    rows, n = [], 1500
    for k in range(n):
        a, b = rng.normal(size=(2, 64))
        a /= np.linalg.norm(a)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        c = rng.uniform(low, high)
        rows += [(2 * k, a.tolist(), k), (2 * k + 1, (c * a + np.sqrt(1 - c * c) * b).tolist(), k)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    found = sum(r.n_links for r in got) / 2
    assert least * n <= found <= n and all(r.component_id in (r.vec_id, r.vec_id - 1) for r in got)


def slow_suffixes(rows, depth):
    seen = Counter()
    bodies = [(t or "").encode() for _, t in rows]
    for b in bodies:
        seen.update(b[i:i + depth] for i in range(len(b) - depth + 1))
    out = []
    for (i, _), b in zip(rows, bodies):
        gone = [False] * len(b)
        for k in range(len(b) - depth + 1):
            if seen[b[k:k + depth]] > 1:
                gone[k:k + depth] = [True] * depth
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("depth", [3, 30, 400])
def test_suffixes_on_odd_rows(odd_docs, no_docs, depth):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = suffix_dedup.remove_repeats(odd_docs, depth).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == slow_suffixes(rows, depth)
    assert suffix_dedup.remove_repeats(no_docs, depth).collect() == []


def test_shared_passages_at_every_offset(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 3000)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 500)
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdé ") for _ in range(450))
    rows = [(k, "".join(rng.choice("xyzü ") for _ in range(rng.randint(0, 700))) + passage[rng.randint(0, 60):] + str(k)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs, 400).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == slow_suffixes(rows, 400)
    text = dict(rows)
    assert all(set(r.kept_text) <= set(text[r.doc_id]) and "�" not in r.kept_text for r in got)


def test_difference_covers():
    for depth in (2, 13, 50, 400, 1000):
        cover, v = suffix_dedup.difference_cover(depth)
        assert v < max(depth, 2) and {(a - b) % v for a in cover.tolist() for b in cover.tolist()} == set(range(v))


def test_short_passages_are_told_beside_the_bytes(spark, odd_docs):
    passage = " ".join(f"w{k}" for k in range(55))
    assert len(passage) < 400
    rows = [(1, f"a b {passage} c"), (2, f"d {passage}"), (3, "other words"), (4, None), (5, passage[:150])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, 400, passage=51).collect()}
    assert {k: (r.n_removed, r.n_passage_bytes, r.has_passage) for k, r in got.items()} == {
        1: (0, len(passage) + 1, True), 2: (0, len(passage), True), 3: (0, 0, False), 4: (0, 0, False), 5: (0, 0, False)}
    with_, without = suffix_dedup.remove_repeats(odd_docs, 400, passage=51), suffix_dedup.remove_repeats(odd_docs, 400)
    assert set(with_.columns) - set(without.columns) == {"n_passage_bytes", "has_passage"}
    assert Counter(with_.select(*without.columns).collect()) == Counter(without.collect())
    alone = suffix_dedup.remove_repeats(odd_docs, 51, unit="words")
    assert Counter(with_.select("doc_id", "n_passage_bytes").collect()) == Counter(alone.select("doc_id", "n_removed").collect())
    assert with_.filter("has_passage").count() > 0
    query = queries.QUERIES["op8_suffix_dedup"](spark, SMALL)
    assert query.columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] and "has_passage" in query.columns
