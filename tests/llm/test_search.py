"""Personal data, ranked search and hard negatives: brute force, held-out rows, odd tables."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from meltemi.llm import lexical, negatives, pii, queries, sql
from meltemi.llm.common import table
from tests.conftest import SMALL
from tests.llm.conftest import words


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", ["op12_lexical_search", "op13_hard_negatives"])
def test_query_matches_its_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SMALL)
    want = duck.execute(sql.ORACLE[name])
    columns = [c[0] for c in want.description]
    assert set(columns) == set(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())


# ---- personal data ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def field():
    return pii.fit(copies=6)


def plain_base(text):
    """The patterns as they are written, with the checks by hand."""
    found = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card":
                doubled = [d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(reversed(digits))]
                if not 12 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), pii.KINDS.index(kind), kind, m.end()))
    return [(s, kind, e) for s, _, kind, e in sorted(found)]


def test_base_spans_are_those_of_the_patterns(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("0123456789" * 2 + "..@ -+()ab%_é\n") for _ in range(rng.randrange(80))) for _ in range(4000)]
    texts += [t for t, _ in pii.labelled_rows(pii.EXAMPLES, 4, 8)]
    texts += ["a@b.c@d.e", "a@b@c.d", "@a.b", "1.2.3.4.5.6.7.8.9", "999.1.1.1", "000255.0.0.1", "4111 1111-1111 1111", "+1 23456789-", "٣.1.1.1.1"]
    texts += [r.text or "" for r in table(spark, SMALL, "documents").collect()]
    for text in texts:
        assert pii.base_spans(text) == plain_base(text), text


def test_viterbi_finds_the_best_of_all_paths():
    rng = np.random.default_rng(2)
    k = len(pii.STATES)
    model = pii.Crf(rng.normal(size=(5, pii.CLASSES, k)), rng.normal(size=(pii.CHAINS, k)), rng.normal(size=(k, k)) + pii._BARRED)
    rows = [(rng.integers(1, pii.CLASSES, n), rng.integers(0, pii.CHAINS, n)) for n in (1, 2, 3, 4, 3, 0)]

    def value(row, path):
        shapes, chains = row
        wide = [0, 0, *shapes, 0, 0]
        total = pii._FIRST[path[0]]
        for t, s in enumerate(path):
            total += sum(model.shapes[o][wide[t + o]][s] for o in range(5)) + model.chains[chains[t]][s]
            total += model.steps[path[t - 1]][s] if t else 0
        return total

    for row, best in zip(rows, model.decode(rows)):
        n = len(row[0])
        assert len(best) == n
        if n:
            paths = np.stack(np.meshgrid(*[np.arange(k)] * n, indexing="ij"), -1).reshape(-1, n)
            assert math.isclose(value(row, best), max(value(row, p) for p in paths))


def test_training_climbs_the_slope_of_the_likelihood():
    """The gain of a step equals what finite differences promise."""
    rows = []
    for text, spans in pii.labelled_rows(pii.EXAMPLES[:6], 1, 4):
        tokens, shapes, chains = pii.tokens_of(text)
        rows.append((shapes[:4], chains[:4], pii._states(tokens, spans)[:4]))

    def likelihood(model):
        total = 0
        for shapes, chains, states in rows:
            own = model.emissions(shapes[None], chains[None])[0]
            alpha = own[0] + pii._FIRST
            truth = own[0][states[0]]
            for t in range(1, len(own)):
                alpha = pii._log_sum(alpha[:, None] + model.steps, 0) + own[t]
                truth += own[t][states[t]] + model.steps[states[t - 1], states[t]]
            total += truth - pii._log_sum(alpha, 0)
        return total

    values = [likelihood(pii.train(rows, rounds=n, rate=0.05)) for n in (1, 5, 20, 60)]
    assert values == sorted(values) and values[-1] > -1


def test_field_on_held_out_rows(field):
    rows = pii.labelled_rows(pii.EXAMPLES, 5, 99)
    got = pii.added_spans([t for t, _ in rows], field)
    right = sum(sorted(g) == sorted(s) for g, (_, s) in zip(got, rows))
    assert right >= 0.97 * len(rows)


def test_field_adds_what_the_patterns_miss_and_leaves_clean_texts_alone(field):
    card = "4111111111111111"
    text = f"words {card} {card} and jane at example dot com, call (212) 555-0187 now"
    spans = pii.all_spans(pii.base_spans(text), pii.added_spans([text], field)[0])
    assert pii.base_spans(text) == []
    assert [(k, text[s:e]) for s, k, e in spans] == [
        ("card", card), ("card", card), ("email", "jane at example dot com"), ("phone", "(212) 555-0187")]
    clean = ["We met at noon, at the dot.", "See 12 of 300 (chapter 4.2.1) in 1999, 50% off.", 'token = "04dbebab91ab85687d33eeaaf9ac699e"',
             "4111111111111112 is no card", "The 3rd of 2024-05-06 at 10:30."]
    assert pii.added_spans(clean, field) == [[] for _ in clean]


def test_pii_on_odd_rows(spark, odd_docs, no_docs, field):
    odd = odd_docs.withColumns({"spans": F.lit("old"), "text_": F.lit("mine"), "n_ip": F.lit("old")})
    out = pii.find(odd, field)
    assert set(out.columns) == set(odd.columns) | set(pii.OUTPUT) and out.count() == odd.count()
    assert {r.text_ for r in out.collect()} == {"mine"} and pii.find(no_docs, field).collect() == []
    assert sorted(map(str, out.select("doc_id", "text", "fp").collect())) == sorted(map(str, odd.select("doc_id", "text", "fp").collect()))
    row = pii.find(spark.createDataFrame([(1, "é a@b.cd ok"), (2, None)], "k int, text string"), field).orderBy("k").collect()
    assert row[0].base == row[0].spans == "email:2:8" and row[0].redacted_text == "é [EMAIL] ok"
    assert row[1].spans == row[1].redacted_text == "" and row[1].n_email == 0


def test_pii_on_very_long_texts(field):
    long = "1" * 300000 + "@" * 300000 + "1.1" * 200000 + "a" * 300000 + " a@b.c " + "1 2 " * 20000
    assert [k for _, k, _ in pii.base_spans(long)].count("email") == 1
    assert isinstance(pii.added_spans([long], field)[0], list)


def test_pii_query_digests_its_spans(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op11_pii"](spark, SMALL).collect()}
    docs = table(spark, SMALL, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        want, r = plain_base(d.text or ""), got[d.doc_id]
        written = ",".join(f"{k}:{s}:{e}" for s, k, e in want)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in want) for kind in pii.KINDS]
        assert set(written.split(",")) <= set(r.spans.split(","))


# ---- ranked search ------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_search(docs, items, top):
    counted = [(k, Counter(t.translate(LOWER) for t in TERM.findall(text or ""))) for k, text in docs]
    counted = [(k, c, sum(c.values())) for k, c in counted if c]
    total, every = len(counted), sum(n for *_, n in counted)
    holding = Counter(t for _, c, _ in counted for t in c)
    out = []
    for name, text in items:
        scores = []
        for k, c, n in counted:
            m = 10 + 90 * n * total // every
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * holding[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in {t.translate(LOWER) for t in TERM.findall(text or "")} if t in c)
            if score > 0:
                scores.append((-score, k is None, k))
        out += [(name, r + 1, k, -s) for r, (s, _, k) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def test_search_equals_brute_force_on_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(lexical, "BUCKET_ROWS", 3)
    monkeypatch.setattr(lexical, "FIRST_BUCKETS", 2)
    monkeypatch.setattr(lexical, "SEGMENT", 1000)
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    docs += [(1000 + k, words(k % 40, 5 + k % 30)) for k in range(300)] + [(k, "same line of words") for k in range(50)]
    items = [(k, words(k, 30)) for k in range(12)] + [(3, words(3, 30)), (90, None), (91, ""), (92, "same words"), (None, "here Text line")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit("x")).withColumn("terms", F.lit(1)).repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("name", F.lit("x"))
    want = plain_search(docs, items, 4)
    assert sorted(map(tuple, lexical.search(frame, asked, top=4).collect()), key=str) == want
    monkeypatch.setattr(lexical, "PASS_TERMS", 40)
    assert sorted(map(tuple, lexical.search(frame, asked, top=4).collect()), key=str) == want
    assert lexical.search(no_docs, asked).collect() == [] and lexical.search(frame, asked.limit(0)).collect() == []


def test_bounds_leave_no_document_out_and_prune():
    rng = np.random.default_rng(7)
    sizes = rng.integers(1, 40, 400)
    terms = np.concatenate([rng.choice(200, n, replace=False) for n in sizes]).astype(np.int32)
    impacts = rng.integers(1, 10**9, len(terms)) // (1 + terms)
    bucket = lexical.Bucket(sizes.astype(np.int32).tobytes(), terms.tobytes(), impacts.tobytes())
    seen = 0
    for _ in range(50):
        item = np.sort(rng.choice(220, 12, replace=False))
        wanted = np.zeros(220, bool)
        wanted[item] = True
        scores = bucket.scores(np.arange(400), wanted)
        ends = np.cumsum(sizes)
        assert scores.tolist() == [int(impacts[e - n:e][wanted[terms[e - n:e]]].sum()) for e, n in zip(ends, sizes)]
        bar = int(np.sort(scores)[-10])
        rows = bucket.may_reach(item, bar)
        assert set(np.flatnonzero(scores >= bar)) <= set(rows.tolist())
        seen += len(rows)
    assert seen < 0.5 * 50 * 400


# ---- hard negatives -----------------------------------------------------------------------------

def plain_mine(rows, every, positives, negatives_, low, high):
    """rows: (id, label, vector)."""
    own = {(i, y, tuple(math.floor(256 * float(x)) for x in v)) for i, y, v in rows
           if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, y, v in own:
        if i % every:
            continue
        score = sorted((-sum(a * b for a, b in zip(v, u)), j, z) for j, z, u in own if len(u) == len(v))
        for p, j, _ in [s for s in score if s[2] == y and s[1] != i][:positives]:
            good = [s for s in score if s[2] != y and low * -p <= 100 * -s[0] <= high * -p][:negatives_]
            out += [(i, j, r + 1, k, -p, -s) for r, (s, k, _) in enumerate(good)]
    return sorted(out)


def test_mining_equals_brute_force(spark, monkeypatch):
    for name, value in (("BLOCK", 16), ("GROUP", 7), ("CELL", 3)):
        monkeypatch.setattr(negatives, name, value)
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(12)]
    rows = [(k, rng.choice([0, 1, 1, 1, 2]), [c + rng.gauss(0, 0.4) for c in rng.choice(centres)]) for k in range(600)]
    rows += [(1000 + k, k % 3, [0.5] * 6) for k in range(80)]  # ties
    rows += [(5, None, [1.0] * 6), (10, 1, None), (20, 1, [1.0, None]), (30, 1, [float("nan")] * 6), (40, 1, [float("inf")] * 6), (None, 1, [1.0] * 6)]
    rows += [(2000, 1, [1.0, 2.0]), (2001, 2, [1.0, 1.5]), (2003, 1, [2.0, 1.0]), (2010, 1, []), (2011, 2, []), (2012, 1, []), (2020, 0, [0.0] * 6)]
    rows += [rows[0], (0, 2, rows[7][2])]  # a repeated row, a repeated key
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns(
        {c: F.lit("x") for c in ("id", "raw", "grp", "place")}).repartition(6)
    got = sorted(map(tuple, negatives.mine(frame, every=10, positives=4, negatives=3).collect()))
    assert got == plain_mine(rows, 10, 4, 3, 80, 100) and len(got) > 100
    assert negatives.mine(frame.limit(0)).collect() == []
    assert negatives.mine(frame.filter("vec_id = 1")).collect() == []


def test_large_components_stay_exact(spark):
    rows = [(k, k % 2, [30000.0 + k, 2.0 * k, 1e4]) for k in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert sorted(map(tuple, negatives.mine(frame, every=10).collect())) == plain_mine(rows, 10, 5, 5, 80, 100)


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (4, 2)])
def test_the_curve_visits_every_cell_by_steps_to_a_neighbour(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    places = negatives.hilbert(cells, bits)
    assert sorted(places.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(places)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_intervals_hold_every_score_and_prune_near_blocks():
    rng = np.random.default_rng(4)
    anchors = rng.integers(-99, 99, (50, 8))
    block = rng.integers(-9, 9, (64, 8)) + rng.integers(-60, 60, 8)
    least, most = negatives.interval(anchors, block.min(axis=0), block.max(axis=0))
    scores = anchors @ block.T
    assert (least[:, None] <= scores).all() and (scores <= most[:, None]).all()
    rows = [(k, 0, 8, a.astype(np.int32).tobytes(), np.array([[int(np.sort(scores.ravel())[-5]), negatives.MOST]]).tobytes()) for k, a in enumerate(anchors)]
    group = negatives.Group(rows, False, 5)
    wanting = group.wanting(1, block.min(axis=0).astype(np.int32).tobytes(), block.max(axis=0).astype(np.int32).tobytes())
    assert set(np.flatnonzero((scores >= group.bar[:, None]).any(axis=1))) <= set(wanting.tolist()) and len(wanting) < 50
