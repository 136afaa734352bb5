"""Tables that hold columns named like everything an operator uses inside or gives out keep all the others."""

import pytest
from pyspark.sql import functions as F

from meltemi.llm import langid, line_dedup, packing, pii, quality, sentencepiece_bpe, suffix_dedup, toxicity
from meltemi.llm.common import tokenizer_path
from tests.llm.conftest import words

INSIDE = ["key", "_key", "_Body", "_name", "_whole", "name", "t", "_t", "_text", "_text_", "_common", "text_", "_row", "_shard", "_last", "block",
          "bucket", "hi", "lo", "copies", "batch", "_n", "root", "node", "own", "body", "_quality_text", "_lang_text", "_piece_text", "_toxic_text"]

OPERATORS = {
    "toxicity": (lambda d: toxicity.score(d, toxicity.train([b"fine words", b"awful words"] * 20, __import__("numpy").array([0, 1] * 20), ["en"] * 40, epochs=1)), {"score", "rejected"}),
    "sentencepiece": (lambda d: sentencepiece_bpe.encode(d, tokenizer_path("piece_bpe_32k.model")), {"ids"}),
    "quality": (quality.judge, {*(c.split()[0] for c in quality.COLUMNS.split(", ")), "base_failed", "kept"}),
    "language": (lambda d: langid.predict(d, None), {"lang_pred", "score", "ambiguous"}),
    "suffix bytes": (lambda d: suffix_dedup.remove_repeats(d, 30), {"n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"}),
    "suffix words": (lambda d: suffix_dedup.remove_repeats(d, 8, unit="words"), {"n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"}),
    "lines": (line_dedup.drop_common_lines, set(line_dedup.OUTPUT)),
    "packing": (lambda d: packing.pack(d, 2048, 20), {"sequence_id", "offset"}),
    "pii": (lambda d: pii.find(d, pii.fit(copies=1)), set(pii.OUTPUT)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_other_columns_come_back_unchanged(spark, name):
    run, outputs = OPERATORS[name]
    rows = [(k, words(k % 20, 20), k % 50 + 1) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length long")
    names = sorted({*INSIDE, *outputs})
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in names})
    got = run(docs)
    others = [c for c in docs.columns if c not in outputs]
    assert len(set(got.columns)) == len(got.columns) and set(got.columns) == {*others, *outputs}
    assert sorted(map(tuple, got.select(*others).collect())) == sorted(map(tuple, docs.select(*others).collect()))
