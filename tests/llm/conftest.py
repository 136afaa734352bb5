import random

import pytest

#: Texts with the odd cases every operator must take: null, empty, blank, ties, repeats, not ASCII, very long.
ODD = [
    None, "", " \n\t ", "a", "The same text here twice over.", "The same text here twice over.", "Ünïcödé wörds — 日本語 😀",
    "x" * 5000, "no letters 123 !!", "123 456", "line\n\nline\nLINE \n other", "\n", "\x00\x01 control", "é combining",
]


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeéü") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture()
def odd_docs(spark):
    """ODD and longer texts under ids that are null, repeated and negative, with columns named like outputs."""
    long = words(1, 30000)
    texts = [*ODD, long, long, long[:40000] + words(2, 100), words(3, 400), words(3, 400) + " tail", words(4, 60)]
    ids = [None, -5, 7, 7, *range(100, 100 + len(texts) - 4)]
    rows = [(i, t, ["en", None, "de"][k % 3], "src", 1, f"fp{k}", k, "old") for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, fp string, score int, kept_text string")


@pytest.fixture()
def no_docs(odd_docs):
    return odd_docs.limit(0)
