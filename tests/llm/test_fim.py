"""Fill-in-the-middle: the wavelet matrix against plain counting, the cuts and
forms against code that works on decoded text."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermocline.llm import fim


def units_of(text, unit):
    """First places of the units of a text, in code points."""
    if unit == "char":
        return list(range(len(text)))
    if unit == "word":
        return [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    return [i for i in range(len(text)) if i == 0 or text[i - 1] == "\n"]


def brute(doc_id, text, unit="char", seed=1):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    places = units_of(text, unit)
    n = len(places)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, y = (0 if k == 0 else (places + [len(text)])[k] for k in (a, b))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, "<S>" + text[y:] + "<P>" + text[:x] + "<M>" + text[x:y]
    return doc_id, n, "psm", a, b - a, "<P>" + text[:x] + "<S>" + text[y:] + "<M>" + text[x:y]


def texts():
    r = random.Random(8)
    bits = ["a", "Zz", "é", "日", "😀", "́", " ", "  ", "\n", "\t", "<", "P>", "<P", "<S", "M", ">", "word", "\x00", "\\Q", "$1"]
    out = [None, "", "a", "😀", "<P>", "x<S>y", "<<M>>", "<P", "\n", " ", "é" * 70, "ab " * 40_000, "日本\n" * 30_000, "<P<S<M"]
    return out + ["".join(r.choices(bits, k=r.randint(1, 50))) for _ in range(500)]


def test_ranks_and_cuts_of_the_matrix():
    r = np.random.default_rng(2)
    for size in (0, 1, 63, 64, 65, 1000):
        classes = r.integers(0, 5, size).astype(np.uint8)
        m = fim.WaveletMatrix(classes)
        at = np.arange(size + 1)
        for kind in range(5):
            assert m.rank(kind, at).tolist() == np.r_[0, np.cumsum(classes == kind)].tolist()
        assert m.boundaries((1, 2, 3, 4), at).tolist() == np.r_[0, np.cumsum(classes > 0)].tolist()


@pytest.mark.parametrize("unit", ["char", "word", "line"])
@pytest.mark.parametrize("limit", [fim.BATCH_BYTES, 100])
def test_against_decoded_text(spark, monkeypatch, unit, limit):
    monkeypatch.setattr(fim, "BATCH_BYTES", limit)
    rows = list(enumerate(texts())) + [(None, "a null id"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(*r, "c", 5) for r in rows], "doc_id long, text string, form string, n int").repartition(3)
    made = fim.fill_in_middle(docs, unit)
    assert sorted(map(tuple, made.collect()), key=str) == sorted((brute(i, t, unit) for i, t in rows), key=str)
    back = made.select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)


def test_parameters_and_empty_table(spark):
    docs = spark.createDataFrame([(i, "some text here") for i in range(300)], "doc_id long, text string")
    assert {r.form for r in fim.fill_in_middle(docs, plain_percent=0, spm_percent=100).collect()} == {"spm"}
    marks = ("[a]", "[b]", "[c].*")
    made = fim.fill_in_middle(docs, sentinels=marks, plain_percent=0)
    assert all(r.output.count("[c].*") == 1 for r in made.collect())
    assert {r[0] for r in made.select(fim.restored(F.col("output"), F.col("form"), marks)).collect()} == {"some text here"}
    assert fim.fill_in_middle(docs.limit(0)).collect() == []
