"""Phrase mining: brute-force counts over whole texts, collisions, odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from thermocline.llm import phrases


def brute(rows, longest=3, least=10, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {q for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
                  if 100 * a >= 50 * found[q := p[i:i + k]]}
        ranked = []
        for p, a in found.items():
            if p not in inside:
                score, _, left, right = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]])
                                            for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


def texts():
    r = random.Random(5)
    words = ["a", "B", "the", "New", "york", "é", "É", "l'eau", "x-y", "\x00", "no", "日本", "a.b", "ﬀ", "to"]
    marks = [" ", "  ", "\t", ". ", ",", "\n", "\x0b", " ", " ", "\xa0"]
    out = [("en", None), (None, ""), (None, "new york " * 30), ("en", "the " * 3000), ("fr", " \t\n.,"), ("", "a b " * 12)]
    for _ in range(400):
        out.append((r.choice(["en", "en", "fr", None]), "".join(r.choice(words) + r.choice(marks) for _ in range(r.randint(0, 60)))))
    return out + [out[40]] * 25  # repeated rows


@pytest.mark.parametrize("longest,least,top,stretch", [(3, 10, 2000, 16 << 20), (3, 10, 7, 700), (4, 3, 2000, 5000)])
def test_against_brute_force(spark, longest, least, top, stretch):
    rows = texts()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = sorted(map(tuple, phrases.collocations(docs, longest, least, top, stretch_bytes=stretch).collect()))
    assert got == brute(rows, longest, least, top)


def test_phrases_that_share_a_fingerprint_come_apart(spark, monkeypatch):
    """With fingerprints of two bits nearly all phrases collide."""
    rows = texts()[:200]
    monkeypatch.setattr(phrases, "mixed", lambda x: x & np.uint64(3))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = sorted(map(tuple, phrases.collocations(docs, 3, 5, stretch_bytes=900).collect()))
    assert got == brute(rows, 3, 5)


def test_many_buckets(spark, monkeypatch):
    rows = texts()
    monkeypatch.setattr(phrases, "BUCKET_BYTES", 1000)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    assert sorted(map(tuple, phrases.collocations(docs, stretch_bytes=4000).collect())) == brute(rows)


def test_products_pass_64_bits(spark):
    """a * a * 1000000 of 5,000,000 occurrences is over 2**63."""
    docs = spark.createDataFrame([("en", "u v " * 50_000)] * 100, "lang string, text string")
    got = {r.phrase: r for r in phrases.collocations(docs, longest=2).collect()}
    assert got["u v"].a == 5_000_000 and got["u v"].score == 10**6
    assert got["v u"].a == 4_999_900 and got["v u"].score == 10**6 * 4_999_900**2 // 5_000_000**2


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(docs).collect() == []
    rows = [("en", "p q r. " * 11)]
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3.0) for r in rows],
                                 "lang string, text string, row int, phrase string, n int, score double")
    assert sorted(map(tuple, phrases.collocations(docs).collect())) == brute(rows)


def test_one_prefix_polynomial_hashes_every_span():
    values = np.arange(1, 50, dtype=np.uint64) * np.uint64(7)
    twice = np.r_[values, values]
    a = phrases.spans_hash(twice, np.arange(40), 5, phrases._BASE)
    b = phrases.spans_hash(twice, np.arange(40) + len(values), 5, phrases._BASE)
    assert (a == b).all() and len(set(a.tolist())) == 40
