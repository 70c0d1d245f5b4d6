"""License scans: base phrases by brute force, method labels on examples."""

import random
import re

import pytest

from thermocline.llm import licenses


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = sorted((i, k) for k, p in licenses.BASE.items() for i in range(len(words))
                    if words[i:i + len(p.split())] == p.split())
    return (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
            ",".join(sorted({k for _, k in places})))


CASES = [
    ("Text. Released under the MIT License.", "mit", 1.0),
    ("x\nLicensed under the Apache License, Version 2.0.", "apache", 1.0),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl", 1.0),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc", 1.0),
    ("mit license mit license", "mit", None),
    ("the apache licence", "", 0.0),
    ("mit and some license", "", 0.0),
    ("nothing at all", "", 0.0), ("", "", 0.0), (None, "", 0.0), ("é MIT License É", "", 0.0),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd", None),
    (("word " * 9000) + "general public license", "gpl", None),
]


def test_cases(spark):
    r = random.Random(3)
    vocabulary = ["mit", "license", "General", "public", "apache", "x", "Licensed", "under", "cc", "by", "nc"]
    cases = CASES + [(" ".join(r.choice(vocabulary) for _ in range(r.randint(0, 40))), None, None) for _ in range(80)]
    rows = [(i if i != 3 else None, t, "clash", 2.0) for i, (t, *_) in enumerate(cases)] + [(0, cases[0][0], "", 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string, score double").repartition(3)
    got = licenses.scan_licenses(df).collect()
    assert len(got) == len(rows)
    assert sorted(map(str, got)).count(str(next(g for g in got if g.doc_id == 0))) == 2
    for g in got:
        i = 3 if g.doc_id is None else g.doc_id
        text, labels, score = cases[i]
        assert (g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) == brute(text), text
        assert set(filter(None, g.base_labels.split(","))) <= set(g.labels.split(","))
        assert 0 <= g.score <= 1
        if labels is not None:
            assert g.labels == labels, (text, g)
        if score is not None:
            assert g.score == score, (text, g)


def brute_labels(text):
    """(labels, score) by every mandatory phrase at every word."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words, labels, score = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low), set(filter(None, brute(text)[4].split(","))), 0.0
    for label, phrases, template in licenses.TEMPLATES:
        own = template.split()
        for p in (x.split() for x in phrases):
            for i in (i for i in range(len(own)) if own[i:i + len(p)] == p):
                for start in (k - i for k in range(len(words)) if words[k:k + len(p)] == p):
                    labels.add(label)
                    score = max(score, sum(0 <= start + j < len(words) and words[start + j] == w
                                           for j, w in enumerate(own)) / len(own))
    return ",".join(sorted(labels)), score


def test_many_licence_words_against_brute_force(spark):
    text = {name: [t for label, _, t in licenses.TEMPLATES if label == name] for name, *_ in licenses.TEMPLATES}
    prose = "a person may use and copy free files as published by the foundation charge fee source forms data "
    texts = [". ".join(t for _, _, t in licenses.TEMPLATES), text["mit"][2] + ". licensed under cc by 4 0",
             ". ".join(text[x][0] for x in ("bsd", "mpl", "isc", "lgpl")), prose * 40 + text["cc-by-nd"][0] + prose * 40,
             " ".join(licenses.vocabulary()) + " x the mit license"]
    r = random.Random(11)
    texts += [" x ".join([prose, *r.sample([t for _, _, t in licenses.TEMPLATES], r.randint(1, 9))]) for _ in range(20)]
    texts += [" ".join(r.choices(licenses.vocabulary() + ["by", "to", "of", "the"], k=400)) for _ in range(5)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {g.doc_id: (g.labels, g.score) for g in licenses.scan_licenses(df).collect()}
    for i, t in enumerate(texts):
        assert got[i][0] == brute_labels(t)[0] and abs(got[i][1] - brute_labels(t)[1]) < 1e-12, t
    assert set(got[0][0].split(",")) == set(text)
    assert got[1][0] == "cc-by,mit"


def test_two_rarest_words_are_looked_up(spark):
    rows = ["this program is free software under the terms of the gnu general public license"] + ["terms of the public"] * 9
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    files = licenses._scanned(df, licenses.TEMPLATES)
    few, all_words = (licenses.candidates(files, rare=n) for n in (2, 99))
    assert 0 < few.count() <= all_words.count()
    seen = [{(r.uid, r.label, r.score) for r in licenses.verified(files, c).collect()} for c in (few, all_words)]
    assert seen[0] == seen[1] and {x[1] for x in seen[0]} >= {"gpl"}


def test_every_phrase_is_searched(spark):
    for label, phrases, text in licenses.TEMPLATES:
        assert all(f" {p} " in f" {text} " for p in phrases), label
    texts = ["Provided as is, without warranty of any kind.", "licensed under CC BY 3.0", "under the zed terms", "zed"]
    more = [*licenses.TEMPLATES, ("zed", ["the zed"], "under the zed terms")]  # one indexed word
    got = {g.doc_id: (g.labels, g.score) for g in licenses.scan_licenses(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), more).collect()}
    assert [got[i][0] for i in range(4)] == ["mit", "cc-by", "zed", ""] and got[1][1] == got[2][1] == 1.0
    for bad in (("x", ["not there"], "some text"), ("x", ["of the"], "all of the text")):
        with pytest.raises(ValueError):
            licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string"), [bad])


def test_empty(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert licenses.scan_licenses(spark.createDataFrame([(1, "plain")], "doc_id long, text string")).count() == 1
