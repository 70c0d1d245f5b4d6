"""Quality rules: features by brute force, order of the cascade, verdicts."""

import random
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from thermocline.llm import rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(8)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": len(words) < 20 or 100 * len(covered) > 30 * len(words)}


def texts():
    r = random.Random(4)
    out = [None, "", " \n\t ", "one", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 50, "é日本🙂 " * 30,
           "line one here\n\nline one here\r\nline one here\n \n", "nbsp stays one", "a\x1cb c\x0bd\x0ce",
           "### $$$ %%% " * 20, "UPPER CASE WORDS ONLY " * 12, "long tail " + "w%d " * 5 % (1, 2, 3, 4, 5)]
    for _ in range(120):
        vocabulary = [f"w{i}" for i in range(r.choice([2, 5, 40, 400]))]
        words = r.choices(vocabulary, k=r.choice([5, 19, 20, 30, 80, 300]))
        if r.random() < .4 and len(words) > 12:
            at = r.randrange(len(words) - 10)
            words += ["gap"] * r.randint(0, 3) + words[at:at + r.randint(6, 12)]
        out.append(r.choice([" ", "\n", "  "]).join(words))
    return out


def test_features_and_base_verdict(spark):
    rows = [(i if i != 5 else None, t, "clash", "x") for i, t in enumerate(texts())] + [(0, None, "clash", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words string").repartition(3)
    got = rules.audited(df)
    assert [t for c, t in got.dtypes if c in rules.RETURNED] == ["bigint"] * len(rules.RETURNED)
    have = sorted(tuple(str(r[c]) for c in ["doc_id", *brute("")]) for r in got.collect())
    want = sorted((str(d), *map(str, brute(t).values())) for d, t, *_ in rows)
    assert have == want
    assert all(not r.kept for r in got.collect() if r.base_failed)


def test_every_feature_of_every_row(spark):
    """Also those of rows that an early rule rejects."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id long, text string").repartition(3)
    got = rules.audited(df)
    assert got.columns == ["doc_id", *rules.FEATURES, "base_failed", "kept"]
    for r in got.collect():
        text = texts()[r.doc_id] or ""
        kinds = [unicodedata.category(c) for c in text]
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_upper, r.n_letters, r.n_lines) == (kinds.count("Lu"), sum(k[0] == "L" for k in kinds), len(lines))


def test_verdict_does_not_depend_on_the_order(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    kept = {r.doc_id for r in rules.audited(df).filter("kept").collect()}
    for ordered in (rules.RULES, rules.RULES[::-1]):
        case = rules.first_rejection(ordered, lambda r: r.over_text(F.col("text")))
        assert {r.doc_id for r in df.filter(case.isNull()).collect()} == kept
    out = rules.passing(df.withColumn("n_lines", F.lit("other")))
    assert out.columns == ["doc_id", "text", "n_lines"] and {r.doc_id for r in out.collect()} == kept
    # no Python on the way
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_rejected_rows_do_not_reach_later_features(spark):
    """A feature that fails on every text it sees is harmless behind rules
    that reject those rows, and is run for the row that is left."""
    fails = {**rules.FEATURES, "n_letters": lambda text: F.raise_error(F.concat(F.lit("ran: "), text)).cast("long")}
    capitals = next(r for r in rules.RULES if r.name == "capitals")
    ordered = [r for r in rules.RULES if r is not capitals] + [capitals]
    bad = ["few words", "a b c d e f g h " * 9, "x " * 40, "word### " * 30, "same line of words here\n" * 9, None]
    df = spark.createDataFrame(list(enumerate(bad)), "doc_id long, text string").repartition(2)
    assert [r.kept for r in rules.judged(df, ordered, fails).collect()] == [False] * len(bad)
    good = " ".join(f"word{i}" for i in range(40))
    with pytest.raises(Exception, match="ran: word0"):
        rules.judged(spark.createDataFrame([(1, good)], "doc_id long, text string"), ordered, fails).collect()


def test_very_long_text(spark):
    r = random.Random(8)
    text = " ".join(r.choices([f"w{i}" for i in range(50_000)], k=60_000)) + " same eight words stand here twice in it" * 2
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = rules.audited(df).first()
    assert all(got[c] == v for c, v in brute(text).items())


def test_order_is_by_rejections_per_cost():
    a, b, c = (rules.Rule(n, (), None) for n in "abc")
    patterns = [(frozenset("a"), 10), (frozenset("ab"), 50), (frozenset("c"), 20), (frozenset(), 100)]
    # b: 50 per 1; then a is left 10 per 4, c 20 per 5
    assert [r.name for r in rules.order_rules([a, b, c], {"a": 4.0, "b": 1.0, "c": 5.0}, patterns)] == ["b", "c", "a"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert rules.audited(df).count() == rules.passing(df).count() == 0


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    seen = rules.audited(docs).join(labels, "doc_id").filter("quality = 1 and not base_failed")
    total, kept = seen.agg(F.count("*"), F.count_if("kept")).first()
    assert kept >= 0.97 * total > 0


@pytest.mark.parametrize("name", [r.name for r in rules.RULES])
def test_each_rule_rejects_something(spark, name):
    bad = {"few_words": "three words only", "repeated_windows": "a b c d e f g h " * 9, "word_length": "x " * 40,
           "symbols": "word### " * 30, "duplicate_lines": "same line of words here\n" * 9, "capitals": "LOUD WORDS " * 15}
    rule = next(r for r in rules.RULES if r.name == name)
    assert spark.range(1).select(rule.over_text(F.lit(bad[name]))).first()[0]
