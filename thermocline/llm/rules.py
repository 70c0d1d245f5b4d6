"""Quality rules (operator 1): a short-circuit cascade in DataFrame
expressions only.

Each rule rejects a document by an expression over features of its text.  The
cost (seconds) and the selectivity (share rejected) of every rule are measured
on a bounded sample; rules then run in the order of rejections per cost among
what earlier rules left over, as branches of one CASE that stops at the first
rejection.  The order changes the work, never the verdict.

``audited`` returns every feature of every row, so its CASE runs over finished
columns.  ``passing`` and, for features that are not returned, ``judged``
compute a feature inside the CASE, for the rows that reach its rule.

Features: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (words
inside 8-word windows that occur twice or more in the text; windows are
compared by a 64-bit hash), n_upper (A-Z and other upper-case letters),
n_letters, n_lines.

Defined results: a null or empty text has no words and is rejected; null ids,
repeated rows and further columns pass through; an empty table gives an empty
result; a very long text is one row of one task, its windows sorted there."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_or_null, let, words_of

WINDOW = 8
#: Rows of the sample that costs and selectivities are measured on.
SAMPLE_ROWS = 2000
_SYMBOLS = "#*$%&|<>"


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def n_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(_text(text), " \t\n\x0b\x0c\r", "")).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.length(_text(text)) - F.length(F.translate(_text(text), _SYMBOLS, ""))).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(_text(text), "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def n_lines(text: Column) -> Column:
    return F.size(_lines(text)).cast("long")


def n_dup_lines(text: Column) -> Column:
    return let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_upper(text: Column) -> Column:
    return F.length(F.regexp_replace(_text(text), r"[^\p{Lu}]+", "")).cast("long")


def n_letters(text: Column) -> Column:
    return F.length(F.regexp_replace(_text(text), r"[^\p{L}]+", "")).cast("long")


def _windows(words: Column) -> Column:
    """64-bit hashes of all WINDOW-word windows, by doubling: a hash of two
    neighbours covers twice the words."""
    def double(step: int):
        return lambda h: F.zip_with(F.slice(h, F.lit(1), F.size(h) - step),
                                    F.slice(h, F.lit(1 + step), F.size(h) - step),
                                    lambda x, y: F.xxhash64(x, y))
    one = F.transform(words, lambda w: F.xxhash64(w))
    return let(let(let(one, double(1)), double(2)), double(4))


def _covered(windows: Column) -> Column:
    """Words covered by windows whose hash occurs again."""
    def starts(pairs):  # of windows equal to the next one in hash order
        same = F.zip_with(F.slice(pairs, F.lit(1), F.size(pairs) - 1), F.slice(pairs, 2, F.size(pairs)),
                          lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
        return F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))

    def cover(at):
        steps = F.zip_with(F.slice(at, F.lit(1), F.size(at) - 1), F.slice(at, 2, F.size(at)),
                           lambda a, b: F.least(b - a, F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(WINDOW), lambda acc, x: acc + x)

    indexed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return let(let(F.array_sort(indexed), starts), cover)


def n_repeat_words(text: Column, words: Column | None = None) -> Column:
    def count(windows):
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_covered(windows))

    return let(words_of(text) if words is None else words, lambda w: F.when(
        F.size(w) <= WINDOW, F.lit(0)).otherwise(let(_windows(w), count))).cast("long")


FEATURES = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
            "n_repeat_words": n_repeat_words, "n_upper": n_upper, "n_letters": n_letters, "n_lines": n_lines}
#: Features of the contract, those that ``judged`` returns if not told otherwise.
RETURNED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Rejects a document when ``rejects`` holds; it gets a function that
    gives the column of a feature, and uses those of ``needs`` only."""
    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Callable[[str], Column]], Column]
    base: bool = False

    def over_text(self, text: Column) -> Column:
        """The rule as an expression over the text alone."""
        values = F.struct(*[FEATURES[f](text).alias(f) for f in self.needs])
        return let(values, lambda v: self.rejects(lambda f: v[f]))


RULES = (
    Rule("few_words", ("n_words",), lambda f: f("n_words") < 20, base=True),
    Rule("repeated_windows", ("n_repeat_words", "n_words"),
         lambda f: 100 * f("n_repeat_words") > 30 * f("n_words"), base=True),
    Rule("word_length", ("word_chars", "n_words"),
         lambda f: (f("word_chars") < 2 * f("n_words")) | (f("word_chars") > 15 * f("n_words"))),
    Rule("symbols", ("n_symbols", "n_words"), lambda f: 10 * f("n_symbols") > 3 * f("n_words")),
    Rule("duplicate_lines", ("n_dup_lines", "n_lines"), lambda f: 10 * f("n_dup_lines") > 3 * f("n_lines")),
    Rule("capitals", ("n_upper", "n_letters"), lambda f: 2 * f("n_upper") > f("n_letters")),
)


def measure(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> tuple[dict[str, float], list[tuple]]:
    """Seconds per rule, and (rejecting rules, rows) patterns, on a sample of
    about, and at most, ``sample_rows`` rows drawn over the whole table; a task
    sends on no more than its share of them."""
    texts = columns_or_null(docs, text="string")
    share = min(1.0, sample_rows / max(texts.count(), 1))
    sample = texts.sample(share, seed=7).limit(sample_rows).persist()
    try:
        rows = sample.count()
        costs = {}
        for rule in rules:
            began = time.perf_counter()
            sample.agg(F.count_if(rule.over_text(F.col("text")))).collect()
            costs[rule.name] = (time.perf_counter() - began) if rows else 1.0
        flags = F.concat_ws(",", *[F.when(r.over_text(F.col("text")), r.name) for r in rules])
        patterns = [(frozenset(p.split(",")) - {""}, n) for p, n in
                    sample.groupBy(flags.alias("p")).count().collect()]
    finally:
        sample.unpersist()
    return costs, patterns


def order_rules(rules, costs: dict[str, float], patterns: list[tuple]) -> list[Rule]:
    """Greedy: next comes the rule with the most rejections per second among
    the sample rows that no earlier rule rejects; ties by cost, then name."""
    left, out, patterns = list(rules), [], list(patterns)
    while left:
        best = min(left, key=lambda r: (-sum(n for p, n in patterns if r.name in p) / max(costs[r.name], 1e-9),
                                        costs[r.name], r.name))
        out.append(best)
        left.remove(best)
        patterns = [(p, n) for p, n in patterns if best.name not in p]
    return out


def planned(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    return order_rules(rules, *measure(docs, rules, sample_rows))


def first_rejection(ordered, reject) -> Column:
    """Name of the first rule that rejects, null if none does; later branches
    are not evaluated.  ``reject`` maps a rule to its condition."""
    case = None
    for rule in ordered:
        case = F.when(reject(rule), F.lit(rule.name)) if case is None else case.when(reject(rule), F.lit(rule.name))
    return case


def passing(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows that no rule rejects, with their columns; one pass, no
    shuffle."""
    ordered = planned(docs, rules, sample_rows)
    return docs.filter(first_rejection(ordered, lambda r: r.over_text(F.col("text"))).isNull())


def audited(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, every feature, ``base_failed`` and ``kept`` of all rows."""
    return judged(docs, planned(docs, rules, sample_rows), returned=tuple(FEATURES))


def judged(docs: DataFrame, ordered: list[Rule], features=FEATURES, returned=RETURNED) -> DataFrame:
    """``audited`` with the rules in a given order and the features that are
    returned."""
    text = F.col("text")
    out = columns_or_null(docs, doc_id="long", text="string").withColumn("words", words_of(text))
    out = out.select("doc_id", "text", *[
        (F.size("words").cast("long") if f == "n_words" else
         n_repeat_words(text, F.col("words")) if f == "n_repeat_words" else features[f](text)).alias(f)
        for f in returned])

    def rejects(rule):
        return rule.rejects(lambda f: F.col(f) if f in returned else features[f](text))
    base = [r for r in ordered if r.base]
    failed = F.lit(False) if not base else first_rejection(base, rejects).isNotNull()
    # a row that fails the base is rejected before any rule of the method
    rest = first_rejection([r for r in ordered if not r.base], rejects)
    out = out.withColumn("base_failed", failed)
    kept = ~F.col("base_failed") if rest is None else F.when(F.col("base_failed"), False).otherwise(rest.isNull())
    return out.withColumn("kept", kept).drop("text")
