"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from thermocline.llm import simhash


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(codes, most):
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(codes)):
        for j in range(i):
            if bin(codes[i] ^ codes[j]).count("1") <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def chains(seed, n=300):
    """Codes with many at small distances, some in one dense ball."""
    r = random.Random(seed)
    out = [0, r.getrandbits(64)]
    while len(out) < n:
        c = r.choice(out[:20] if r.random() < .5 else out)
        for _ in range(r.choice([1, 2, 4, 5, 9])):
            c ^= 1 << r.randrange(64)
        out.append(c if r.random() < .9 else r.getrandbits(64))
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("text", [None, "", " \n ", "One", "a b c", "a b c d e A B C D", "É é\x0bx y Z " * 40])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_gray_rank_neighbours_differ_in_one_bit():
    codes = np.arange(1 << 10, dtype=np.uint64)
    order = codes[np.argsort(simhash.gray_rank(codes))]
    assert set(np.bitwise_count(order[1:] ^ order[:-1]).tolist()) == {1}


@pytest.mark.parametrize("seed", range(3))
def test_index_finds_every_link(seed):
    codes = np.array(chains(seed), np.uint64)
    for node in (np.zeros(len(codes), np.int64), (codes % np.uint64(7)).astype(np.int64)):
        index = simhash.GrayIndex(node, codes)
        got = {tuple(sorted((int(index.order[i]), int(index.order[j]))))
               for a, b in index.links(4, chunk=64) for i, j in zip(a, b)}
        want = {(i, j) for j in range(len(codes)) for i in range(j)
                if node[i] == node[j] and bin(int(codes[i] ^ codes[j])).count("1") <= 4}
        assert got == want


@pytest.mark.parametrize("limit", [50_000, 20])
def test_links_connect_what_brute_force_connects(spark, limit):
    codes = chains(9, 150)
    df = spark.createDataFrame([(simhash._signed(c),) for c in codes], "code long")
    found = {r.node: r.root for r in simhash.components(simhash.links(df, 4, limit)).collect()}
    want = brute_classes(codes, 4)
    groups = {}
    for c, w in zip(codes, want):
        s = simhash._signed(c)
        groups.setdefault(w, set()).add(found.get(s, s))
    assert all(len(g) == 1 for g in groups.values())
    assert len(set().union(*groups.values())) == len(groups)


def test_documents(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 30
    rows = [(5, base), (3, base), (3, base), (None, base), (9, base + "nu"), (1, None), (2, ""), (None, "only nameless"),
            (8, "short"), (7, "SHORT")]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows],
                               "doc_id long, text string, code int, component_id string")
    got = sorted(simhash.near_duplicates(df).collect(), key=str)
    codes = [brute_fingerprint(t) for _, t in rows]
    classes = brute_classes(codes, 4)
    want = []
    for i, (d, t) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if classes[j] == classes[i] and rows[j][0] is not None]
        want.append((d, simhash._signed(codes[i]), min(ids, default=None)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    # by brute force: the row of each class's smallest id, once; classes without an id keep one row
    best = {(d, t) for (d, t), w in zip(rows, want) if d == w[2]}
    assert {(1, None), (3, base), (7, "SHORT"), (None, "only nameless")} <= best
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(best, key=str)
    assert simhash.near_duplicates(df.filter(F.lit(False))).count() == 0
    assert simhash.one_of_each(df.filter(F.lit(False))).count() == 0


def test_one_row_of_each_class_with_odd_ids(spark):
    base = " ".join(f"word{i}" for i in range(900))
    near = next(x for x in (f"{base} more{i}" for i in range(99))
                if 0 < bin(brute_fingerprint(base) ^ brute_fingerprint(x)).count("1") <= 4)
    other = "one two three four five six seven " * 40
    rows = [(None, base), (None, near), (None, near), (7, other), (7, "a text of its own and of no other class"),
            (7, other), (8, other), (None, None), (None, "")]
    df = spark.createDataFrame([(d, t, "x", i) for i, (d, t) in enumerate(rows)],
                               "doc_id long, text string, root string, code int").repartition(4)
    got = sorted(((r.doc_id, r.text) for r in simhash.one_of_each(df).collect()), key=str)
    codes = [brute_fingerprint(t) for _, t in rows]
    best = {}
    for (d, t), code, c in zip(rows, codes, brute_classes(codes, 4)):
        key = (d is None, d or 0, simhash._signed(code), t is not None, t or "")
        best[c] = min(best.get(c, (key, (d, t))), (key, (d, t)), key=lambda x: x[0])
    assert len(best) == 4 and got == sorted((x for _, x in best.values()), key=str)


def test_very_long_text(spark):
    words = [f"w{i % 9173}" for i in range(200_000)]
    assert simhash.fingerprint(" ".join(words)) == brute_fingerprint(" ".join(words))
