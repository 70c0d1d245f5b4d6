"""LM scoring: proper probabilities, chunking, base score by brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from thermocline.llm import lm

TEXTS = ["The cat sat on the mat. " * 30, "a b c", "", " \n", "One-word", "x" * 5000 + " tail", "É été là " * 50]


def trained(texts, size=1 << 20):
    words = [lm.tokens(t) for t in texts]
    data = [b" ".join(w) + b"\n" for w in words]
    code = lm.Code(*lm._triples([b"\n\n" + d for d in data]))
    counts = lm.BitCounts(code)
    for w, d in zip(words, data):
        counts.add_text(w)
        counts.add(list(lm.chunks(d, size)))
    return code, counts.finish(), data


def test_code_is_prefix_free():
    r = np.random.default_rng(1)
    for paths in (lm.huffman(r.integers(0, 50, 256).tolist()), lm.huffman([0] * 256), lm.huffman([3, 1])):
        words = {"".join(str(b) for _, b in p) for p in paths}
        assert len(words) == len(paths) and abs(sum(2.0 ** -len(w) for w in words) - 1) < 1e-12


def test_counts_do_not_depend_on_chunks():
    _, whole, _ = trained(TEXTS)
    _, cut, _ = trained(TEXTS, 97)
    assert all((a == b).all() for a, b in zip(whole.tables, cut.tables))


def test_counts_are_those_of_every_bit():
    code, counts, data = trained(TEXTS)
    tables = [np.zeros_like(t) for t in counts.tables]
    contexts = lm.Contexts()
    for d in data:
        raw, starts, _ = lm.joined([(d, 0)])
        before, hashed = contexts(raw, starts)
        n, at = code.spell(before, raw)
        for table, context, bits in zip(tables, hashed, lm.TABLE_BITS):
            slot = 2 * lm._slots(context, n, code.node[at], bits) + code.bit[at]
            np.add.at(table, slot, np.int32(1))
    assert all((a == b).all() for a, b in zip(counts.tables, tables))


@pytest.mark.parametrize("share", [0.6, 0.02, 0.0005, 1.0])
def test_blobs_are_exact_and_small(share):
    """What a task sends of a segment: mostly two bytes a slot, wide counts
    and far slots included."""
    r = np.random.default_rng(5)
    used = np.flatnonzero(r.random(lm.SEGMENT) < share)
    used = np.union1d(used, [0, 255, 256, 65535])
    zeros, ones = r.integers(0, 8, (2, len(used)))
    for most in (14, 15, (1 << 32) - 1, 1 << 32, 1 << 40):
        zeros[1], ones[-1] = most, most
        blob = lm._blob(3, 1, used, zeros, ones)
        got = lm._unblob(*(blob.column(c)[0].as_py() for c in ("gaps", "small", "large")))
        assert all((x == y).all() and len(x) == len(y) for x, y in zip(got, (used, zeros, ones)))
        assert blob.nbytes < 2 * len(used) + 512


def test_a_task_sends_each_triple_once():
    texts = ["".join(f"{i * 7919 % 9973} " for i in range(n, n + 150_000)) for n in (0, 5, 9)]
    out = pa.Table.from_batches(lm._count_tokens([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])]))
    kind, key, n = (c.to_numpy() for c in out.columns)
    assert len(set(key[kind == 1])) == (kind == 1).sum()
    assert n[kind == 1].sum() == sum(len(b" ".join(lm.tokens(t))) + 1 for t in texts)


@pytest.mark.parametrize("prefix", [b"", b"the c", b"q\xc3", b"the cat sat on the mat. " * 40])
def test_next_byte_probabilities_sum_to_one(prefix):
    code, counts, _ = trained(TEXTS)
    mixer = lm.Mixer(code, [lm.logit_bytes(t[0::2], t[1::2]) for t in counts.tables])
    texts = [prefix + bytes([b]) for b in range(256)]
    longer = mixer.bits(texts)
    base = mixer.bits([prefix])[0] if prefix else 0
    # a prefix that ends a block is learned before the next byte is read
    assert abs((2.0 ** -(longer - base)).sum() - 1) < 1e-3


def test_lanes_do_not_mix():
    code, counts, data = trained(TEXTS)
    mixer = lm.Mixer(code, [lm.logit_bytes(t[0::2], t[1::2]) for t in counts.tables])
    alone = [mixer.bits([d])[0] for d in data]
    assert np.allclose(mixer.bits(data), alone, rtol=1e-5)


@pytest.mark.parametrize("head", [lm.HEAD, 3, 0])
def test_score(spark, head):
    r = random.Random(1)
    vocabulary = ["alpha", "Beta", "gamma.", "delta", "épsilon", "ZETA", "eta", "theta"]
    rows = [(i, " ".join(r.choices(vocabulary, [32, 16, 8, 4, 2, 1, 1, 1], k=r.randint(0, 80))), 0.0, "x")
            for i in range(120)]
    rows += [(None, "alpha nameless", 0.0, "x"), (500, None, 0.0, "x"), (500, None, 0.0, "x"), (2, "unheard of", 0.0, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double, held_out string").repartition(3)
    got = lm.score(df, head).toPandas()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    counts = Counter()
    for d, t, *_ in rows:
        if not held(d):
            counts.update([*lm.tokens(t), b"\n"])
    n, v = sum(counts.values()), len(counts)
    want = sorted((-1 if d is None else d, held(d), len(lm.tokens(t)) + 1,
                   sum(counts[w] > 0 for w in [*lm.tokens(t), b"\n"]), n,
                   round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*lm.tokens(t), b"\n"]), 6))
                  for d, t, *_ in rows)
    cols = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    have = sorted(zip(got.doc_id.fillna(-1).astype(int), got.held_out, got.n_tokens, got.n_known, got.train_tokens,
                      got.base_score.round(6)))
    assert np.allclose(np.array(want, float), np.array(have, float)), cols
    assert (got.score < 0).all()


def test_held_out_texts_are_likelier_than_by_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = lm.score(docs).filter("held_out").agg({"score": "sum", "base_score": "sum", "n_tokens": "sum"}).first()
    print("held out", got)
    assert got["sum(score)"] > got["sum(base_score)"]
    assert -got["sum(score)"] / got["sum(n_tokens)"] * math.log2(10) < 15  # bits a token


def test_empty(spark):
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
