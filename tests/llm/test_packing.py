"""Packing: exact ids, gapless pieces, Karmarkar-Karp properties."""

import random
import zlib

import numpy as np
import pytest

from thermocline.llm import packing

TEXTS = ["Hello World á e ́x ΑΣ ΑΣ. İ\tx <|endoftext|> it's 's   z\x1c y\x85k WORD!! can't. don'T x'S É. ÉA!! ab|c| .. !",
         "  ", " ", "x  y\r\n\x0bz İstanbul. ǅ. ª. x².", "ascii a\x1cb c\x1f d\x00", "", "THE The the. THE!!", "a" * 5000,
         "日本語 テキスト。 🙂🙂"]


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.tokenizer_path())


def test_ids_word_by_word_equal_ids_of_whole_texts(tok):
    words = packing.WordIds(packing.tokenizer_path())
    for t, data in zip(TEXTS, words.texts(TEXTS)):
        assert np.frombuffer(data, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_special_tokens_in_texts(tok):
    end, start = "<|endoftext|>", "<|startoftext|>"
    texts = [f"x {end} y", end, f"{start}{end}", f"a{end}b {end}!! ok.{end} {end}. don{end}'t", f"É{start}́ e{end}ΑΣ{end}.",
             f"<|ENDOFTEXT|> < |endoftext|> <|endoftext |> <|endof{end}text|>", f"{end}\n\t{start}\x0b1{end}2", f"|{end}|<{start}>",
             "<|endoftext|", f"İ{end}ǅ 日本{start}語 {end}🙂"]
    r = random.Random(6)
    bits = [end, start, " ", "  ", "\n", "a", "É", "é", "́", "The", "'s", ".", "!!", "<|", "|>", "Σ", "7", "🙂"]
    texts += ["".join(r.choices(bits, k=r.randint(1, 30))) for _ in range(500)]
    words = packing.WordIds(packing.tokenizer_path())
    got = [np.frombuffer(data, "<u4").tolist() for data in words.texts(texts)]
    assert got[0] == [343, 49407, 344]
    for t, ids in zip(texts, got):
        assert ids == tok.encode(t, add_special_tokens=False).ids, t


def test_differencing():
    # the textbook example ends with sums 16 and 14
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in s) for s in packing.differencing([8, 7, 6, 5, 4], 2)) == [14, 16]
    r = random.Random(4)
    for _ in range(50):
        sizes = [r.randint(1, 512) for _ in range(r.randint(0, 200))]
        m = r.randint(1, 40)
        sets = packing.differencing(sizes, m)
        assert len(sets) == m or not sizes
        assert sorted(i for s in sets for i in s) == list(range(len(sizes)))
        sums = [sum(sizes[i] for i in s) for s in sets]
        if len(sizes) > 8 * m:
            assert max(sums) - min(sums) <= max(sizes) // 4
        w = packing.windows(sizes)
        assert all(sum(sizes[i] for i in s) <= 2048 for s in w)


def test_pack(spark, tok):
    r = random.Random(2)
    texts = TEXTS + [None] + [" ".join(r.choice(["alpha", "beta", "gamma."]) for _ in range(r.choice([3, 300, 2046, 2047, 9000])))
                              for _ in range(60)]
    rows = [(i if i != 3 else None, t, "clash", 1) for i, t in enumerate(texts)] + [(5, texts[5], "clash", 1)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, offset string, ids int").repartition(3)
    got = packing.pack(df, with_ids=True).toPandas()
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    assert (got.length > 0).all() and (got.groupby("sequence_id").length.sum() <= 2048).all()
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == np.r_[0, s.length.cumsum()[:-1]].tolist()
    for d in set(range(len(texts))) - {3, 5}:
        p = got[got.doc_id == d].sort_values("start")
        assert [x for part in p.ids for x in part] == ids[d]
        assert (p.doc_tokens == len(ids[d])).all() and p.start.tolist() == np.r_[0, p.length.cumsum()[:-1]].tolist()
        for _, row in p.iterrows():
            assert row.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
    assert got[got.doc_id.isna()].length.sum() == len(ids[3])
    assert got[got.doc_id == 5].length.sum() == 3 * len(ids[5])
    assert packing.pack(df.limit(0)).count() == 0


def test_little_padding():
    r = random.Random(1)
    sizes = []
    while len(sizes) < packing.BATCH:
        sizes += [n for _, n in packing.cut(int(r.lognormvariate(6.8, 1)) + 1) if n < packing.WINDOW]
    assert sum(sizes) / packing.WINDOW / len(packing.windows(sizes)) > 0.97


def test_slices_by_bytes():
    import pyarrow as pa

    from thermocline.llm.common import by_bytes
    texts = ["a" * 10, None, "", "b" * 100, "é" * 3, None, "c" * 5, "d" * 5]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    got = [part.column(0).to_pylist() for part in by_bytes(batch, 0, 16)]
    assert sum(got, []) == texts and all(len(g) == 1 or sum(len((t or "").encode()) for t in g) <= 16 for g in got)
    assert list(by_bytes(batch.slice(0, 0), 0, 16)) == []
