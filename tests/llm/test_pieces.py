"""SentencePiece: N-best against brute force, exact round trip."""

import random
import zlib

import numpy as np
import pytest

from thermocline.llm import pieces, queries

TEXTS = ["Hello  world\n x", "", " ", "a\n\nb", "The quick brown fox, 'tis 42.", "naïve café Ünïcode ﬁ   x", "▁ mark ▁",
         "日本語のテキスト🙂", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "tab\tand\x00nul", "\n lead", "x" * 3000, "é end "]


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(pieces.model_path())


def brute(model, text):
    """All segmentations of a short text: (score, ids)."""
    if not text:
        return [(0.0, b"")]
    out = []
    for k in range(1, min(len(text), model.longest) + 1):
        edge = [model.ids[text[:k]]] if text[:k] in model.ids else []
        if not edge and k == 1:
            edge = [(model.spell(text[0]), model.spelled)]
        out += [(s + rest, c + tail) for c, s in edge for rest, tail in brute(model, text[k:])]
    return out


@pytest.mark.parametrize("text", ["the cat", "a  b", "then.", "é1x", "x\ny", "aaaaaaa", "▁a", "Zeta", "🙂a"])
def test_nbest_against_all_segmentations(model, text):
    every = sorted({s for s in brute(model, " " + text)}, key=lambda x: -x[0])
    coder = pieces.Encoder(pieces.model_path(), 6)
    got = coder.encode([text])[0]
    assert [s for s, _ in got] == [s for s, _ in every[:6]]
    assert len(set(got)) == len(got) and set(got) <= set(every)


def test_nbest_of_a_part(model):
    for part in ("there", "tion", "aaaaaa", "ing"):
        every = sorted((s for s, _ in brute(model, part)), reverse=True)
        assert [s for s, _ in model.nbest(part, 10)] == every[:10]


def test_parts_are_cut_at_pairs_without_a_piece(model):
    r = random.Random(5)
    for _ in range(3000):
        word = r.choice(["", " "]) + "".join(r.choices("abcjqxzvw.A'é", k=r.randint(1, 9)))
        parts = model.parts(word)
        assert "".join(parts) == word
        ends = {len("".join(parts[:k])) for k in range(1, len(parts))}
        assert ends == {i for i in range(1, len(word)) if word[i - 1:i + 1] not in model.pairs}


def test_parts_side_by_side_are_those_alone(model):
    r = random.Random(8)
    words = ["".join(r.choices("abcdeinrst é'.AT", k=r.randint(2, 64))) for _ in range(2000)]
    words += ["a" * k for k in range(2, 65)] + ["🙂a", "x🙂", " the", "日本語", "ing tion", "ﬁx"]
    parts = [p for w in words for p in model.parts(w) if len(p) > 1]
    assert len(parts) > 2000
    scores, leads, codes = model.best_of_many(parts)
    for part, score, lead, code in zip(parts, scores, leads, codes):
        want = model.best(part)
        assert (score, lead) == (want[0], want[2]) and code in (None, want[1])
        assert code is not None or any(c not in model.ids for c in part)


def test_long_parts_and_long_texts():
    coder, texts = pieces.Encoder(pieces.model_path()), ["a" * 20_000, "x " * 50_000, "the end. " * 30_000]
    for text, found in zip(texts, coder.encode(texts)):
        assert len(found) == 3 and all(coder.decode(c) == text for _, c in found)
        assert found[0][0] >= found[1][0] >= found[2][0]


def test_n_highest_sums():
    r = random.Random(1)
    for _ in range(30):
        lists = [[(x, b"") for x in sorted((r.randint(-20, 0) for _ in range(r.randint(1, 4))), reverse=True)]
                 for _ in range(r.randint(0, 4))]
        sums = [0]
        for x in lists:
            sums = [a + b for a in sums for b, _ in x]
        assert [s for s, _ in pieces.n_highest(lists, 5)] == sorted(sums, reverse=True)[:5]


def test_best_and_lead_are_those_of_the_search(model):
    r = random.Random(8)
    words = ["there", "tion", "aaaa", "ing", "x", "🙂", "日本"] + ["".join(r.choices("aeinrstho.,A", k=r.randint(1, 12)))
                                                             for _ in range(400)]
    for w in words:
        found, (score, codes, lead) = model.nbest(w, 2), model.best(w)
        assert (score, codes) == found[0]
        assert lead == (score - found[1][0] if len(found) > 1 else float("inf"))


def test_round_trip_and_tables(spark):
    rows = [(i if i != 2 else None, t, "x", 1.0) for i, t in enumerate([*TEXTS, None])] + [(0, TEXTS[0], "x", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, score double").repartition(2)
    encoded = pieces.encode(df)
    back = pieces.decode(encoded)
    want = sorted((str(d), t) if t is not None else (str(d), "\0null") for d, t, *_ in rows)
    assert sorted((str(r.doc_id), "\0null" if r.text is None else r.text) for r in back.collect()) == want
    short = {(r.doc_id, r.n_pieces, r.ids_crc32, r.decoded_crc32) for r in pieces.summary(df).collect()}
    for r in encoded.collect():
        if r.ids is not None:
            text = next(t for d, t, *_ in rows if d == r.doc_id)
            crc = zlib.crc32(np.array(r.ids, "<u4").tobytes())
            assert (r.doc_id, len(r.ids), crc, zlib.crc32(text.encode())) in short
            assert r.nbest[0].ids == r.ids and r.nbest[0].score == r.score
    assert pieces.encode(df.limit(0)).count() == pieces.summary(df.limit(0)).count() == 0


def test_query_returns_the_full_result(spark, tmp_path):
    rows = [(i if i != 2 else None, t) for i, t in enumerate([*TEXTS, None])] + [(0, TEXTS[0])]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op3_sentencepiece(spark, str(tmp_path))
    key = lambda r: str((r.doc_id, r.score, r.ids, r.nbest))
    assert sorted(map(key, got.collect())) == sorted(map(key, pieces.encode(df).collect()))
    assert sorted(map(str, (tuple(r) for r in got.select("doc_id", "decoded").collect()))) == sorted(map(str, rows))
    short = pieces.summary(df).drop("score")
    assert sorted(map(str, got.select(short.columns).collect())) == sorted(map(str, short.collect()))
