"""Phrase collocation mining (operator 11) by Rabin-Karp fingerprints.

Texts are staged once with a row number.  A task reads a stretch of them as
one run of bytes: a prefix polynomial over the bytes (modulo 2**64, an odd
base) hashes every word, a second one over the word hashes hashes every phrase
of 2 to ``longest`` words, and equal fingerprints of the stretch are counted
together.  What equals in fingerprint is compared word by word there; a stretch
with a collision counts by the words instead.

Counts travel as blocks: the fingerprints of a stretch in sorted order, cut by
their top bits into buckets, each with its counts and a pointer (row, byte) to
one occurrence.  A bucket holds a bounded share of the fingerprints, so a group
is as large for a hot phrase as for any other: one entry a stretch.  Buckets
add the counts and keep the pointers of fingerprints that reach ``least`` only.
Those pointers are followed back into the texts, and the counts are added again
by the phrase found there: this verifies every occurrence (phrases that share a
fingerprint come apart) and makes text of frequent phrases only.

Scores, containment and ranks are DataFrame operations on the frequent
phrases; products are DECIMAL(38,0).  The top of a language is a ranked limit
that is applied in every task before the exchange.

Defined results: a null text is read as empty, a null lang as ``und``; null
ids, repeated rows and very long texts count like others (a text is read whole;
a stretch is ``STRETCH_BYTES`` of text or one longer text); ties in score and
count go to the smaller phrase; an empty table gives an empty result; other
columns are not read."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import columns_or_null, staged
from .fim import byte_slices

STRETCH_BYTES = 4 << 20
#: Bytes of text for one bucket of fingerprints.
BUCKET_BYTES = 8 << 20
MAX_BITS = 20
#: Bytes of a fingerprint that travel beside its bucket; fewer would only make
#: more phrases meet that the text then tells apart.
FP_BYTES = 5
NO_LANGUAGE = "und"
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_BLANKS = b" \t"
_BASE, _WORD_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_U64 = np.uint64


def _kinds() -> np.ndarray:
    """0 word, 1 blank, 2 break of a piece, for each byte."""
    kinds = np.zeros(256, np.uint8)
    kinds[list(_BLANKS)], kinds[list(_BREAKS)] = 1, 2
    return kinds


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(n + 1, _U64)
    np.cumprod(np.full(n, base), out=out[1:])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread a polynomial's value over all 64 bits."""
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U64(29))) * _U64(0xA0761D6478BD642F)
    return x ^ (x >> _U64(32))


def spans_hash(values: np.ndarray, starts: np.ndarray, size: np.ndarray | int, base: np.uint64) -> np.ndarray:
    """Polynomial of ``values[start:start + size]`` for every start, from one
    prefix polynomial; the offset's power is divided out (an odd base has an
    inverse)."""
    prefix = np.zeros(len(values) + 1, _U64)
    np.cumsum(values * powers(base, len(values))[:-1], out=prefix[1:])
    inverse = powers(_U64(pow(int(base), -1, 1 << 64)), len(values))
    return mixed((prefix[starts + size] - prefix[starts]) * inverse[starts] + np.asarray(size).astype(_U64))


class Words:
    """The words of a stretch of texts: places, hashes, exact numbers, pieces."""

    def __init__(self, data: np.ndarray, firsts: np.ndarray) -> None:
        upper = (data >= 65) & (data <= 90)
        data = np.where(upper, data + 32, data).astype(np.uint8)
        kind = _kinds()[data]
        inside = kind == 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        begins[firsts] = inside[firsts]
        self.at = np.flatnonzero(begins)
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        ends[firsts[1:] - 1] = inside[firsts[1:] - 1]
        self.size = np.flatnonzero(ends) + 1 - self.at
        breaks = np.cumsum(kind == 2, dtype=np.int32)
        self.text = np.searchsorted(firsts, self.at, "right") - 1
        self.piece = breaks[self.at] if len(self.at) else np.zeros(0, np.int64)
        letters = data[inside]
        ends = np.cumsum(self.size)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.at), [
            None, pa.py_buffer(np.r_[0, ends].astype(np.int64).tobytes()), pa.py_buffer(letters.tobytes())])
        coded = words.dictionary_encode()
        self.number = coded.indices.to_numpy()
        self.distinct = coded.dictionary
        offsets = np.frombuffer(self.distinct.buffers()[1], "<i8", len(self.distinct) + 1)
        spelled = np.frombuffer(self.distinct.buffers()[2] or b"", np.uint8)
        # a byte's value is spread, so short words differ in high bits too
        values = mixed(spelled.astype(_U64) + _U64(1))
        self.hash = spans_hash(values, offsets[:-1], np.diff(offsets), _BASE)[self.number] if len(self.at) else np.zeros(0, _U64)

    def phrases(self, n: int, language: np.ndarray, salt: np.ndarray):
        """First word, fingerprint and word numbers of every phrase of ``n``
        words; ``salt`` tells languages apart."""
        last = len(self.at) - n + 1
        if last <= 0:
            return np.zeros(0, np.int64), np.zeros(0, _U64)
        first = np.arange(last)
        same = (self.text[:last] == self.text[n - 1:]) & (self.piece[:last] == self.piece[n - 1:])
        first = first[same]
        return first, spans_hash(self.hash, first, n, _WORD_BASE) ^ salt[language[self.text[first]]]


def _grouped(fp: np.ndarray, first: np.ndarray, words: Words, language: np.ndarray, n: int):
    """Distinct phrases of a stretch: fingerprint, count, first word of one
    occurrence; what shares a fingerprint is compared word by word."""
    order = np.argsort(fp, kind="stable")
    fp, first = fp[order], first[order]
    new = np.r_[True, fp[1:] != fp[:-1]] if len(fp) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    head = first[at][np.cumsum(new) - 1] if len(fp) else first
    same = language[words.text[first]] == language[words.text[head]]
    for i in range(n):
        same &= words.number[first + i] == words.number[head + i]
    if not same.all():  # a collision: count by the words themselves
        keys = [words.number[first + i] for i in range(n)] + [language[words.text[first]], fp]
        order = np.lexsort(keys)
        keys, first = [k[order] for k in keys], first[order]
        at = np.flatnonzero(np.r_[True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])
        fp = keys[-1]
    return fp[at], np.diff(np.r_[at, len(fp)]), first[at]


def _packed(x: np.ndarray, width: int = 4) -> bytes:
    """Numbers of ``width`` bytes, byte plane by byte plane, compressed: high
    planes hold little and cost little."""
    planes = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, size: int, width: int = 4) -> np.ndarray:
    planes = np.zeros((size, 8), np.uint8)
    got = pa.decompress(raw, decompressed_size=size * width, codec="zstd", asbytes=True)
    planes[:, :width] = np.frombuffer(got, np.uint8).reshape(width, size).T
    return planes.view("<u8").ravel().astype(np.int64)


def _dealt(limit: int):
    """(stretch, row, text, lang): the rows of a task in stretches of at most
    ``limit`` bytes (or one row), numbered."""
    def run(batches):
        from pyspark import TaskContext
        stretch, row, size = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            for part in byte_slices(batch, limit):
                got = sum(len(x) for x in part.column(1).cast(pa.binary()).to_pylist())
                if row and size + got > limit:
                    stretch, row, size = stretch + 1, 0, 0
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(part.num_rows, stretch)), pa.array(np.arange(row, row + part.num_rows)),
                    part.column(1), part.column(0)], names=["stretch", "row", "text", "lang"])
                row, size = row + part.num_rows, size + got
    return run


def _stretches(batches):
    """The rows of each stretch that a task reads, put together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        number = batch.column(0).to_numpy()
        cuts = np.flatnonzero(np.diff(number)) + 1
        for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(number)]):
            if held and held[0].column(0)[0].as_py() != number[lo]:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.concat_batches(held)


class Stretch:
    """Words and languages of the texts of a stretch: (stretch, row, text,
    lang)."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.rows = batch.column(1).to_numpy()
        coded = pa.concat_arrays([batch.column(3)]).dictionary_encode()
        self.names, language = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        texts = pa.concat_arrays([batch.column(2).cast(pa.large_binary())])
        ends = np.frombuffer(texts.buffers()[1], "<i8", len(texts) + 1, texts.offset * 8)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
        self.bounds = ends - ends[0]
        # a text without a byte has no start of its own
        filled = np.flatnonzero(np.diff(self.bounds))
        self.words = Words(data, self.bounds[filled])
        if len(filled):
            self.words.text = filled[self.words.text]
        self.language = language


def _salt(name: str) -> np.uint64:
    raw = np.frombuffer(name.encode() + b"\0", np.uint8).astype(_U64)
    return spans_hash(mixed(raw + _U64(1)), np.zeros(1, np.int64), len(raw), _BASE)[0]


def _blocks(texts: DataFrame, longest: int, bits: int) -> DataFrame:
    """One row a stretch, bucket and phrase length: fingerprints (the
    ``FP_BYTES`` below the bucket's bits, as differences in their order), counts
    and pointers; and one a stretch, bucket and language with words (length 1)
    and their counts."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64()), ("size", pa.int64()), ("fp", pa.binary()), ("count", pa.binary()),
                        ("row", pa.binary()), ("byte", pa.binary()), ("stretch", pa.int64()),
                        ("lang", pa.string()), ("words", pa.list_(pa.binary()))])

    def bucketed(fp: np.ndarray):
        """Places of every bucket in sorted fingerprints."""
        bucket = (fp >> _U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(fp), np.int64)
        edges = np.searchsorted(bucket, np.arange((1 << bits) + 1))
        return [(b, edges[b], edges[b + 1]) for b in np.flatnonzero(np.diff(edges)).tolist()]

    def blocks_of(batch: pa.RecordBatch):
        read = Stretch(batch)
        words, language, names, number = read.words, read.language, read.names, batch.column(0)[0].as_py()
        if not len(words.at):
            return
        spoken, hashes = language[words.text], np.empty(len(words.distinct), _U64)
        hashes[words.number] = words.hash
        for i, name in enumerate(names):
            mine = np.bincount(words.number[spoken == i], minlength=len(words.distinct))
            some = np.flatnonzero(mine)
            some = some[np.argsort(hashes[some], kind="stable")]
            for b, lo, hi in bucketed(hashes[some]):
                yield {"bucket": b, "n": 1, "size": hi - lo, "lang": name, "count": _packed(mine[some[lo:hi]]),
                       "words": words.distinct.take(pa.array(some[lo:hi])).to_pylist()}
        salt = np.array([_salt(x) for x in names], _U64)
        for n in range(2, longest + 1):
            first, fp = words.phrases(n, language, salt)
            fp, count, first = _grouped(fp, first, words, language, n)
            low = fp << _U64(bits) >> _U64(64 - 8 * FP_BYTES)
            row = read.rows[words.text[first]]
            byte = words.at[first] - read.bounds[words.text[first]]
            for b, lo, hi in bucketed(fp):
                yield {"bucket": b, "n": n, "size": hi - lo, "fp": _packed(np.diff(low[lo:hi], prepend=_U64(0)), FP_BYTES),
                       "count": _packed(count[lo:hi]), "row": _packed(row[lo:hi]), "byte": _packed(byte[lo:hi]), "stretch": number}

    def run(batches):
        for batch in _stretches(batches):
            out = []
            for block in blocks_of(batch):
                out.append(block)
                if len(out) == 64:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return texts.mapInArrow(run, "bucket int, n long, size long, fp binary, count binary, row binary, byte binary, stretch long, "
                                 "lang string, words array<binary>")


def _frequent(blocks: DataFrame, least: int) -> DataFrame:
    """What the buckets find frequent.  Of phrases one row a stretch (n = 2):
    the pointers there, packed, of all fingerprints whose counts add up to
    ``least``.  Of words that occur as often (n = 1) the count, of the other
    words of a language (n = 0) the sum of counts."""
    schema = pa.schema([("n", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()), ("count", pa.int64()),
                        ("stretch", pa.int64()), ("size", pa.int64()), *[(c, pa.binary()) for c in ("ns", "rows", "bytes", "counts")]])

    def run(table: pa.Table) -> pa.Table:
        fp, count, row, byte, owner, words = [], [], [], [], [], Counter()
        for b in table.to_batches():
            for n, size, f, c, r, y, stretch, lang, text in zip(*(b.column(x).to_pylist() for x in (
                    "n", "size", "fp", "count", "row", "byte", "stretch", "lang", "words"))):
                if n == 1:
                    for w, k in zip(text, _unpacked(c, size).tolist()):
                        words[lang, w] += k
                    continue
                fp.append(np.cumsum(_unpacked(f, size, FP_BYTES)) << 8 | n)
                for held, raw in ((count, c), (row, r), (byte, y)):
                    held.append(_unpacked(raw, size).astype(np.uint32))
                owner.append(np.full(size, stretch))
        rare, out = Counter(), []
        for (lang, w), k in words.items():
            if k >= least:
                out.append({"n": 1, "lang": lang, "phrase": w.decode("utf-8", "replace"), "count": k})
            else:
                rare[lang] += k
        out += [{"n": 0, "lang": lang, "count": k} for lang, k in rare.items()]
        if fp:
            fp = np.concatenate(fp)
            order = np.argsort(fp, kind="stable")
            at = np.flatnonzero(np.r_[True, np.diff(fp[order]) != 0])
            enough = np.add.reduceat(np.concatenate(count)[order], at, dtype=np.int64) >= least
            keep = order[np.repeat(enough, np.diff(np.r_[at, len(fp)]))]
            keep = keep[np.argsort(np.concatenate(owner)[keep], kind="stable")]
            owner, columns = np.concatenate(owner)[keep], [x[keep] for x in (fp & 255, *map(np.concatenate, (row, byte, count)))]
            cuts = np.r_[np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]), len(owner)] if len(owner) else [0]
            for lo, hi in zip(cuts, cuts[1:]):
                packed = [_packed(x[lo:hi]) for x in columns]
                out.append({"n": 2, "stretch": int(owner[lo]), "size": int(hi - lo),
                            **dict(zip(("ns", "rows", "bytes", "counts"), packed))})
        return pa.Table.from_pylist(out, schema=schema)

    return blocks.groupBy("bucket").applyInArrow(
        run, "n long, lang string, phrase string, count long, stretch long, size long, ns binary, rows binary, "
             "bytes binary, counts binary")


def _materialised(pointers: DataFrame, texts: DataFrame) -> DataFrame:
    """(lang, phrase, count) of each pointer, read from its text; a group is
    one stretch of texts and the pointers into it."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("count", pa.int64())])

    def run(text: pa.Table, found: pa.Table) -> pa.Table:
        if not found.num_rows or not text.num_rows:
            return schema.empty_table()
        read = Stretch(pa.concat_batches(text.select(["stretch", "row", "text", "lang"]).sort_by("row").to_batches()))
        words, names = read.words, pa.array(read.names, pa.string())
        size = found["size"].to_pylist()
        n, row, byte, count = (np.concatenate([_unpacked(x, k) for x, k in zip(found[c].to_pylist(), size)])
                               for c in ("ns", "rows", "bytes", "counts"))
        index = np.searchsorted(read.rows, row)
        first = np.searchsorted(words.at, read.bounds[index] + byte)
        out = []
        for k in np.unique(n).tolist():
            mine = np.flatnonzero(n == k)
            spelled = [words.distinct.take(pa.array(words.number[first[mine] + i])) for i in range(k)]
            phrase = pc.binary_join_element_wise(*spelled, pa.scalar(b" ", pa.large_binary()))
            out.append(pa.table({"lang": names.take(pa.array(read.language[index[mine]])), "phrase": phrase.cast(
                pa.large_string()).cast(pa.string()), "count": count[mine]}))
        return pa.concat_tables(out)

    return texts.groupBy("stretch").cogroup(pointers.groupBy("stretch")).applyInArrow(
        run, "lang string, phrase string, count long")


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10,
                  stretch_bytes: int = STRETCH_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, a): all phrases of 1 to ``longest`` words that
    occur ``least`` times, words included; and (lang, n): all words of each
    language."""
    texts = columns_or_null(docs, text="string", lang="string").select(
        F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    texts = staged(texts.mapInArrow(_dealt(stretch_bytes), "stretch long, row long, text string, lang string"), "phrase-texts")
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = min(MAX_BITS, (size // BUCKET_BYTES).bit_length())
    found = staged(_frequent(_blocks(texts, longest, bits), least), "phrases-found")
    words = found.where("n < 2").select("lang", F.col("n").cast("int").alias("words"), "phrase", F.col("count").alias("a"))
    phrases = (_materialised(found.where("n > 1").select("stretch", "size", "ns", "rows", "bytes", "counts"), texts)
               .groupBy("lang", "phrase").agg(F.sum("count").alias("a")).where(F.col("a") >= least))
    phrases = phrases.select("lang", (F.size(F.split("phrase", " "))).alias("words"), "phrase", "a")
    return (staged(phrases.unionByName(words.where("words = 1")), "phrase-counts"),
            words.groupBy("lang").agg(F.sum("a").alias("n")))


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, inside_percent: int = 50,
                 stretch_bytes: int = STRETCH_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's phrases that
    hold together best, by the lowest a * a / (l * r) over all cuts, without
    those that a longer phrase mostly accounts for."""
    counts, totals = phrase_counts(docs, longest, least, stretch_bytes)
    parts = F.split("phrase", " ")
    found = counts.where("words > 1")

    def joined(at, size):
        return F.array_join(F.slice(parts, at, size), " ")

    cuts = found.select("lang", "words", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumn("left", joined(F.lit(1), F.col("k"))).withColumn("right", joined(F.col("k") + 1, F.col("words") - F.col("k")))
    for side, out in (("left", "l"), ("right", "r")):
        part = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias(f"_{side}"), F.col("a").alias(out))
        cuts = cuts.join(part, (cuts["lang"] == part["_lang"]) & (cuts[side] == part[f"_{side}"])).drop("_lang", f"_{side}")
    cuts = cuts.withColumn("score", F.expr(
        "(CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)))"
        " div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))"))
    lowest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("c")).select(
        "lang", "phrase", "c.a", "c.l", "c.r", "c.score")
    # phrases inside a longer one
    longer = found.where("words > 2").select(
        "lang", "a", F.explode(F.flatten(F.transform(
            F.sequence(F.lit(2), F.col("words") - 1), lambda size: F.transform(
                F.sequence(F.lit(1), F.col("words") - size + 1),
                lambda at: F.array_join(F.slice(parts, at, size), " "))))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").where(
        F.col("_longer").isNull() | (100 * F.col("_longer") < inside_percent * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
