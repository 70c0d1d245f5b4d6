"""Fill-in-the-middle transformation (operator 13) on a wavelet matrix.

A batch of texts is one run of UTF-8 bytes.  Every byte gets a class:
continuation byte, plain character, character that starts a word, that starts
a line, or both.  A wavelet matrix over these classes answers in three steps
how often a class stands before a place; such ranks, added over the classes
that begin a unit (character, word or line), count the unit boundaries in any
stretch, and a bisection on those counts finds the byte at which a given
number of units ends.  All texts of the batch are counted and cut at once, so
no text is decoded, and a cut never divides a character.

The cut places and the form follow from the SHA-256 of seed and doc_id, so a
repeated task gives the same rows.  One pass, no shuffle; a batch holds at
most ``BATCH_BYTES`` bytes of text, or one longer text.

Defined results: a null text is read as empty and gives the plain form; a null
id is hashed as empty; repeated rows are transformed alike; a text that holds a
sentinel stays plain; very long texts are cut whole; an empty table gives an
empty result; other columns are not read.  A byte that continues no character
(invalid UTF-8) belongs to the unit before it."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_or_null

SENTINELS = ("<P>", "<S>", "<M>")
BATCH_BYTES = 4 << 20
#: Classes of bytes, and those that begin a unit.
CONTINUES, PLAIN, WORD, LINE, WORD_AND_LINE = range(5)
UNITS = {"char": (PLAIN, WORD, LINE, WORD_AND_LINE), "word": (WORD, WORD_AND_LINE), "line": (LINE, WORD_AND_LINE)}
_LEVELS = 3


class _Bits:
    """A bit vector with rank queries: counts up to each 64-bit word, and a
    population count inside the word."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, "<u8")
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Ranks of the classes of a sequence; one bit vector for each bit of a
    class, high bit first, the sequence stably parted by that bit after it."""

    def __init__(self, classes: np.ndarray) -> None:
        self.size, self.levels = len(classes), []
        for level in range(_LEVELS - 1, -1, -1):
            bit = (classes >> level) & 1
            one = bit.astype(bool)
            self.levels.append((level, _Bits(bit), len(bit) - int(bit.sum())))
            classes = np.concatenate([classes[~one], classes[one]])

    def rank(self, kind: int, at: np.ndarray) -> np.ndarray:
        """How often class ``kind`` stands before each place."""
        lo, hi = np.zeros_like(at), at
        for level, bits, zeros in self.levels:
            lo1, hi1 = bits.rank(lo[:1]), bits.rank(hi)
            if kind >> level & 1:
                lo, hi = np.broadcast_to(zeros + lo1, at.shape), zeros + hi1
            else:
                lo, hi = np.broadcast_to(lo[:1] - lo1, at.shape), hi - hi1
        return hi - lo

    def boundaries(self, kinds: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """Bytes of any of the classes before each place."""
        if len(kinds) > 2:  # fewer ranks the other way round
            return at - sum(self.rank(k, at) for k in range(WORD_AND_LINE + 1) if k not in kinds)
        return sum(self.rank(k, at) for k in kinds)

    def cut(self, kinds: tuple[int, ...], start: np.ndarray, end: np.ndarray, units: np.ndarray) -> np.ndarray:
        """The place in each stretch start..end behind its first ``units``
        units: where the next unit begins, or the end."""
        base = self.boundaries(kinds, start)
        lo, hi = start.copy(), end + 1  # the least place with units + 1 boundaries before it, or end + 1
        while (lo < hi).any():
            mid = (lo + hi) >> 1
            enough = (self.boundaries(kinds, np.minimum(mid, end)) - base > units) | (mid > end)
            open_ = lo < hi
            hi = np.where(open_ & enough, mid, hi)
            lo = np.where(open_ & ~enough, mid + 1, lo)
        return np.where(units > 0, lo - 1, start)


def classes_of(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of every byte; ``starts`` are the first bytes of texts."""
    blank = ((data >= 9) & (data <= 13)) | (data == 32)
    after_blank, after_line = np.ones(len(data), bool), np.ones(len(data), bool)
    after_blank[1:], after_line[1:] = blank[:-1], data[:-1] == 10
    after_blank[starts], after_line[starts] = True, True
    word = after_blank & ~blank
    kinds = PLAIN + word.astype(np.uint8) + 2 * after_line.astype(np.uint8)
    kinds[(data & 0xC0) == 0x80] = CONTINUES
    return kinds


def _numbers(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


SCHEMA = "doc_id long, n long, form string, prefix_units long, middle_units long, output string"


def fill_in_middle(docs: DataFrame, unit: str = "char", seed: int = 1, plain_percent: int = 10,
                   spm_percent: int = 20, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """(doc_id, n units, form, prefix_units, middle_units, output): each text
    cut into prefix, middle and suffix at two unit boundaries and written as
    ``psm`` or ``spm``, or left ``plain``."""
    kinds, marks = UNITS[unit], [s.encode() for s in sentinels]
    p, s, m = marks

    def transform(ids: list, data: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        start, end = ends[:-1].astype(np.int64), ends[1:].astype(np.int64)
        matrix = WaveletMatrix(classes_of(data, start[start < len(data)]))
        n = matrix.boundaries(kinds, end) - matrix.boundaries(kinds, start)
        h = np.array([_numbers(seed, i) for i in ids], np.int64).reshape(-1, 4)
        a, b = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
        units = np.concatenate([np.minimum(a, b), np.maximum(a, b)])
        cuts = matrix.cut(kinds, np.tile(start, 2), np.tile(end, 2), units)
        raw, forms, out = data.tobytes(), [], []
        for i, (lo, x, y, hi) in enumerate(zip(start.tolist(), cuts[:len(n)].tolist(), cuts[len(n):].tolist(), end.tolist())):
            text = raw[lo:hi]
            if not text or h[i, 2] % 100 >= 100 - plain_percent or any(k in text for k in marks):
                form, got = "plain", text
            elif h[i, 3] % 100 < spm_percent:
                form, got = "spm", b"".join((s, raw[y:hi], p, raw[lo:x], m, raw[x:y]))
            else:
                form, got = "psm", b"".join((p, raw[lo:x], s, raw[y:hi], m, raw[x:y]))
            forms.append(form)
            out.append(got)
        plain = np.array([f == "plain" for f in forms], bool)
        first, second = units[:len(n)], units[len(n):]
        offsets = np.cumsum([0] + [len(o) for o in out])
        output = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(out), [
            None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(b"".join(out))])
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(n), pa.array(forms, pa.string()), pa.array(first, mask=plain),
            pa.array(second - first, mask=plain), output.view(pa.large_string()).cast(pa.string())],
            names=["doc_id", "n", "form", "prefix_units", "middle_units", "output"])

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, BATCH_BYTES):
                texts = part.column(1).cast(pa.large_binary()).fill_null(b"")
                texts = pa.concat_arrays([texts])  # offsets from 0, no gaps
                ends = np.frombuffer(texts.buffers()[1], "<i8", len(texts) + 1, texts.offset * 8)
                data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
                yield transform(part.column(0).to_pylist(), data, ends - ends[0])

    return columns_or_null(docs, doc_id="long", text="string").mapInArrow(run, SCHEMA)


def byte_slices(batch: pa.RecordBatch, limit: int):
    """Slices of a batch whose second column holds at most ``limit`` bytes, or
    a single row."""
    import pyarrow.compute as pc
    size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    total, at = np.cumsum(size), 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text of a transformed one, exactly: no text in the forms ``psm`` and
    ``spm`` holds a sentinel, so the three are found again where they were put."""
    parts = F.split(output, "|".join("\\Q" + x + "\\E" for x in sentinels), -1)
    first, second, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (F.when(form == "psm", F.concat(first, middle, second))
            .when(form == "spm", F.concat(second, middle, first)).otherwise(output))
