"""LM scoring (operator 5) by online logistic context mixing.

A text is scored as the bytes of its tokens: lower-cased (A-Z) words, one
space between them, a newline as the end.  Each byte is a path in the Huffman
tree of the bytes before it (from training counts); every branch is one bit.
Hashed contexts (the last 3, 5 and 8 bytes; the word so far), joined with the
tree node, each predict the bit from counts of the training texts.  A mixer adds their logits with weights
that a gate picks (which contexts have been seen, and how deep in the tree the
bit lies); an adaptive map refines the mixed probability.  Weights and map
start the same for every text and learn online, block by block of ``BLOCK``
bytes: a block is predicted from what was learned before it, then learned.
Minus log2 of the product of all bit probabilities is the text's length in
bits.

Gathered from the corpus: token counts and byte counts of all training rows,
and the bit counts of every hashed context (fixed tables of ``TABLE_BITS``
slots per context, summed on the executors; the driver gets one byte per
slot).  Texts are scored in lanes side by side, so numpy works on whole
arrays.

The base score needs the count of every token.  The ``HEAD`` most frequent
tokens are broadcast (a fixed number); all others are joined on their 64-bit
hash, so a hot token never becomes a join key, and no count is dropped.

Defined results: a null text is empty and has the end token only; rows
without an id are training rows; repeated rows count as often as they occur;
an empty table gives an empty result; other columns are not read."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_or_null, staged

BYTES = (3, 5, 8)  # bytes of the byte contexts; the last context is the word so far
TABLE_BITS = (20, 22, 22, 22)
WORD = 64
PAIRS = 256
SEGMENT = 1 << 16
FAN = 64  # tasks whose counts are summed at once
BLOCK = 256
ROUND = 16 * BLOCK
LANES = 64
BATCH = 512
HEAD = 1 << 19
PIECE = 1 << 15  # pairs whose bits are in hand at once
HELD = 1 << 20  # bytes whose equal contexts are counted together
_SCALE = 16.0  # steps of a logit in a table byte
_GATES = 12
_BINS = 33
_END = b"\n"
START = [[0.7, 0.4, 0.2, 0.2],     # neither the word nor the longest byte context seen
         [0.245, 0.4, 0.75, 0.1],  # byte context
         [0.245, 0.4, 0.1, 0.75],  # word
         [0.0, 0.4, 0.6, 0.4]]     # both


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 7, is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(7)) == 2, F.lit(False))


def tokens(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words) -> np.ndarray:
    import xxhash
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64).view(np.int64)


# --- the code tree --------------------------------------------------------------

def huffman(counts: list[int]) -> list[list[tuple[int, int]]]:
    """For each symbol the (inner node, bit) pairs from the root down."""
    heap = [(256 * n + 1, b, None, None) for b, n in enumerate(counts)]  # every symbol gets a path
    heapq.heapify(heap)
    serial = len(counts)
    while len(heap) > 1:
        x, y = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (x[0] + y[0], serial, x, y))
        serial += 1
    paths: list[list[tuple[int, int]]] = [[] for _ in counts]
    stack, node = [(heap[0], [])], 0
    while stack:
        (_, symbol, left, right), path = stack.pop()
        if left is None:
            paths[symbol] = path
            continue
        stack += [(left, [*path, (node, 0)]), (right, [*path, (node, 1)])]
        node += 1
    return paths


class Code:
    """Paths of each byte in the tree of the bytes before it: the nodes
    passed, the bits taken.  The ``PAIRS`` most frequent pairs of bytes have a
    tree of their own, other places that of the last byte."""

    def __init__(self, triples: np.ndarray, counts: np.ndarray) -> None:
        """``triples`` (byte before the last, last byte, byte as one number)
        with their counts in the training texts."""
        last = np.zeros((256, 256), np.int64)
        np.add.at(last, ((triples >> 8) & 255, triples & 255), counts)
        pair = np.zeros(1 << 16, np.int64)
        np.add.at(pair, triples >> 8, counts)
        own = np.sort(np.argsort(-pair, kind="stable")[:min(PAIRS, int((pair > 0).sum()))])
        self.tree = np.tile(np.arange(256, dtype=np.int32), 256)  # by the two bytes before
        self.tree[own] = 256 + np.arange(len(own), dtype=np.int32)
        tables = np.zeros((256 + len(own), 256), np.int64)
        tables[:256] = last
        np.add.at(tables, (self.tree[triples >> 8], triples & 255), np.where(self.tree[triples >> 8] > 255, counts, 0))
        length, node, bit = [], [], []
        for t, row in enumerate(tables.tolist()):
            paths = huffman(row)
            length += map(len, paths)
            node.append(np.array([t << 8 | n for path in paths for n, _ in path], np.uint32))
            bit.append(np.array([b for path in paths for _, b in path], np.uint8))
        self.length = np.array(length, np.int32)
        self.start = (np.cumsum(self.length) - self.length).astype(np.int32)
        self.node = np.concatenate(node) * np.uint32(0x85EBCA6B)
        self.bit = np.concatenate(bit)
        deep = np.minimum(np.arange(len(self.bit)) - np.repeat(self.start, self.length), 2).astype(np.uint8)
        self.mark = self.bit | deep << 1  # the bit and how deep it lies: 0, 1, further

    def spell(self, before: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the byte of every bit, the bit's place in the flat path arrays);
        ``before``: the two bytes before as one number."""
        symbol = self.tree.take(before).astype(np.intp)
        symbol <<= 8
        symbol |= data
        n = self.length.take(symbol, mode="clip")
        ends = np.cumsum(n, dtype=np.intp)
        next_byte = np.zeros(int(ends[-1]) if len(ends) else 0, np.int8)
        next_byte[ends[:-1]] = 1  # every path has a bit
        of = np.cumsum(next_byte, dtype=np.intp)
        first = self.start.take(symbol, mode="clip") - ends
        first += n
        at = first.take(of, mode="clip")
        at += np.arange(len(at), dtype=np.intp)
        return of, at


def _code(tables: dict) -> Code:
    """The code of its broadcast tables: plain arrays, since workers need not
    have this package installed."""
    code = Code.__new__(Code)
    code.__dict__.update(tables)
    return code


# --- hashed contexts --------------------------------------------------------------

_RATIO = 0x5851F42D4C957F2D
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Contexts:
    """Context hashes of every byte of joined chunks."""

    def __init__(self) -> None:
        self.power = self.back = np.empty(0, np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The two bytes before each byte and its context hashes.
        ``starts``: where chunks begin."""
        before, hashed = self.of_bytes(data, starts)
        return before, [*hashed, self.of_words(data, starts)]

    def of_bytes(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        h, hashed = np.zeros(len(data), np.uint32), []
        wide = data.astype(np.uint32)
        for k in range(1, max(BYTES) + 1):
            h += self.back_by(k, wide, starts)
            h += np.uint32(1)
            h *= np.uint32(0x9E3779B1)
            if k in BYTES:
                hashed.append(h ^ (h >> np.uint32(15)))
        return self.two_before(data, starts), hashed

    def back_by(self, k: int, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The byte ``k`` places before each; before a chunk lie newlines."""
        n = len(data)
        last = np.full(n, 10, data.dtype)
        last[k:] = data[:max(0, n - k)]
        for ahead in range(k):  # a chunk's first bytes do not see the chunk before
            last[(starts + ahead)[starts + ahead < n]] = 10
        return last

    def two_before(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return self.back_by(2, data, starts).astype(np.uint16) << np.uint16(8) | self.back_by(1, data, starts)

    def of_words(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The word so far; it begins anew every ``WORD`` bytes."""
        n = len(data)
        if len(self.power) < n:
            ratio = np.full(n, _RATIO, np.uint64)
            inverse = np.full(n, pow(_RATIO, -1, 1 << 64), np.uint64)
            ratio[0] = inverse[0] = 1
            self.power, self.back = np.multiply.accumulate(ratio), np.multiply.accumulate(inverse)
        begins = (data == 32) | (data == 10)
        begins[1:] = begins[:-1]
        begins[starts] = True
        begins = np.flatnonzero(begins)
        size = np.diff(begins, append=n)
        word = np.repeat(begins, size)
        place = np.arange(n)
        if size.max(initial=0) > WORD:
            word = place - (place - word) % WORD
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * self.power[:n], out=sums[1:])
        prefix = sums[:-1] - sums.take(word, mode="clip")
        prefix *= self.back.take(word, mode="clip")
        prefix *= _ODD
        prefix >>= np.uint64(32)
        prefix = prefix.astype(np.uint32)
        return prefix ^ (prefix >> np.uint32(15))


def chunks(data: bytes, size: int):
    """(chunk, bytes of it that are only there as context) of a text, ``size``
    new bytes at a time; a chunk begins where a word context begins."""
    for at in range(0, len(data), size):
        begin = 0
        if at:
            word = data.rfind(b" ", 0, at - max(BYTES)) + 1
            begin = word + (at - max(BYTES) - word) // WORD * WORD
        yield data[begin:at + size], at - begin


def _slots(context: np.ndarray, of: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    """Slot of each bit; ``of``: where its byte's context stands."""
    h = context.take(of, mode="clip")
    h ^= node
    h *= np.uint32(0xC2B2AE35)
    h >>= np.uint32(32 - bits)
    return h.astype(np.intp)


class BitCounts:
    """Counts of zeros and ones per slot of every context.  Equal (context,
    byte) pairs of about ``HELD`` bytes are counted first, so that only
    different ones are spelled."""

    def __init__(self, code: Code) -> None:
        self.code, self.contexts = code, Contexts()
        self.tables = [np.zeros(2 << b, np.int32) for b in TABLE_BITS]
        self.held: list[tuple[bytes, int]] = []
        self.size = 0

    def add_text(self, words: list[bytes]) -> None:
        """The word context of a text."""
        for part in chunks(b" ".join(words) + _END, HELD):
            self.held.append(part)
            self.size += len(part[0])
            if self.size >= HELD:
                self._spell_words()

    def _spell_words(self) -> None:
        if self.held:
            data, starts, fresh = joined(self.held)
            self._pairs(len(BYTES), self.contexts.of_words(data, starts),
                        *self._tail(self.contexts.two_before(data, starts), data, fresh))
        self.held, self.size = [], 0

    def add(self, parts: list[tuple[bytes, int]]) -> None:
        """The byte contexts of chunks (bytes, of which so many are only
        context)."""
        data, starts, fresh = joined(parts)
        before, hashed = self.contexts.of_bytes(data, starts)
        tail = self._tail(before, data, fresh)
        for k, context in enumerate(hashed):
            self._pairs(k, context, *tail)

    @staticmethod
    def _tail(before, data, fresh) -> tuple[np.ndarray, np.ndarray]:
        """The new bytes' places; those bytes and the two before as one number."""
        here = np.flatnonzero(fresh)
        tail = before.take(here).astype(np.uint64)
        tail <<= np.uint64(8)
        tail |= data.take(here)
        return here, tail

    def _pairs(self, k: int, context, here, tail) -> None:
        pairs = context.take(here).astype(np.uint64)
        pairs <<= np.uint64(24)
        pairs |= tail
        pairs.sort()
        first = np.r_[0, np.flatnonzero(pairs[1:] != pairs[:-1]) + 1]
        times = np.diff(first, append=len(pairs)).astype(np.int32)
        pairs = pairs.take(first)
        for at in range(0, len(pairs), PIECE):
            part = pairs[at:at + PIECE]
            self._count(k, (part >> np.uint64(8)).astype(np.uint16), part.astype(np.uint8),
                        (part >> np.uint64(24)).astype(np.uint32), times[at:at + PIECE])

    def _count(self, k, before, data, context, times) -> None:
        of, at = self.code.spell(before, data)
        slot = _slots(context, of, self.code.node.take(at, mode="clip"), TABLE_BITS[k])
        slot += slot
        slot += self.code.bit.take(at, mode="clip")
        np.add.at(self.tables[k], slot, times.take(of, mode="clip"))

    def finish(self) -> BitCounts:
        self._spell_words()
        return self

    def segments(self):
        """(segment, slots, zeros, ones) of the used slots, ``SEGMENT`` slots
        to a segment; the tables lie one behind the other."""
        base = 0
        for table in self.tables:
            for at in range(0, len(table) // 2, SEGMENT):
                pair = table[2 * at:2 * (at + SEGMENT)]
                used = np.flatnonzero(pair.view(np.int64))  # both counts of a slot
                if len(used):
                    yield (base + at) // SEGMENT, used, pair[2 * used], pair[2 * used + 1]
            base += len(table) // 2


def logit_bytes(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Counts as a logit in steps of 1 / _SCALE."""
    x = np.log((ones + 0.3) / (zeros + 0.3))
    return np.clip(np.rint(x * _SCALE), -127, 127).astype(np.int8)


def joined(parts: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chunks' bytes, where each begins, and which bytes are new."""
    data = np.frombuffer(b"".join(c for c, _ in parts), np.uint8)
    size = np.array([len(c) for c, _ in parts])
    starts = np.cumsum(size) - size
    context = np.array([k for _, k in parts])
    return data, starts, np.arange(len(data)) - np.repeat(starts, size) >= np.repeat(context, size)


# --- the mixer ---------------------------------------------------------------------

def first_weights() -> np.ndarray:
    """Weights before anything is learned, by gate (word seen, longest byte
    context seen, depth): the longer a seen context, the more it counts."""
    return np.repeat(np.array(START, np.float32) / np.float32(_SCALE), 3, axis=0)


class Mixer:
    """Scores texts in lanes, see the module's text.  ``rate`` and ``prior``
    set the pace of the weights, ``trust`` how many bits the adaptive map must
    see before it counts as much as the mixer."""

    def __init__(self, code: Code, tables: list[np.ndarray], rate: float = 1.0, prior: float = 40.0,
                 trust: float = 60.0) -> None:
        self.code, self.tables, self.contexts = code, tables, Contexts()
        self.rate, self.prior, self.trust = rate, prior, np.float32(trust)

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Length in bits of each text."""
        out = np.zeros(len(texts))
        order = np.argsort([len(t) for t in texts], kind="stable")
        for at in range(0, len(texts), LANES):
            lanes = order[at:at + LANES]
            out[lanes] = self._lanes([texts[i] for i in lanes])
        return out

    def _lanes(self, texts: list[bytes]) -> np.ndarray:
        n = len(texts)
        total = np.zeros(n)
        weights = [np.tile(w, n) for w in first_weights().T]
        seen, ones = np.zeros(n * _BINS, np.float32), np.zeros(n * _BINS, np.float32)
        runs = [chunks(t, ROUND) for t in texts]
        live = list(range(n))
        while live:
            parts = [next(runs[i], None) for i in live]
            live = [i for i, p in zip(live, parts) if p]
            parts = [p for p in parts if p]
            if parts:
                self._round(np.array(live), parts, total, weights, seen, ones)
        return total

    def _round(self, live, parts, total, weights, seen, ones) -> None:
        data, starts, fresh = joined(parts)
        here = np.flatnonzero(fresh)
        new = np.array([len(c) - k for c, k in parts])
        # bytes in the order of their blocks, so a step is one slice
        lane = np.repeat(live.astype(np.intp), new)
        step = ((np.arange(len(here)) - np.repeat(np.cumsum(new) - new, new)) // BLOCK).astype(np.uint8)
        order = np.argsort(step, kind="stable")
        here, lane = here.take(order), lane.take(order)
        before, contexts = self.contexts(data, starts)
        of, at = self.code.spell(before.take(here), data.take(here))
        node, mark = self.code.node.take(at, mode="clip"), self.code.mark.take(at, mode="clip")
        bit = (mark & np.uint8(1)).astype(np.float32)
        place = here.take(of, mode="clip")
        logits = [np.empty(len(at), np.int8) for _ in self.tables]
        for out, table, context, bits in zip(logits, self.tables, contexts, TABLE_BITS):
            for a in range(0, len(at), 2 * PIECE):
                b = a + 2 * PIECE
                table.take(_slots(context, place[a:b], node[a:b], bits), mode="clip", out=out[a:b])
        deep = mark >> np.uint8(1)
        for weight, x in ((3, logits[-2]), (6, logits[-1])):
            deep += (x != 0).view(np.uint8) * np.uint8(weight)
        gate = (lane * _GATES).take(of, mode="clip")
        gate += deep
        cells = (lane * _BINS).take(of, mode="clip")
        came = (mark & np.uint8(1)).astype(np.intp)
        # bytes of a lane's step, and those of a step, lie in a row
        step = step.take(order)
        runs = np.r_[0, np.flatnonzero((lane[1:] != lane[:-1]) | (step[1:] != step[:-1])) + 1]
        lane, first = lane.take(runs), np.searchsorted(of, runs)
        last = np.r_[np.flatnonzero(np.diff(step.take(runs))) + 1, len(runs)]
        ends = np.r_[first, len(of)].take(last)
        half = np.float32(0.5)
        for a, b, i, j in zip([0, *ends[:-1]], ends, [0, *last[:-1]], last):
            one, g = bit[a:b], gate[a:b]
            inputs = [x[a:b].astype(np.float32) for x in logits]  # in steps of a logit, as the weights are
            dot = weights[0].take(g, mode="clip")
            dot *= inputs[0]
            for w, x in zip(weights[1:], inputs[1:]):
                part = w.take(g, mode="clip")
                part *= x
                dot += part
            np.clip(dot, -20, 20, out=dot)
            where = dot + dot
            where += np.float32(_BINS / 2)
            cell = np.clip(where, 0, _BINS - 1, out=where).astype(np.intp)
            cell += cells[a:b]
            p = np.exp(-dot, out=dot)
            p += 1
            np.reciprocal(p, out=p)
            f = ones.take(cell, mode="clip") + self.trust * p
            f /= seen.take(cell, mode="clip") + self.trust
            f += p
            f *= half
            np.clip(f, 1e-5, 1 - 1e-5, out=f)
            f += one
            f -= 1  # the probability of the bit that came, up to the sign
            cost = np.log2(np.abs(f, out=f), out=f)
            total[lane[i:j]] -= np.add.reduceat(cost, first[i:j] - a, dtype=np.float64)
            # learn the block
            error = np.subtract(one, p, out=p)
            pace = self.rate / _SCALE ** 2 / (np.bincount(g, minlength=len(weights[0])) + self.prior)
            for w, x in zip(weights, inputs):
                x *= error
                w += (pace * np.bincount(g, x, len(w))).astype(np.float32)
            cell += cell
            cell += came[a:b]
            fell = np.bincount(cell, minlength=2 * len(seen)).reshape(-1, 2).astype(np.float32)
            seen += fell[:, 0]
            seen += fell[:, 1]
            ones += fell[:, 1]


# --- the operator --------------------------------------------------------------------

def _count_tokens(batches):
    """(kind, key, n): token hashes (0) and byte triples (1) of a task."""
    words, held, size, merged = Counter(), [], 0, []

    def rows(kind, keys, n):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int32)), pa.array(keys), pa.array(n)],
                                          names=["kind", "key", "n"])

    for batch in batches:
        for t in batch.column(0):
            own = tokens(t.as_py())
            words.update(own)
            words[_END] += 1
            data = b"\n\n" + b" ".join(own) + _END
            held.append(data)
            size += len(data)
            if size > 1 << 20:
                merged = [_summed([*merged, _triples(held)])]  # at most 2**24 triples
                held, size = [], 0
            if len(words) > 400_000:
                yield rows(0, word_hashes(words), np.fromiter(words.values(), np.int64))
                words = Counter()
    yield rows(0, word_hashes(words), np.fromiter(words.values(), np.int64))
    yield rows(1, *_summed([*merged, _triples(held)]))


def _summed(counted: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of several such pairs as one."""
    keys, back = np.unique(np.concatenate([k for k, _ in counted]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([n for _, n in counted]), len(keys)).astype(np.int64)


def _triples(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Three bytes in a row as one number, and their counts; a text is led by
    two newlines."""
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.int32)
    size = np.array([len(t) for t in texts], np.int64)
    inside = np.ones(len(data), bool)
    for k in (0, 1):
        inside[np.cumsum(size) - size + k] = False
    at = np.flatnonzero(inside)
    return np.unique((data[at - 2].astype(np.int64) << 16) | (data[at - 1] << 8) | data[at], return_counts=True)


def _count_bits(code):
    def run(batches):
        from pyspark import TaskContext
        counts, parts, size = BitCounts(_code(code.value)), [], 0
        for batch in batches:
            for t in batch.column(0):
                own = tokens(t.as_py())
                counts.add_text(own)
                for part in chunks(b" ".join(own) + _END, HELD):
                    parts.append(part)
                    size += len(part[0])
                    if size >= HELD:
                        counts.add(parts)
                        parts, size = [], 0
        if parts:
            counts.add(parts)
        task = TaskContext.get().partitionId()
        for segment, used, zeros, ones in counts.finish().segments():
            yield _blob(segment, task, used, zeros, ones)
    return run


_BLOBS = "segment int, task long, gaps binary, small binary, large binary"


def _blob(segment: int, task: int, used: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> pa.RecordBatch:
    """Counts of the used slots, given in order.  ``gaps``: unused slots
    before each, 255 for every 255 that lie further ahead.  ``small``: a byte
    a slot, ones under zeros, four bits each; 255 if either is over 14 and
    both stand in ``large``."""
    gap = np.diff(used, prepend=-1) - 1
    gaps = gap.astype(np.uint8)
    if gap.max(initial=0) > 254:
        gaps = np.full(len(gap) + int((gap // 255).sum()), 255, np.uint8)
        gaps[np.cumsum(gap // 255 + 1) - 1] = gap % 255
    many = np.maximum(zeros, ones) > 14
    small = (zeros << 4 | ones).astype(np.uint8)
    small[many] = 255
    large = np.stack([zeros[many], ones[many]])
    # counts of one task fit 32 bits, sums of many may not
    large = large.astype("<u4" if large.size and int(large.max()) < 1 << 32 else "<i8")
    return pa.RecordBatch.from_arrays(
        [pa.array([segment], pa.int32()), pa.array([task], pa.int64()),
         *[pa.array([x.tobytes()], pa.binary()) for x in (gaps, small, large)]],
        names=["segment", "task", "gaps", "small", "large"])


def _unblob(gaps: bytes, small: bytes, large: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots, zeros, ones) of a blob, each slot once."""
    gap = np.frombuffer(gaps, np.uint8)
    ends = gap != 255
    used = (np.cumsum(gap, dtype=np.int64) + np.cumsum(ends) - 1)[ends]
    both = np.frombuffer(small, np.uint8)
    many = np.flatnonzero(both == 255)
    zeros, ones = (both >> 4).astype(np.int64), (both & 15).astype(np.int64)
    zeros[many], ones[many] = np.frombuffer(large, "<u4" if len(large) == 8 * len(many) else "<i8").reshape(2, -1)
    return used, zeros, ones


def _merged_counts(fan: int):
    """Sums the counts of one segment from at most ``fan`` tasks."""
    def run(rows: pa.Table) -> pa.Table:
        sums = np.zeros((2, SEGMENT), np.int64)
        for blob in zip(rows["gaps"], rows["small"], rows["large"]):
            at, zeros, ones = _unblob(*(x.as_py() for x in blob))
            sums[0, at] += zeros
            sums[1, at] += ones
        used = np.flatnonzero(sums.any(axis=0))
        return pa.Table.from_batches([_blob(rows["segment"][0].as_py(), rows["task"][0].as_py() // fan, used,
                                            sums[0, used], sums[1, used])])
    return run


def _logits(batches):
    for batch in batches:
        for segment, *blob in zip(*(batch.column(i) for i in (0, 2, 3, 4))):
            out = np.zeros(SEGMENT, np.int8)
            at, zeros, ones = _unblob(*(x.as_py() for x in blob))
            out[at] = logit_bytes(zeros, ones)
            yield pa.RecordBatch.from_arrays([pa.array([segment.as_py()], pa.int32()), pa.array([out.tobytes()])],
                                             names=["segment", "logits"])


def _at_hand(h: np.ndarray, keys: np.ndarray, counts: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Of token hashes: whether their counts are at hand, the logarithms of those."""
    hit, log = np.zeros(len(h), bool), np.zeros(len(h))
    if len(keys):
        place = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        hit = keys[place] == h
        log[hit] = np.log10(counts[place[hit]] + 1.0) - least
    return hit, log


def _score(model, total: int, kinds: int):
    def run(batches):
        from pyspark import TaskContext
        code, tables, keys, counts = model.value
        mixer, uid = Mixer(_code(code), tables), TaskContext.get().partitionId() << 33
        least = math.log10(total + kinds + 1)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                own = [tokens(t.as_py()) for t in batch.column(1)]
                spelled = [b" ".join(t) + _END for t in own]
                bits = mixer.bits(spelled)
                for t in own:
                    t.append(_END)
                n = np.array([len(t) for t in own])
                text = np.repeat(np.arange(len(own)), n)
                words, word = np.unique(word_hashes(chain.from_iterable(own)), return_inverse=True)
                hit, log = _at_hand(words, keys, counts, least)
                known = np.bincount(text, hit[word], len(own)).astype(np.int64)
                base = np.bincount(text, log[word], len(own))
                # the other words of each text, and how often it has them
                rest = ~hit[word]
                rest, times = np.unique(text[rest] * len(words) + word[rest], return_counts=True)
                tail = words[rest % len(words)]
                ends = np.searchsorted(rest // len(words), np.arange(len(own) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(uid, uid + len(own))), batch.column(0), batch.column(2),
                    pa.array(n, pa.int64()), pa.array(known), pa.array(base),
                    pa.array(bits * -math.log10(2)), pa.array([len(x) for x in spelled], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(tail)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(times))],
                    names=["uid", "doc_id", "held_out", "n_tokens", "known", "base", "score", "n_bytes", "tail", "times"])
                uid += len(own)
    return run


def score(docs: DataFrame, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (log10) of every row, the bytes scored and the bits each of them costs."""
    spark = docs.sparkSession
    rows = columns_or_null(docs, doc_id="long", text="string").select(
        "doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    training = rows.filter(~F.col("held_out")).select("text")
    found = staged(training.mapInArrow(_count_tokens, "kind int, key long, n long")
                   .groupBy("kind", "key").agg(F.sum("n").alias("n")), "token-counts")
    words = found.filter("kind = 0")
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("key")).first()
    triples = found.filter("kind = 1").select("key", "n").toArrow()  # at most 2**24 rows of 16 bytes
    code = Code(triples["key"].to_numpy(), triples["n"].to_numpy())
    sc = spark.sparkContext
    # counts of the hashed contexts: sums by segment, over FAN tasks at a time
    counted = training.mapInArrow(_count_bits(sc.broadcast(code.__dict__)), _BLOBS)
    tasks = training.rdd.getNumPartitions()
    while True:
        counted = counted.groupBy("segment", F.floor(F.col("task") / FAN).alias("group")).applyInArrow(
            _merged_counts(FAN), _BLOBS)
        tasks = -(-tasks // FAN)
        if tasks <= 1:
            break
    flat = np.zeros(sum(1 << b for b in TABLE_BITS), np.int8)
    logits = counted.mapInArrow(_logits, "segment int, logits binary")
    for r in logits.collect():  # a fixed number of rows of SEGMENT bytes: 14 MB in all
        flat[r.segment * SEGMENT:(r.segment + 1) * SEGMENT] = np.frombuffer(r.logits, np.int8)
    tables = np.split(flat, np.cumsum([1 << b for b in TABLE_BITS])[:-1])
    top = words.orderBy(F.desc("n"), "key").limit(head).select("key", "n").orderBy("key").toArrow()
    keys, counts = top["key"].to_numpy(), top["n"].to_numpy()
    scored = staged(rows.mapInArrow(
        _score(sc.broadcast((code.__dict__, tables, keys, counts)), total, kinds),
        "uid long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, n_bytes long, "
        "tail array<long>, times array<long>"), "scores")
    rare = scored.select("uid", F.explode(F.arrays_zip("tail", "times")).alias("t")).select(
        "uid", F.col("t.tail").alias("key"), F.col("t.times").alias("times"))
    c = F.coalesce(F.col("n"), F.lit(0))
    rest = (rare.join(words.select("key", "n"), "key", "left").groupBy("uid").agg(
        F.sum(F.col("times") * (F.log10(c + 1.0) - math.log10(total + kinds + 1))).alias("rest"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rest_known")))
    return scored.drop("tail", "times").join(rest, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), "score", "n_bytes",
        (F.col("score") / (-math.log10(2)) / F.col("n_bytes")).alias("bits_per_byte"))
