"""Packing (operator 6) by Karmarkar-Karp multiway differencing.

Each document becomes its token ids followed by the end id 1.  Whole windows
of ``window`` ids are cut off its front (no padding there); the rest is cut
into pieces of at most ``piece`` ids.  A task collects ``batch`` pieces and
divides them into m windows by differencing: every piece starts as a partial
partition of m sums, and the two partial partitions with the largest
imbalance are merged again and again, largest sums against smallest.  m
starts at the least number of windows that can hold the batch and rises
whenever the fullest window is over capacity.

Batches are formed inside a task from its own rows, so nothing is shuffled
and no group is gathered anywhere; only a task's last batch can be small.
``sequence_id`` is the task's partition number and a counter, the same again
when a task is repeated on the same input.

Token ids are cached per white-space separated word less the marks after it,
which is exact for a tokenizer that never joins text across white space and
cuts between letters and marks (checked in the tests); the cache is emptied at
``CACHE_WORDS`` words.  The ids are those of
``encode(text, add_special_tokens=False)`` and nothing else: the text of a
special token, which holds no white space, becomes that token's id wherever it
stands in a word.

Defined results: a null or empty text is the end id alone; null ids and
repeated rows are packed like others; a very long text fills whole windows
first, none of it is dropped; an empty table gives no pieces; other
columns are not read."""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import by_bytes, columns_or_null

WINDOW = 2048
PIECE = 512
BATCH = 512
END_ID = 1
CACHE_WORDS = 800_000
#: Texts encoded at a time, in bytes (one longer text is encoded alone).
TEXT_BYTES = 4 << 20
LEARN_WORDS = 20_000
#: Lower-case letters of Latin-1, the same after NFC and lower-casing.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class WordIds:
    """Ids of texts as little-endian 32-bit bytes, word by word.  A word is
    cut into a core and the ASCII marks after it where the tokenizer always
    cuts; ids are kept per core and per run of marks in one flat array, and a
    batch of texts is put together from it by numpy."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.byte_chars = {c: bytes_of(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self._forget()

    def _forget(self) -> None:
        # the empty word has place 0 and no ids
        self.place: dict[str, int] = {"": 0}
        self.size, self.start = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.flat = np.zeros(0, "<u4")

    def texts(self, texts: pa.Array | list[str]) -> list[bytes]:
        if len(self.place) > CACHE_WORDS:
            self._forget()
        # split at the six ASCII white-space characters, no others
        split = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        words = split.flatten().dictionary_encode()
        core, mark = _core_and_mark(words.dictionary)
        at = words.indices.to_numpy(zero_copy_only=False)
        # a word is its core, then its marks (mostly none)
        both = np.stack([self._places(core)[at], self._places(mark)[at]], 1).ravel()
        size = self.size[both]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(self.start[both] - (ends - size), size)]
        # places of texts in `ids` follow from their places among the words
        cut = 4 * np.r_[0, ends][2 * (split.offsets.to_numpy() - split.offsets[0].as_py())]
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(cut, cut[1:])]

    def _places(self, words: pa.Array) -> np.ndarray:
        """Place of every word, new ones learned."""
        distinct = words.dictionary_encode()
        got = distinct.dictionary.to_pylist()
        new = [w for w in got if w not in self.place]
        for at in range(0, len(new), LEARN_WORDS):
            self._learn(new[at:at + LEARN_WORDS])
        place = np.fromiter(map(self.place.__getitem__, got), np.int64, len(got))
        return place[distinct.indices.to_numpy(zero_copy_only=False)]

    def _learn(self, words: list[str]) -> None:
        """Words of small Latin letters, which the tokenizer's first steps
        leave whole, go straight to its merges; the others in one call,
        dealt out again by character offsets."""
        plain = [w for w in words if _PLAIN.fullmatch(w)]
        other = [w for w in words if not _PLAIN.fullmatch(w)]
        merges, byte_chars, flat, size = self.tok.model.tokenize, self.byte_chars, [], []
        for w in plain:
            tokens = merges(w if w.isascii() else w.translate(byte_chars))
            size.append(len(tokens))
            flat += [t.id for t in tokens]
        enc = self.tok.encode(" ".join(other), add_special_tokens=False)
        at = np.fromiter((o[0] for o in enc.offsets), np.int64, len(enc.ids))
        sizes = np.r_[np.array(size, np.int64), np.diff(np.searchsorted(
            at, np.cumsum([0] + [len(w) + 1 for w in other])))]
        self.place.update(zip(plain + other, range(len(self.size), len(self.size) + len(words))))
        self.start = np.r_[self.start, np.cumsum(sizes) - sizes + len(self.flat)]
        self.size = np.r_[self.size, sizes]
        self.flat = np.r_[self.flat, np.array(flat + enc.ids, "<u4")]


def _core_and_mark(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Words of letters and the ASCII marks after them, where the tokenizer
    always cuts (an apostrophe may start a contraction, so it is left out);
    cores of ASCII letters in lower case, as the tokenizer makes them.  Any
    other word is its own core."""
    core = pc.ascii_rtrim(words, ".,;:!?$%&#*|")
    latin = pc.ascii_is_alpha(core)
    cut = pc.or_(latin, pc.utf8_is_alpha(core))
    mark = pc.struct_field(pc.extract_regex(words, r"(?s)(?P<mark>[.,;:!?$%&#*|]*)\z"), "mark")
    return pc.if_else(latin, pc.ascii_lower(core), pc.if_else(cut, core, words)), pc.if_else(cut, mark, "")


def differencing(sizes: list[int], m: int) -> list[list[int]]:
    """Indices of ``sizes`` in m sets of nearly equal sums (Karmarkar-Karp)."""
    heap = []
    for i, size in enumerate(sizes):
        # a partial partition: sums in descending order less the smallest,
        # and the pieces of each set; most sets are empty at first, so only
        # sets above the smallest sum or with pieces are held
        heap.append((-size, i, [(size, [i])]))
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, x = heapq.heappop(heap)
        _, _, y = heapq.heappop(heap)
        merged = _merge(x, y, m)
        heapq.heappush(heap, (merged[-1][0] - merged[0][0] if len(merged) == m else -merged[0][0], serial, merged))
        serial += 1
    sets = [pieces for _, pieces in heap[0][2]] if heap else []
    return sets + [[] for _ in range(m - len(sets))]


def _merge(x: list, y: list, m: int) -> list:
    """Sets of x in descending order against sets of y in ascending order;
    lists shorter than m stand for further empty sets of sum 0."""
    free = m - len(x)
    if len(y) <= free:
        out = x + y
    else:
        # the largest of y take the empty sets, the others meet the smallest
        # of x, larger on smaller
        both = len(y) - free
        keep, low = x[:len(x) - both], x[len(x) - both:]
        out = keep + y[:free] + [(a + b, p + q) for (a, p), (b, q) in zip(reversed(low), y[free:])]
    return sorted(out, key=lambda s: -s[0])


def windows(sizes: list[int], capacity: int = WINDOW) -> list[list[int]]:
    """The pieces of each window; every sum is at most ``capacity``, which no
    single size may exceed."""
    m = max(1, -(-sum(sizes) // capacity))
    while True:
        sets = [s for s in differencing(sizes, m) if s]
        if all(sum(sizes[i] for i in s) <= capacity for s in sets):
            return sets
        m += 1


def cut(tokens: int, window: int = WINDOW, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length): whole windows first, then near-equal pieces of at
    most ``piece``."""
    out = [(s, window) for s in range(0, tokens - window + 1, window)]
    at, rest = len(out) * window, tokens % window
    n = -(-rest // piece)
    return out + [(at + rest * i // n, rest * (i + 1) // n - rest * i // n) for i in range(n)]


SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def pack(docs: DataFrame, path: str | None = None, with_ids: bool = False, window: int = WINDOW,
         piece: int = PIECE, batch_pieces: int = BATCH) -> DataFrame:
    """One row per piece; with ``with_ids`` also its token ids (``ids``)."""
    path = path or tokenizer_path()

    def run(batches):
        from pyspark import TaskContext
        word_ids, end = WordIds(path), np.array([END_ID], "<u4").tobytes()
        serial = TaskContext.get().partitionId() << 33
        held: list[tuple] = []

        def emit(pieces, places):
            cols = list(zip(*[(*p[:5], *at) for p, at in zip(pieces, places)]))
            arrays = [pa.array(c, pa.int64()) for c in cols]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                flat = np.frombuffer(b"".join(p[5] for p in pieces), "<i4")
                offsets = np.cumsum([0] + [p[2] for p in pieces]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def flush():
            nonlocal serial, held
            places: list = [None] * len(held)
            for members in windows([p[2] for p in held], window):
                offset = 0
                for i in sorted(members):
                    places[i] = (serial, offset)
                    offset += held[i][2]
                serial += 1
            out, held = emit(held, places), []
            return out

        for batch in batches:
            for part in by_bytes(batch, 1, TEXT_BYTES):
                ids, texts = part.column(0).to_pylist(), part.column(1).fill_null("")
                full: list[tuple] = []
                for doc_id, data in zip(ids, word_ids.texts(texts)):
                    data += end
                    tokens = len(data) // 4
                    for start, length in cut(tokens, window, piece):
                        piece_ids = data[4 * start:4 * (start + length)]
                        row = (doc_id, start, length, zlib.crc32(piece_ids), tokens, piece_ids if with_ids else None)
                        (full if length == window else held).append(row)
                    if len(held) >= batch_pieces:
                        yield flush()
                if full:
                    yield emit(full, [(serial + i, 0) for i in range(len(full))])
                    serial += len(full)
        if held:
            yield flush()

    return columns_or_null(docs, doc_id="long", text="string").mapInArrow(
        run, SCHEMA + (", ids array<int>" if with_ids else ""))
