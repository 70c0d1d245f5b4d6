"""SentencePiece encoding and decoding (operator 3) with N-best segmentation.

The model's pieces and scores give a lattice over a text; its N segmentations
of highest total score are found by a forward Viterbi pass, whose scores are
the exact remaining cost of a backward A* search, so the search only opens
nodes of paths that are returned.

Two exact reductions make this affordable.  No piece holds certain pairs of
neighbouring characters (above all, none goes on after a space began), so the
lattice is cut at such pairs into parts that are solved on their own and
cached, the forward pass of many parts side by side in numpy; and of a text's
parts only the N - 1 with the smallest lead over their second choice can differ
from the best segmentation, so the A* search is run for those (the lead itself
follows from the Viterbi scores along the best path).  The model's scores are
ranks of merges, so the segmentation of highest total score is often not the
one its own greedy encoder gives.

Text is used as it is: a space becomes the piece mark U+2581, one is put in
front, and a character without a piece is spelled in byte pieces, at 10 below
the lowest piece score in all.  Decoding gives back the exact text.

Defined results: a null text has null ids, an empty text none; null ids and
repeated rows are encoded like others; a very long text is encoded whole, by
itself; an empty table gives an empty result; other columns are not read.
Segmentations of equal score follow in the order
the search finds them, which depends on the part alone."""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, columns_or_null

NBEST = 3
CACHE_PARTS = 600_000
#: Texts encoded at a time, in bytes (one longer text is encoded alone); new
#: parts learned at a time, in characters; the longest part learned side by
#: side with others (longer ones are done one by one).
TEXT_BYTES = 2 << 20
LEARN_CHARS = 200_000
SIDE_BY_SIDE = 64
_MARK = "▁"
_LOWEST = float("-inf")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Pieces:
    """The model's pieces by text, with scores; bytes of each id."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, tuple[bytes, float]] = {}
        self.byte_ids: dict[int, bytes] = {}
        self.text: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece, code = sp.id_to_piece(i), np.uint32(i).tobytes()
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = code
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.text.append(b"")
            else:
                plain = piece.replace(_MARK, " ")
                self.ids[plain] = (code, sp.get_score(i))
                self.text.append(plain.encode())
        self.size = np.array([len(t) for t in self.text])
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(self.text), np.uint8)
        self.spelled = min(s for _, s in self.ids.values() if s > -1e6) - 10
        self.longest = max(map(len, self.ids))
        self.find = ahocorasick.Automaton()
        for plain, (code, score) in self.ids.items():
            self.find.add_word(plain, (len(plain), code, score))
        self.find.make_automaton()
        self.pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        # characters of longer pieces are classes from 1, all others class 0;
        # two classes that stand together in a piece, and the pieces' trie
        # with edges keyed by (node, class)
        known = sorted({c for p in self.pairs for c in p})
        self.classes = len(known) + 1
        self.class_of = np.zeros(0x110000, np.int32)
        self.class_of[[ord(c) for c in known]] = np.arange(1, self.classes)
        self.joined = np.zeros((self.classes, self.classes), bool)
        for x, y in self.pairs:
            self.joined[self.class_of[ord(x)], self.class_of[ord(y)]] = True
        edges: dict[int, int] = {}
        piece_of = {0: -1}
        for plain, (code, _) in self.ids.items():
            node = 0
            for c in self.class_of[[ord(c) for c in plain]].tolist():
                if c == 0:
                    break
                node = edges.setdefault(node * self.classes + c, len(edges) + 1)
            else:
                piece_of[node] = int.from_bytes(code, "little")
        self.edge_keys = np.array(sorted(edges), np.int64)
        self.edge_to = np.array([edges[k] for k in self.edge_keys.tolist()], np.int64)
        self.piece_at = np.array([piece_of.get(k, -1) for k in range(len(edges) + 1)], np.int64)
        self.scores = np.zeros(len(self.text))
        for code, score in self.ids.values():
            self.scores[int.from_bytes(code, "little")] = score

    def spell(self, char: str) -> bytes:
        return b"".join(self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass"))

    def parts(self, word: str) -> list[str]:
        """The word cut wherever no piece can go on."""
        cuts = [0, *(i for i in range(1, len(word)) if word[i - 1:i + 1] not in self.pairs), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:])]

    def lattice(self, part: str) -> tuple[list[float], list[list]]:
        """Forward Viterbi: the best score up to every place, and the edges
        (length, ids, score) that end there."""
        size = len(part)
        best: list[float] = [0.0] * (size + 1)
        into: list[list] = [[] for _ in best]
        for last, piece in self.find.iter(part):
            into[last + 1].append(piece)
        for end in range(1, size + 1):
            edges, top, single = into[end], _LOWEST, False
            for length, _, score in edges:
                total = best[end - length] + score
                if total > top:
                    top = total
                if length == 1:
                    single = True
            if not single:
                edges.append((1, self.spell(part[end - 1]), self.spelled))
                top = max(top, best[end - 1] + self.spelled)
            best[end] = top
        return best, into

    def best(self, part: str) -> tuple[float, bytes, float]:
        """Score and ids of the best segmentation, and its lead over the
        second: that leaves the best path, seen from the end, by one other
        edge into a place of it and is best before that edge."""
        best, into = self.lattice(part)
        place, lead, codes = len(part), -_LOWEST, []
        while place:
            top, chosen = best[place], None
            for edge in reversed(into[place]):
                gap = top - best[place - edge[0]] - edge[2]
                if chosen is None and gap == 0:
                    chosen = edge
                elif gap < lead:
                    lead = gap
            codes.append(chosen[1])
            place -= chosen[0]
        return best[-1], b"".join(reversed(codes)), lead

    def edges(self, codes: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces in many parts at once, down the trie from every
        character: (start, length, piece).  ``codes`` are classes of
        characters, ``left`` how many are left of the part."""
        at, node, out = np.arange(len(codes)), np.zeros(len(codes), np.int64), []
        for length in range(1, self.longest + 1):
            alive = left[at] >= length
            at, node = at[alive], node[alive]
            key = node * self.classes + codes[at + (length - 1)]
            place = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
            found = self.edge_keys[place] == key
            at, node = at[found], self.edge_to[place[found]]
            if not len(at):
                break
            piece = self.piece_at[node]
            whole = piece >= 0
            out.append((at[whole], np.full(int(whole.sum()), length), piece[whole]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*out))

    def best_of_many(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes | None]]:
        """``best`` of many parts of two or more characters (as ``parts`` cuts
        them, so every character is one of a longer piece) side by side:
        scores, leads, ids (None where a character has to be spelled).  All
        places that are k characters into their part are done in one step."""
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(size)
        total, part = int(ends[-1]), np.repeat(np.arange(len(parts)), size)
        codes = self.class_of[np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4")].astype(np.int64)
        at, length, piece = self.edges(codes, np.repeat(ends, size) - np.arange(total))
        alone = np.ones(total, bool)
        alone[at[length == 1]] = False
        spelled = np.flatnonzero(alone)
        at, length = np.r_[at, spelled], np.r_[length, np.ones(len(spelled), np.int64)]
        piece = np.r_[piece, np.full(len(spelled), -1)]
        score = np.where(piece < 0, self.spelled, self.scores[piece])
        # a part of n characters has n + 1 places
        first = ends - size + np.arange(len(parts))
        source = at + part[at]
        target = source + length
        depth = target - first[part[at]]
        order = np.argsort((depth * (total + len(parts) + 1) + target) * (self.longest + 1) + length)
        source, target, piece, score, depth = source[order], target[order], piece[order], score[order], depth[order]
        group = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
        place = target[group]
        best = np.zeros(total + len(parts))
        steps = np.searchsorted(depth, np.arange(1, int(size.max()) + 2))
        for a, b in zip(steps.tolist(), steps[1:].tolist()):
            x, y = np.searchsorted(group, (a, b))
            best[place[x:y]] = np.maximum.reduceat(best[source[a:b]] + score[a:b], group[x:y] - a)
        # the shortest of the best edges into a place, and its lead there
        gain = best[source] + score
        tops = np.flatnonzero(gain == best[target])
        tops = tops[np.r_[True, target[tops[1:]] != target[tops[:-1]]]]
        chosen, gap = np.zeros(len(best), np.int64), np.zeros(len(best))
        chosen[place] = tops
        gain[tops] = _LOWEST
        gap[place] = best[place] - np.maximum.reduceat(gain, group)
        # back along the best paths, one edge of every part a step
        which, now, lead, path = np.arange(len(parts)), first + size, np.full(len(parts), -_LOWEST), []
        while len(which):
            edge = chosen[now]
            lead[which] = np.minimum(lead[which], gap[now])
            path.append((which, piece[edge]))
            now = source[edge]
            going = now > first[which]
            which, now = which[going], now[going]
        of, ids = (np.concatenate(x) for x in zip(*reversed(path)))
        order = np.argsort(of, kind="stable")
        of, ids = of[order], ids[order]
        cut = np.searchsorted(of, np.arange(len(parts) + 1))
        spell = np.zeros(len(parts), bool)
        spell[of[ids < 0]] = True
        data, cut = ids.astype("<u4").tobytes(), (4 * cut).tolist()
        return best[first + size], lead, [None if no else data[a:b] for no, a, b in zip(spell.tolist(), cut, cut[1:])]

    def nbest(self, part: str, n: int) -> list[tuple[float, bytes]]:
        """The n best segmentations, best first: backward A*, in which
        ``best[place]`` is the exact score of what is still to come.  Of equal
        totals the newest goes on, so a tie costs one path only."""
        best, into = self.lattice(part)
        size, out = len(part), []
        heap, serial = [(-best[size], 0, size, 0.0, None)], 0
        push, pop = heapq.heappush, heapq.heappop
        while heap and len(out) < n:
            total, _, place, behind, path = pop(heap)
            if place == 0:
                codes = []
                while path:
                    codes.append(path[0])
                    path = path[1]
                out.append((-total, b"".join(codes)))
                continue
            for length, code, score in into[place]:
                serial -= 1
                after = behind + score
                start = place - length
                push(heap, (-best[start] - after, serial, start, after, (code, path)))
        return out


def n_highest(lists: list[list[tuple[float, bytes]]], n: int):
    """The n highest sums of one choice from each list, with the choices;
    lists are in descending order."""
    first = (0,) * len(lists)
    heap, known = [(-sum(x[0][0] for x in lists), first)], {first}
    for _ in range(n):
        if not heap:
            return
        loss, pick = heapq.heappop(heap)
        yield -loss, [x[k] for x, k in zip(lists, pick)]
        for i, choices in enumerate(lists):
            if pick[i] + 1 < len(choices):
                after = (*pick[:i], pick[i] + 1, *pick[i + 1:])
                if after not in known:
                    known.add(after)
                    heapq.heappush(heap, (loss + choices[pick[i]][0] - choices[pick[i] + 1][0], after))


class Encoder:
    """Keeps the best segmentation of parts it has met (up to a bound), and
    the n best of those parts whose second choice was wanted."""

    def __init__(self, path: str, n: int = NBEST) -> None:
        self.pieces, self.n = Pieces(path), n
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.part: list[str] = []
        self.size, self.start = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, "<u4")
        self.score, self.lead = np.zeros(0), np.zeros(0)
        self.more: dict[int, list[tuple[float, bytes]]] = {}

    def _learn(self, parts: list[str]) -> None:
        many = [p for p in parts if 1 < len(p) <= SIDE_BY_SIDE]
        rest = [p for p in parts if not 1 < len(p) <= SIDE_BY_SIDE]
        scores, leads, codes = self.pieces.best_of_many(many) if many else (np.zeros(0), np.zeros(0), [])
        scores, leads = scores.tolist(), leads.tolist()
        for i, c in enumerate(codes):
            if c is None:
                codes[i] = self.pieces.best(many[i])[1]
        for p in rest:
            got = self.pieces.best(p)
            scores.append(got[0])
            codes.append(got[1])
            leads.append(got[2])
        size = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        self.place.update(zip(many + rest, range(len(self.part), len(self.part) + len(parts))))
        self.part += many + rest
        self.start = np.r_[self.start, np.cumsum(size) - size + len(self.flat)]
        self.size = np.r_[self.size, size]
        self.flat = np.r_[self.flat, np.frombuffer(b"".join(codes), "<u4")]
        self.score, self.lead = np.r_[self.score, scores], np.r_[self.lead, leads]

    def choices(self, at: int) -> list[tuple[float, bytes]]:
        """The n best of a part; searched only where they may be wanted."""
        got = self.more.get(at)
        if got is None:
            got = self.more[at] = self.pieces.nbest(self.part[at], self.n)
        return got

    def _places(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The parts of all texts, one after the other, and where each text's
        begin."""
        spaced = [" " + t if t else "" for t in texts]
        whole = "".join(spaced)
        chars = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4")
        codes = self.pieces.class_of[chars]
        cut = np.ones(len(chars), bool)
        cut[1:] = ~self.pieces.joined[codes[:-1], codes[1:]]
        begins = np.cumsum([0] + [len(t) for t in spaced])
        cut[begins[:-1][begins[:-1] < len(chars)]] = True
        width = 1 + (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)
        cuts = np.flatnonzero(cut)
        offsets = np.r_[np.r_[0, np.cumsum(width)][cuts], width.sum()].astype(np.int32)
        parts = pa.StringArray.from_buffers(
            len(cuts), pa.py_buffer(offsets), pa.py_buffer(whole.encode("utf-8", "surrogatepass"))).dictionary_encode()
        distinct = parts.dictionary.to_pylist()
        new, held, chars_held = [p for p in distinct if p not in self.place], [], 0
        for p in new:
            held.append(p)
            chars_held += len(p)
            if chars_held > LEARN_CHARS:
                self._learn(held)
                held, chars_held = [], 0
        if held:
            self._learn(held)
        place = np.fromiter(map(self.place.__getitem__, distinct), np.int64, len(distinct))
        return place[parts.indices.to_numpy(zero_copy_only=False)], np.searchsorted(cuts, begins)

    def encode(self, texts: list[str]) -> list[list[tuple[float, bytes]]]:
        """For each text its n best (score, ids as 32-bit little-endian)."""
        if len(self.place) > CACHE_PARTS:
            self._forget()
        at, begins = self._places(texts)
        size, score, lead = self.size[at], self.score[at], self.lead[at]
        ends = np.r_[0, np.cumsum(size)]
        data = self.flat[np.arange(ends[-1]) + np.repeat(self.start[at] - ends[:-1], size)].tobytes()
        out = []
        for a, b in zip(begins.tolist(), begins[1:].tolist()):
            leads, codes = lead[a:b], data[4 * ends[a]:4 * ends[b]]
            # only the n - 1 parts of smallest lead can differ from the best
            near = np.argsort(leads, kind="stable")[:self.n - 1] if b - a < 64 else np.argpartition(
                leads, self.n - 1)[:self.n - 1]
            near = sorted(int(i) for i in near if leads[i] < -_LOWEST)
            lists = [self.choices(int(at[a + i])) for i in near]
            rest = float(score[a:b].sum()) - sum(x[0][0] for x in lists)
            spans = [(4 * int(ends[a + i] - ends[a]), 4 * int(ends[a + i + 1] - ends[a])) for i in near]
            found = []
            for s, pick in n_highest(lists, self.n):
                done, patched = 0, []
                for (x, y), choice in zip(spans, pick):
                    patched += [codes[done:x], choice[1]]
                    done = y
                found.append((s + rest, b"".join([*patched, codes[done:]])))
            out.append(found)
        return out

    def decode(self, codes: bytes) -> str:
        ids = np.frombuffer(codes, "<u4")
        size = self.pieces.size[ids]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.pieces.start[ids] - (ends - size), size)
        return self.pieces.flat[at].tobytes().decode("utf-8", "surrogatepass")[1:]


def _lists(groups: list[list], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0] + [len(g) for g in groups]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array([x for g in groups for x in g], kind))


def encode(docs: DataFrame, n: int = NBEST, path: str | None = None) -> DataFrame:
    """(doc_id, ids, score, nbest): ids and score of the best segmentation,
    and the n best as structs of score and ids."""
    return summary(docs, n, path, with_ids=True).select("doc_id", "ids", "score", "nbest")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""
    path = path or model_path()

    def run(batches):
        coder = Encoder(path, 1)
        for batch in batches:
            texts = [None if i is None else coder.decode(np.asarray(i, "<u4").tobytes())
                     for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])
    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def _id_lists(codes: list[bytes], null: list[bool] | None = None) -> pa.ListArray:
    """Lists of ids of their 32-bit little-endian codes."""
    ends = np.cumsum([0] + [len(c) // 4 for c in codes]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(codes), "<i4")),
                                    mask=None if null is None else pa.array(null, pa.bool_()))


def summary(docs: DataFrame, n: int = NBEST, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Per document: pieces and score of the best segmentation, CRC-32 of its
    ids and of the text decoded from them, and the scores and CRC-32s of the n
    best.  With ``with_ids`` also the columns of ``encode`` and the decoded text
    (``decoded``), in the same pass; a null text has null in all of them."""
    path = path or model_path()

    def run(batches):
        coder = Encoder(path, n)
        for whole in batches:
            for batch in by_bytes(whole, 1, TEXT_BYTES):
                texts = [t.as_py() for t in batch.column(1)]
                found = coder.encode([t or "" for t in texts])
                back = [coder.decode(f[0][1]) for f in found]
                columns = {
                    "doc_id": batch.column(0), "n_pieces": pa.array([len(f[0][1]) // 4 for f in found], pa.int64()),
                    "score": pa.array([f[0][0] for f in found], pa.float64()),
                    "ids_crc32": pa.array([zlib.crc32(f[0][1]) for f in found], pa.int64()),
                    "decoded_crc32": pa.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in back], pa.int64()),
                    "nbest_scores": _lists([[s for s, _ in f] for f in found], pa.float64()),
                    "nbest_crc32": _lists([[zlib.crc32(c) for _, c in f] for f in found], pa.int64())}
                if with_ids:
                    null = [t is None for t in texts]
                    every = pa.StructArray.from_arrays(
                        [pa.array([s for f in found for s, _ in f], pa.float64()),
                         _id_lists([c for f in found for _, c in f])], names=["score", "ids"])
                    ends = pa.array(np.cumsum([0] + [len(f) for f in found]).astype(np.int32))
                    columns |= {
                        "score": pa.array([None if no else f[0][0] for no, f in zip(null, found)], pa.float64()),
                        "ids": _id_lists([f[0][1] for f in found], null),
                        "nbest": pa.ListArray.from_arrays(ends, every, mask=pa.array(null, pa.bool_())),
                        "decoded": pa.array([None if no else t for no, t in zip(null, back)], pa.string())}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    return columns_or_null(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, n_pieces long, score double, ids_crc32 long, decoded_crc32 long, "
             "nbest_scores array<double>, nbest_crc32 array<long>" + (
                 ", ids array<int>, nbest array<struct<score:double,ids:array<int>>>, decoded string" if with_ids else ""))
