"""Token counts (operator 12) by a compiled finite-state tokenizer.

The model's byte-pair merging is compiled into a deterministic transducer over
character classes.  Two facts make it finite.  The pieces of a merged text are
exactly the sequence in which every two neighbours stand when they are merged
alone, so the last piece of every prefix is determined; and which piece that is
depends only on the last pieces of the prefixes from which a piece of the
model could still reach over the place.  A state holds those: the last piece,
and for every start that is still open its node in the trie of pieces, the last
piece before it and its count.  A transition carries the emitted-token count:
tokens of the prefix with the character less those without it (a merge across
may make it zero or negative).  States and transitions are made when a text
first needs them and kept in arrays.

Texts are divided into chunks of ``CHUNK`` characters, all chunks of a batch
run side by side, one array step per character.  No piece holds certain pairs of
neighbouring characters; behind such a pair the state no longer depends on
what stood before.  So a chunk's state map (entry state to exit state and
count) is a constant exit behind its first such pair, and only the stretch
before it depends on the entry.  The maps are composed by a prefix scan (the
last constant map wins, maps without such a pair are applied to what it gives),
and then the stretches run from their entries.

One pass, no shuffle; the compiled model (trie, merge times; the size of the
vocabulary) is broadcast.  A worker's transition table is emptied at
``STATES`` states; a batch that needs more alone is counted state by state with
a bounded cache.

Defined results: a null or empty text has no tokens; null ids and repeated rows
are counted like others; very long texts are counted whole; an empty table
gives an empty result; other columns are not read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_or_null
from .fim import byte_slices

CHUNK = 256
BATCH_BYTES = 1 << 20
STATES = 131_072
LIMIT = 4096
FEW = 12
_MARK = "▁"
_NEVER = float("-inf")
_START = (-1, ())


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def merge_edges(text: str, score: dict[str, float]):
    """Merge ``text`` by itself.  None unless one piece is left; else the
    symbols at its right and its left edge from the character to the whole,
    each with the time (score) at which it is merged into the next; later
    times are lower, the whole lasts for ever."""
    parts = [(c, 0.0) for c in text]
    right, left = [], []
    while len(parts) > 1:
        at, best = -1, _NEVER
        for i in range(len(parts) - 1):
            got = score.get(parts[i][0] + parts[i + 1][0], _NEVER)
            if got > best:
                at, best = i, got
        if at < 0:
            return None
        (a, ta), (b, tb) = parts[at], parts[at + 1]
        # a merge cannot come before its parts are there
        made = min(best, ta, tb) if len(a) > 1 or len(b) > 1 else best
        if at + 2 == len(parts):
            right.append((b, made))
        if at == 0:
            left.append((a, made))
        parts[at:at + 2] = [(a + b, made)]
    return [*right, (text, _NEVER)], [*left, (text, _NEVER)]


class Model:
    """What the transducer needs of the vocabulary, as plain tables."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        score, chars = {}, set()
        for i in range(sp.get_piece_size()):
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                score[sp.id_to_piece(i)] = sp.get_score(i)
        for piece in score:
            if len(piece) > 1:
                chars.update(piece)
        self.score = {p: s for p, s in score.items() if len(p) > 1}
        # classes: characters of longer pieces, other characters with a piece,
        # and characters spelled in 1 to 4 byte pieces
        self.chars = sorted(chars)
        self.lone = sorted(p for p in score if len(p) == 1 and p not in chars)
        k = len(self.chars)
        self.width = k + 5
        #: tokens of a character that stays alone
        self.weight = [1 if c in score else len(c.encode()) for c in self.chars] + [1, 1, 2, 3, 4]
        number = {c: i for i, c in enumerate(self.chars)}
        self.pairs = np.zeros((self.width, self.width), bool)
        self.tokens: list[str] = list(self.chars)
        self.right = [[(c, _NEVER)] for c in self.chars]
        self.left = [[(c, _NEVER)] for c in self.chars]
        # trie: (node, class) -> node; the token that ends in a node
        self.child: dict[tuple[int, int], int] = {}
        self.token_at: list[int] = [-1]
        self.inner: set[int] = set()

        def insert(text: str, token: int) -> None:
            node = 0
            for c in text:
                at = (node, number[c])
                if at not in self.child:
                    self.inner.add(node)
                    self.child[at] = len(self.token_at)
                    self.token_at.append(-1)
                node = self.child[at]
            self.token_at[node] = token

        for i, c in enumerate(self.chars):
            insert(c, i)
        for piece in self.score:
            for a, b in zip(piece, piece[1:]):
                self.pairs[number[a], number[b]] = True
            edges = merge_edges(piece, self.score)
            if edges:
                insert(piece, len(self.tokens))
                self.tokens.append(piece)
                self.right.append(edges[0])
                self.left.append(edges[1])
        self.last_class = [number[t[-1]] for t in self.tokens]
        # tokens that no merge across can tell apart: the same right edge, as
        # far as its symbols begin a piece
        begins = {p[:i] for p in self.score for i in range(1, len(p))}
        alike: dict[tuple, int] = {}
        self.like = []
        for token, edge in enumerate(self.right):
            while edge and edge[-1][0] not in begins:
                edge = edge[:-1]
            self.like.append(alike.setdefault((self.last_class[token], *edge), token))
        below: dict[int, list[int]] = {}
        for (node, _), to in self.child.items():
            below.setdefault(node, []).append(to)
        # tokens further down from a node, where they are few
        self.few: dict[int, list[int]] = {}
        for node in sorted(below, reverse=True):  # children have higher numbers
            got: list[int] | None = []
            for to in below[node]:
                deeper = self.few.get(to) if to in below else []
                got = None if got is None or deeper is None else (
                    got + deeper + ([self.token_at[to]] if self.token_at[to] >= 0 else []))
            if got is not None and len(got) <= FEW:
                self.few[node] = got

    def lookup(self) -> np.ndarray:
        """The class of every code point."""
        k = len(self.chars)
        out = np.full(0x110000, k + 4, np.int16)
        out[:0x10000], out[:0x800], out[:0x80] = k + 3, k + 2, k + 1
        out[[ord(c) for c in self.lone]] = k
        out[[ord(c) for c in self.chars]] = range(k)
        if _MARK in self.chars:
            out[32] = out[ord(_MARK)]
        return out


class Full(Exception):
    pass


class Transducer:
    """Counts tokens; its states and transitions grow with the texts met."""

    def __init__(self, model: Model, states: int = STATES, chunk: int = CHUNK) -> None:
        self.m, self.limit, self.chunk = model, states, chunk
        self.lookup, self.stand, self.reach = model.lookup(), {}, {}
        self._forget()

    def _forget(self) -> None:
        self.number, self.state = {_START: 0}, [_START]
        self.next = np.full((1024, self.m.width), -1, np.int32)
        self.emits = np.zeros((1024, self.m.width), np.int8)
        self.maps: dict[tuple[int, bytes], tuple[int, int]] = {}

    def stands(self, a: int, b: int) -> bool:
        """Whether two tokens side by side stay as they are: no symbol at the
        right edge of the first is merged with one at the left edge of the
        second before either is merged inwards (ties go to the left)."""
        got = self.stand.get((a, b))
        if got is None:
            if len(self.stand) > 4_000_000:
                self.stand.clear()
            r, l, i, j, got = self.m.right[a], self.m.left[b], 0, 0, True
            score = self.m.score.get
            while True:
                (x, at_left), (y, at_right) = r[i], l[j]
                across = score(x + y)
                if across is not None and across > at_left and across >= at_right:
                    got = False
                    break
                if at_left == at_right == _NEVER:
                    break
                if at_left >= at_right:
                    i += 1
                else:
                    j += 1
            self.stand[a, b] = got
        return got

    def open(self, node: int, before: int) -> bool:
        """Whether a token further down the trie can follow ``before`` (taken
        for granted where there are many)."""
        few = self.m.few.get(node)
        if few is None or before < 0:
            return True
        got = self.reach.get((node, before))
        if got is None:
            if len(self.reach) > 2_000_000:
                self.reach.clear()
            got = self.reach[node, before] = any(self.stands(before, t) for t in few)
        return got

    def step(self, state: tuple, kind: int) -> tuple[tuple, int]:
        """The state after one more character of class ``kind``, and how many
        tokens more the prefix has."""
        m, (last, opened) = self.m, state
        if kind >= len(m.chars):
            return _START, m.weight[kind]
        if last >= 0 and not m.pairs[m.last_class[last], kind]:
            last, opened = -1, ()  # nothing reaches over this place
        chosen, more, going = None, 0, []
        for node, before, count in (*opened, (0, last, 0)):
            node = m.child.get((node, kind))
            if node is None:
                continue
            token = m.token_at[node]
            if chosen is None and token >= 0 and (before < 0 or self.stands(before, token)):
                chosen, more = token, count + (m.weight[token] if token < len(m.chars) else 1)
            if node in m.inner and self.open(node, before):
                going.append((node, before, count))
        return (m.like[chosen], tuple([(n, b, c - more) for n, b, c in going])), more

    def _make(self, row: int, kind: int) -> None:
        state, more = self.step(self.state[row], kind)
        to = self.number.get(state)
        if to is None:
            if len(self.state) >= self.limit:
                raise Full
            to = self.number[state] = len(self.state)
            self.state.append(state)
            if to >= len(self.next):
                self.next = np.concatenate([self.next, np.full_like(self.next, -1)])
                self.emits = np.concatenate([self.emits, np.zeros_like(self.emits)])
        self.next[row, kind], self.emits[row, kind] = to, more

    def run(self, kinds: np.ndarray, at: np.ndarray, size: np.ndarray, entry: np.ndarray):
        """Exit states and counts of many stretches (first place, length, entry
        state), all one character a step, longest first."""
        order = np.argsort(-size, kind="stable")
        place, length, state = at[order], size[order], entry[order].astype(np.int64)
        count, live = np.zeros(len(order), np.int64), len(order)
        for s in range(int(length[0]) if live else 0):
            while length[live - 1] <= s:
                live -= 1
            kind, now = kinds[place[:live] + s], state[:live]
            to = self.next[now, kind]
            if (to < 0).any():
                missing = np.flatnonzero(to < 0)
                for code in np.unique(now[missing] * self.m.width + kind[missing]).tolist():
                    self._make(*divmod(code, self.m.width))
                to = self.next[now, kind]
            count[:live] += self.emits[now, kind]
            state[:live] = to
        exits, counts = np.empty_like(state), np.empty_like(count)
        exits[order], counts[order] = state, count
        return exits, counts

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        some = [i for i, t in enumerate(texts) if t]
        if not some:
            return out
        joined = _MARK + _MARK.join(texts[i] for i in some)
        kinds = self.lookup[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")].astype(np.int64)
        first = np.cumsum([0] + [len(texts[i]) + 1 for i in some])
        try:
            out[some] = self._counts(kinds, first)
        except Full:
            self._forget()
            try:
                out[some] = self._counts(kinds, first)
            except Full:
                self._forget()
                out[some] = [self._plain(kinds[a:b]) for a, b in zip(first, first[1:])]
        return out

    def _counts(self, kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
        # chunks of every text
        size, chunk = np.diff(first), self.chunk
        many = -(-size // chunk)
        head = np.cumsum(many) - many
        at = np.repeat(first[:-1], many) + chunk * (np.arange(many.sum()) - np.repeat(head, many))
        end = np.minimum(at + chunk, np.repeat(first[1:], many))
        # places behind which the state is that of a text's start
        fresh = ~self.m.pairs[np.r_[0, kinds[:-1]], kinds]
        fresh[first[:-1]] = True
        places = np.flatnonzero(fresh)
        where = np.searchsorted(places, at)
        found = np.r_[places, len(kinds)][where]
        constant = found < end
        cut = np.where(constant, found, end)
        # the constant part of every map
        exits, count = self.run(kinds, cut, end - cut, np.zeros(len(at), np.int32))
        # scan: the entry of a chunk is the exit of the last constant map
        # before it, led through the maps in between
        index = np.arange(len(at))
        source = np.maximum.accumulate(np.where(constant, index, 0))
        for i in index[~constant].tolist():
            exits[i], count[i] = self._map(int(exits[i - 1]), kinds[at[i]:end[i]])
        assert constant[0] and (source <= index).all()
        lead = index[constant & (cut > at)]
        count[lead] += self.run(kinds, at[lead], cut[lead] - at[lead], exits[lead - 1])[1]
        return np.add.reduceat(count, head)

    def _map(self, entry: int, kinds: np.ndarray) -> tuple[int, int]:
        """The map of a chunk without a fresh place, at one entry state."""
        key = (entry, kinds.tobytes())
        got = self.maps.get(key)
        if got is None:
            state, count = entry, 0
            for kind in kinds.tolist():
                if self.next[state, kind] < 0:
                    self._make(state, kind)
                count += int(self.emits[state, kind])
                state = int(self.next[state, kind])
            if len(self.maps) > 10_000:
                self.maps.clear()
            got = self.maps[key] = (state, count)
        return got

    def _plain(self, kinds: np.ndarray) -> int:
        """State by state, with a small cache: for texts of too many states."""
        state, count, known = _START, 0, {}
        for kind in kinds.tolist():
            got = known.get((state, kind))
            if got is None:
                if len(known) > self.limit:
                    known.clear()
                got = known[state, kind] = self.step(state, kind)
            state, count = got[0], count + got[1]
        return count


def count_tokens(docs: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit): what the library's plain
    ``encode`` gives, by the compiled transducer."""
    sc = docs.sparkSession.sparkContext
    tables = sc.broadcast(Model(path or model_path()).__dict__)

    def run(batches):
        model = Model.__new__(Model)
        model.__dict__.update(tables.value)
        machine = Transducer(model)
        for batch in batches:
            for part in byte_slices(batch, BATCH_BYTES):
                texts = [t or "" for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(machine.counts(texts))],
                                                 names=["doc_id", "n_bytes", "n_tokens"])

    rows = columns_or_null(docs, doc_id="long", text="string").withColumn(
        "n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
