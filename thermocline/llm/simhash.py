"""SimHash near-duplicates (operator 2).

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, 4-word shingles
with repeats; bit set when set in over half of the shingles' XXH64 (seed 42).
Documents link when their fingerprints differ in at most ``max_bits`` bits;
classes are the connected components.

Search, by a Gray-order hierarchical index, spread over tasks:

1. Equal fingerprints fold into one code (aggregated before any exchange), so
   a group of copies of any size is one row from here on.
2. Top nodes: of ``max_bits + 1`` bit bands, two linked codes agree on at
   least one, so each code goes to the node of each of its bands (a masked
   bit pattern).  A node with more than ``node_limit`` codes is divided again
   by bands of its other bits, repeatedly, so no task gets an unbounded node.
3. Inside a node, codes are sorted by Gray rank; runs of them form tree nodes
   that keep the bits all members share.  A self-join walks pairs of tree
   nodes from the top, adds up the differing shared bits and drops a pair of
   groups once the sum passes ``max_bits``; survivors are compared exactly.
4. Each node returns a spanning forest of its links (never all pairs); the
   components of these edges are found by repeated min-neighbour steps with
   a staged table after each.

Defined results: a null or empty text has fingerprint zero and links like any
other; a null ``doc_id`` takes part, but a class is named after its smallest
id that is not null; repeated rows are kept as rows; an empty table gives an
empty result; a very long text is hashed whole, in bounded work space; other
columns are not read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_or_null, fresh, staged

SHINGLE = 4
MAX_BITS = 4
NODE_LIMIT = 50_000
BRANCH = 16


# --- fingerprints -----------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    import xxhash
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    h64 = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    join = b" ".join
    hashes = np.fromiter((h64(join(words[i:i + shingle]), 42) for i in range(n)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounded work space for very long texts
        ones += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, code): the fingerprint as a BIGINT with the same 64 bits."""
    def run(batches):
        for batch in batches:
            codes = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes.view(np.int64))],
                                             names=["doc_id", "code"])
    return columns_or_null(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, code long")


# --- bands: the masked patterns of the top nodes -----------------------------

def bands(bits: list[int], parts: int) -> list[list[int]]:
    """``bits`` dealt into ``parts`` runs of near-equal length."""
    cut = [len(bits) * i // parts for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(cut, cut[1:])]


def _masks(parts: int) -> list[int]:
    return [sum(1 << b for b in band) for band in bands(list(range(64)), parts)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def top_nodes(codes: DataFrame, max_bits: int, node_limit: int) -> DataFrame:
    """(mask, pattern, code): one row per code and top node.  The mask is the
    set of bits fixed so far; over-full nodes are refined on their free bits.
    Codes are distinct, so refining ends at the latest when all bits are
    fixed and each node holds one code."""
    def spread(df: DataFrame, masks) -> DataFrame:
        node = F.explode(masks).alias("mask")
        return df.select("code", node).withColumn("pattern", F.col("code").bitwiseAND(F.col("mask")))

    parts = max_bits + 1
    todo = spread(codes, F.array(*[F.lit(_signed(m)) for m in _masks(parts)]))
    done = None
    while True:
        size = todo.groupBy("mask", "pattern").count()
        over = staged(size.filter(F.col("count") > node_limit), "simhash-over")
        if over.isEmpty():
            return todo if done is None else done.unionByName(todo)
        fits = todo.join(over, ["mask", "pattern"], "left_anti")
        done = fits if done is None else done.unionByName(fits)
        # new masks for the few mask values that occur (bounded by the bands,
        # not by the data)
        finer = []
        for (mask,) in over.select("mask").distinct().collect():
            free = [b for b in range(64) if not (mask >> b) & 1]
            split = [p for p in bands(free, parts) if p]
            # fewer free bits than parts: fixing any all-but-max_bits of them
            # is finished by the exact compare, so fix none and stop refining
            new = [_signed((mask & (2**64 - 1)) | sum(1 << b for b in p)) for p in split]
            finer.append((mask, new if len(free) >= parts else [mask]))
        if all(new == [mask] for mask, new in finer):
            return done.unionByName(todo.join(over, ["mask", "pattern"], "left_semi"))
        table = todo.sparkSession.createDataFrame(finer, "mask long, finer array<long>")
        todo = staged(spread(todo.join(over, ["mask", "pattern"], "left_semi")
                             .join(F.broadcast(table), "mask").select("code", "finer")
                             , F.col("finer")).distinct(), "simhash-finer")


# --- the tree inside a node ---------------------------------------------------

def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the binary reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Codes of several nodes, sorted by (node, Gray rank).  Level 0 holds
    the codes, each level above one entry per run of ``BRANCH`` entries of
    one node: the bits all members share (``fixed``) and their values
    (``value``)."""

    def __init__(self, node: np.ndarray, codes: np.ndarray) -> None:
        order = np.lexsort((gray_rank(codes), node))
        self.order, node, codes = order, node[order], codes[order]
        self.levels = [(np.full(len(codes), 2**64 - 1, np.uint64), codes)]
        self.kids: list[np.ndarray] = []
        low = high = codes
        while len(np.unique(node)) < len(node):
            starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            group = np.repeat(starts, np.diff(np.r_[starts, len(node)]))
            cut = np.flatnonzero((np.arange(len(node)) - group) % BRANCH == 0)
            low, high = np.bitwise_and.reduceat(low, cut), np.bitwise_or.reduceat(high, cut)
            self.kids.append(np.r_[cut, len(node)])
            node = node[cut]
            self.levels.append((~(low ^ high), low))

    def links(self, max_bits: int, chunk: int = 1 << 18):
        """Arrays (i, j) of positions in the sorted order with at most
        ``max_bits`` differing bits, i < j, block by block."""
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][0]))
        stack = [(top, False, roots, roots, np.zeros(len(roots), np.uint8), np.zeros(len(roots), np.uint64))]
        while stack:
            level, near, a, b, differ, seen = stack.pop()
            # one block at a time, the rest waits below it: depth first, so
            # work space is a few blocks per level
            if not near:
                if len(a) > chunk:
                    stack.append((level, False, *(x[chunk:] for x in (a, b, differ, seen))))
                    a, b, differ, seen = (x[:chunk] for x in (a, b, differ, seen))
                # differences on bits that became shared at this level are
                # added to those of the levels above
                fixed, value = self.levels[level]
                both = fixed[a] & fixed[b]
                differ = differ + np.bitwise_count((value[a] ^ value[b]) & both & ~seen)
                keep = differ <= max_bits
                if level == 0:
                    keep &= a < b
                a, b, differ, seen = a[keep], b[keep], differ[keep], both[keep]
                if level == 0:
                    if len(a):
                        yield a, b
                    continue
            if not len(a):
                continue
            kids = self.kids[level - 1]
            na, nb = kids[a + 1] - kids[a], kids[b + 1] - kids[b]
            pairs = na * nb
            hi = max(1, int(np.searchsorted(np.cumsum(pairs), chunk, "right")))
            if hi < len(a):
                stack.append((level, True, *(x[hi:] for x in (a, b, differ, seen))))
            pairs = pairs[:hi]
            p = np.repeat(np.arange(hi), pairs)
            k = np.arange(len(p)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            x, y = kids[a[p]] + k // nb[p], kids[b[p]] + k % nb[p]
            once = x <= y
            p = p[once]
            stack.append((level - 1, False, x[once], y[once], differ[p], seen[p]))


class Forest:
    """Union-find over positions; ``add`` returns the links that joined two
    trees."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        made, root = [], self.root
        while True:
            ra, rb = root[a], root[b]
            while (flat := root[ra] != ra).any():
                ra = np.where(flat, root[ra], ra)
            while (flat := root[rb] != rb).any():
                rb = np.where(flat, root[rb], rb)
            open_ = ra != rb
            if not open_.any():
                return made
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            lo, hi = np.minimum(ra, rb), np.maximum(ra, rb)
            # one link per larger root in a round, so trees stay trees
            _, first = np.unique(hi, return_index=True)
            root[hi[first]] = lo[first]
            made += zip(a[first].tolist(), b[first].tolist())


def _links_of_nodes(max_bits: int, batch_codes: int):
    """mapInArrow function over rows sorted by (mask, pattern)."""
    def forest(mask, pattern, code):
        change = np.ones(len(mask), bool)
        change[1:] = (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])
        node = np.cumsum(change)
        size = np.bincount(node)
        many = size[node] > 1
        index = GrayIndex(node[many], code[many].view(np.uint64))
        codes = index.levels[0][1].view(np.int64)
        trees, out = Forest(len(codes)), []
        if len(codes):
            for a, b in index.links(max_bits):
                out += trees.add(a, b)
        pairs = np.array(out, np.int64).reshape(-1, 2)
        x, y = codes[pairs[:, 0]], codes[pairs[:, 1]]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))],
                                          names=["a", "b"])

    def run(batches):
        held = [np.empty(0, np.int64)] * 3
        for batch in batches:
            held = [np.r_[h, batch.column(i).to_numpy()] for i, h in enumerate(held)]
            if len(held[0]) >= batch_codes:
                # the last node may go on in the next batch
                last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
                yield forest(*[h[~last] for h in held])
                held = [h[last] for h in held]
        yield forest(*held)
    return run


def links(codes: DataFrame, max_bits: int = MAX_BITS, node_limit: int = NODE_LIMIT) -> DataFrame:
    """(a, b), a < b: for every top node a spanning forest of the codes
    within ``max_bits``; together they connect what all links connect."""
    nodes = top_nodes(codes, max_bits, node_limit).select("mask", "pattern", "code")
    return (nodes.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern")
            .mapInArrow(_links_of_nodes(max_bits, 4 * node_limit), "a long, b long").distinct())


# --- components -----------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(node, root) of an undirected edge list (a, b): alternating large-star
    and small-star steps until the edges are stars.  Every step is two
    exchanges over the edges, staged in the shared folder."""
    edges = staged(edges.filter("a <> b"), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.filter("a <> b").distinct()  # a > b
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(low, "a").select(F.col("b").alias("x"), "m").filter("x <> m")
                 .unionByName(low.select(F.col("a").alias("x"), "m")).distinct())
        edges = staged(small.select(F.least("x", "m").alias("a"), F.greatest("x", "m").alias("b"))
                       .distinct(), "links")
        n, h = edges.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if (n, h) == mark:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        mark = (n, h)


def classes_of(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
               node_limit: int = NODE_LIMIT) -> DataFrame:
    """(doc_id, code, root, component_id), one row per row of ``docs``; ``root``
    is the least code of the class, known also where no row has an id."""
    marked = staged(fingerprints(docs, shingle), "fingerprints")
    first = staged(marked.groupBy("code").agg(F.min("doc_id").alias("least_id")), "codes")
    roots = components(links(first.select("code"), max_bits, node_limit))
    tied = first.join(roots, F.col("code") == F.col("node"), "left").select(
        "code", "least_id", F.coalesce("root", "code").alias("root"))
    # only codes that have a link need the second aggregation's result
    named = tied.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = staged(tied.join(named, "root").select("code", "root", "component_id"), "classes")
    return marked.join(classes, "code").select("doc_id", "code", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    node_limit: int = NODE_LIMIT) -> DataFrame:
    """(doc_id, code, component_id), one row per row of ``docs``."""
    return classes_of(docs, shingle, max_bits, node_limit).select("doc_id", "code", "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """Keep exactly one row of each class: that of its smallest ``doc_id``
    (null ids last), then of its smallest fingerprint, then of its smallest
    text (null first)."""
    found = staged(classes_of(docs, **options), "near")
    first = staged(found.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("nameless"), "doc_id", "code")).alias("x")).select("x.doc_id", "x.code"), "kept")
    # an id that only one row has tells that row; no sort of whole texts, the ids are the build side
    repeated = found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    repeated = staged(repeated, "repeated")
    plain = first.join(repeated, "doc_id", "left_anti").filter("doc_id is not null").select("doc_id")
    out = docs.join(plain.hint("shuffle_hash"), "doc_id", "left_semi").select(*docs.columns)
    odd = first.join(repeated, "doc_id", "left_semi").unionByName(first.filter("doc_id is null"))
    if odd.isEmpty():
        return out
    # repeated or missing ids: the row is known by its id and fingerprint
    mark = F.udf(lambda t: _signed(fingerprint(t, options.get("shingle", SHINGLE))), "long")
    same = docs.join(repeated, "doc_id", "left_semi").select(*docs.columns).unionByName(docs.filter("doc_id is null"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = same.select(F.col("doc_id").alias("id"), mark("text").alias("mark"), F.col("text").alias("t"),
                       whole.alias("row"))
    rows = rows.join(odd, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("mark") == F.col("code")), "left_semi")
    one = rows.groupBy("id", "mark").agg(F.min_by("row", F.struct(F.col("t").isNotNull(), F.col("t"))).alias("row"))
    return out.unionByName(one.select("row.*"))
