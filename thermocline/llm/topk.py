"""Exact top-k search (operator 10) by distributed histogram selection.

Integer vectors: floor(64 * x) per component.  Every query is scored against
every row, block against block; nothing but counts leaves a block until the
kth score of each query is known:

1. Each query has a score range (first: the Cauchy-Schwarz bound).  Blocks
   count scores in ``BINS`` equal parts of it, the last of which may be cut
   short by the range's end; the counts are summed over all blocks, and the
   part that holds the kth score becomes the next range.
2. When ranges are single values, the kth score is exact.  Blocks then return
   rows above it and, of the rows equal to it, the smallest ids that could
   still be wanted; a ranking by score and id ends it.

Blocks are pairs of a query block and a row block, joined on both block
numbers; block sizes are fixed, so the memory of a task is too.

Defined results: null vectors and vectors with a null or non-finite component
take no part, nor do rows without an id; rows that repeat an id stay apart:
each is a candidate, each asks as a query of its own, and a query leaves out
its own row only; of vectors of unlike length the common part is multiplied;
very long vectors cost memory in proportion to a block; an empty table gives an
empty result; scores are exact while components stay under 2 ** 24."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

K = 20
QUERY_BLOCK = 2048
ROW_BLOCK = 8192
BINS = 256
_SLICE = 256  # queries scored at once inside a block


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(row, vec_id, v), staged: the rows that take part; ``row`` tells rows
    of one id apart."""
    e = F.col(embedding).cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return staged(df.filter(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & finite)
                  .select(F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"),
                          F.transform(e, lambda x: F.floor(x * 64).cast("long")).alias("v")), "vectors")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as float64 rows, zeros behind shorter ones: products of
    components under 2**24 and their sums are exact."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _scores(queries: pa.Table, rows: pa.Table):
    """For slices of the queries: positions, integer scores against all rows
    of the block, and where a row is the query itself."""
    if not (queries.num_rows and rows.num_rows):
        return
    width = max(int(np.diff(t["v"].combine_chunks().offsets.to_numpy()).max(initial=0)) for t in (queries, rows))
    q, c = _matrix(queries["v"], width), _matrix(rows["v"], width)
    asks, row = queries["row"].to_numpy(), rows["row"].to_numpy()
    for at in range(0, len(asks), _SLICE):
        part = slice(at, at + _SLICE)
        yield part, (q[part] @ c.T).astype(np.int64), asks[part, None] == row


def _count_scores(span: int):
    """Histogram counts of a block pair, (row, bin, n): ``BINS`` parts of
    the ``span`` values from each query's ``lo`` on, none of them above its
    ``hi``."""
    width = -(-span // BINS)

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        asks, lo, hi = (queries[c].to_numpy() for c in ("row", "lo", "hi"))
        for part, s, own in _scores(queries, rows):
            up = s - lo[part, None]
            line, at = np.nonzero((up >= 0) & (s <= hi[part, None]) & ~own)
            n = np.bincount(line * BINS + up[line, at] // width, minlength=len(s) * BINS)
            hit = np.flatnonzero(n)
            for o, x in zip(out, (asks[part][hit // BINS], hit % BINS, n[hit])):
                o.append(x)
        return _table(("row", "bin", "n"), out)
    return run


def _reaching(queries: pa.Table, rows: pa.Table) -> pa.Table:
    """Rows of a block pair above the kth score ``lo``, and of those equal to
    it the ``left`` smallest ids."""
    out: list[list] = [[], [], [], []]
    asks, ids, kth, left = (queries[c].to_numpy() for c in ("row", "vec_id", "lo", "left"))
    rows = rows.sort_by("vec_id")
    cid = rows["vec_id"].to_numpy()
    for part, s, own in _scores(queries, rows):
        equal = (s == kth[part, None]) & ~own
        equal &= np.cumsum(equal, axis=1) <= left[part, None]
        i, j = np.nonzero((s > kth[part, None]) & ~own | equal)
        for o, x in zip(out, (asks[part][i], ids[part][i], cid[j], s[i, j])):
            o.append(x)
    return _table(("row", "query_id", "vec_id", "score"), out)


def _table(names, columns) -> pa.Table:
    return pa.table({name: pa.array(np.concatenate(x).astype(np.int64) if x else [], pa.int64())
                     for name, x in zip(names, columns)})


def _blocks(df: DataFrame, own: str, other: str, per_block: int, others: int, n: int) -> DataFrame:
    """Deal rows into blocks by a hash of the row number, once for every block of the
    other side."""
    mine = max(1, -(-n // per_block))
    return (df.withColumn(own, F.pmod(F.xxhash64("row", F.lit(3)), F.lit(mine)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, query_block: int = QUERY_BLOCK,
          row_block: int = ROW_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of ``vectors``, as ``integer_vectors``
    gives them, for ``queries``, rows of the same kind; a query does not find
    the row of its own number."""
    rows, asked = vectors, queries
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    n, most = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(norm), F.lit(0.0))).first()
    n_asked, most_asked = asked.agg(F.count(F.lit(1)), F.coalesce(F.max(norm), F.lit(0.0))).first()
    nq, nc = max(1, -(-n_asked // query_block)), max(1, -(-n // row_block))
    dealt = _blocks(rows, "cb", "qb", row_block, nq, n).groupBy("qb", "cb")

    def with_rows(state):
        return _blocks(state, "qb", "cb", query_block, nc, n_asked).groupBy("qb", "cb").cogroup(dealt)

    # ``left``: how many of the rows scored from ``lo`` to ``hi``, at most
    # ``span`` values, are still wanted; a query that finds fewer than k wants
    # all there are
    itself = rows.select("row", F.lit(1).alias("itself"))
    bound = int(most * most_asked) + 2
    span = 2 * bound + 1
    state = staged(asked.join(itself, "row", "left").select(
        "row", "vec_id", "v", F.lit(-bound).cast("long").alias("lo"), F.lit(bound).cast("long").alias("hi"),
        F.least(F.lit(k), F.lit(n) - F.coalesce("itself", F.lit(0))).cast("long").alias("left"))
        .filter("left > 0"), "ranges")
    while span > 1:
        width = -(-span // BINS)
        counts = (with_rows(state).applyInArrow(_count_scores(span), "row long, bin long, n long")
                  .groupBy("row", "bin").agg(F.sum("n").alias("n")))
        down = Window.partitionBy("row").orderBy(F.desc("bin"))  # at most BINS rows each
        found = (counts.withColumn("upto", F.sum("n").over(down))
                 .join(state.select("row", "left"), "row")
                 .filter(F.col("upto").between(F.col("left"), F.col("left") + F.col("n") - 1))
                 .select("row", "bin", (F.col("upto") - F.col("n")).alias("above")))
        lo = F.col("lo") + F.col("bin") * width
        state = staged(state.join(found, "row").select(
            "row", "vec_id", "v", lo.alias("lo"), F.least(lo + (width - 1), "hi").alias("hi"),
            (F.col("left") - F.col("above")).alias("left")), "ranges")
        span = width
    best = with_rows(state).applyInArrow(_reaching, "row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
