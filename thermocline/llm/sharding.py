"""Sharding (operator 4): a consistent-hash ring with virtual nodes and
bounded loads, by bytes.

A document's place on the ring is the hash of its text, so equal texts lie
together.  Every shard has ``vnodes`` points on the ring and takes at most
``1 + slack`` of an equal share of the bytes; what meets a full shard goes on
clockwise to the next point of a shard with room.

The ring is dealt by units, not by rows: ``2 ** BUCKET_BITS`` equal arcs, and
for each group of equal texts larger than a ``FINE``-th of a shard its own
pieces, cut by a hash of a row number, so a group that holds a third of all bytes is
spread.  Units have a fixed bound (arcs, plus shards * FINE pieces and as many
remainders), so their sums of bytes and rows may be placed on the driver and
the placement broadcast; rows themselves are only counted, joined and
numbered on the executors.  Units are placed from the largest down, which
leaves shards equal to within about a unit.

Law: ``bytes``.  Defined results: a null text has size 16 and lies with the
empty text; null ids and repeated rows are placed like others (ties are
numbered in any order, they are equal); an empty table gives no rows."""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import columns_or_null, staged

SHARDS = 40
VNODES = 128
SLACK = 0.001
BUCKET_BITS = 16
FINE = 400


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(place, shard), sorted; a shard's points do not depend on how many
    other shards there are."""
    import xxhash
    return sorted((xxhash.xxh64_intdigest(f"{s}/{v}"), s) for s in range(shards) for v in range(vnodes))


def place(units: list[tuple[int, int]], shards: int, vnodes: int = VNODES, slack: float = SLACK) -> list[int]:
    """Shard of each unit (place on the ring, bytes)."""
    points = ring(shards, vnodes)
    places = [p for p, _ in points]
    room = [int(sum(b for _, b in units) * (1 + slack) / shards) + 1] * shards
    out = [0] * len(units)
    for i in sorted(range(len(units)), key=lambda i: (-units[i][1], units[i][0], i)):
        at, size = units[i]
        start, tried = bisect.bisect_left(places, at), set()
        for k in range(len(points)):
            shard = points[(start + k) % len(points)][1]
            if room[shard] >= size:
                break
            tried.add(shard)
            if len(tried) == shards:  # a unit larger than any room left
                shard = max(range(shards), key=lambda s: (room[s], -s))
                break
        room[shard] -= size
        out[i] = shard
    return out


def _measured(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return columns_or_null(docs, doc_id="long", text="string").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("place"))


def _bucket() -> Column:
    return F.shiftrightunsigned("place", 64 - BUCKET_BITS)


def assign(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, slack: float = SLACK) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless in a shard) of every
    row; the texts are read once and never shuffled."""
    spark = docs.sparkSession
    # rows are numbered once, in the written table: groups are cut by that, so
    # null and repeated ids are spread like others
    rows = staged(_measured(docs).withColumn("row", F.monotonically_increasing_id()), "sizes")
    total = rows.agg(F.sum("size")).first()[0] or 0
    limit = max(1, total // (shards * FINE))
    # at most shards * FINE groups can be larger than the limit
    large = (rows.groupBy("place").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
             .filter((F.col("bytes") > limit) & (F.col("n") > 1))
             .select("place", F.ceil(F.col("bytes") / limit).cast("int").alias("parts")))
    rows = staged(rows.join(F.broadcast(large), "place", "left").select(
        "doc_id", "row", "size", "text_crc32", _bucket().alias("bucket"),
        F.when(F.col("parts").isNotNull(), F.col("place")).otherwise(0).alias("own"),
        F.coalesce(F.pmod(F.xxhash64("row", F.lit(5)), F.col("parts")), F.lit(0)).alias("part")), "units")
    unit = ["bucket", "own", "part"]
    sums = (rows.groupBy(*unit).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
            .orderBy(*unit).toArrow())
    keys = [sums[c].to_pylist() for c in (*unit, "bytes", "n")]
    at = [(own % (1 << 64)) if own else (b << (64 - BUCKET_BITS)) for b, own in zip(keys[0], keys[1])]
    where = place(list(zip(at, keys[3])), shards, vnodes, slack)
    first, used = [], [0] * shards
    for s, n in zip(where, keys[4]):
        first.append(used[s])
        used[s] += n
    plan = spark.createDataFrame(pa.table({
        **{c: sums[c] for c in unit}, "shard": pa.array(where, pa.int32()), "first": pa.array(first, pa.int64())}))
    within = Window.partitionBy(*unit).orderBy("doc_id", "text_crc32", "size", "row")
    return (rows.join(F.broadcast(plan), unit)
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("first") + F.row_number().over(within) - 1).cast("long").alias("slot")))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, **options) -> None:
    """The documents as Parquet folders ``shard=N``; ``doc_id`` must be
    unique."""
    placed = assign(docs, shards, **options).select("doc_id", F.col("shard").alias("__shard"))
    out = docs.join(placed.hint("shuffle_hash"), "doc_id")
    # several tasks to a shard, so no task writes a whole one
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(16))
    (out.repartition(F.col("__shard"), spread).withColumnRenamed("__shard", "shard")
     .write.partitionBy("shard").parquet(path))
