"""Quality classifier (operator 8) by importance resampling.

Two generative models over hashed word 1- and 2-grams: one of target text
(documents labelled good), one of the raw table.  A document's log weight is
the sum over its n-grams of log p_target - log p_raw; documents are drawn
without replacement in proportion to their weights by Gumbel top-k: add
Gumbel noise to the log weight, keep the k largest.

Log weights are scaled to a fixed length (the mean per n-gram times
``LENGTH``), so that long documents do not rank by length, and divided by a
temperature: the higher, the more chance decides.  k is a share of all rows,
or the number of documents whose log weight reaches a threshold fitted on the
labels (``KEEP_GOOD`` of the labelled good rows lie above it).

The raw model counts all rows.  The target model and the threshold are fitted
on at most ``FIT_ROWS`` labelled good documents (those of smallest id hash;
four fifths for the model, one fifth for the threshold).  Noise is a hash of
the id (of the text where the id is null), so a re-run or a lost executor
changes nothing.  The kth value is located exactly by refined histograms.

Defined results: a null or empty text has no n-grams and log weight 0; rows
tied on the kth value stay together, so repeated rows share one verdict;
without any labelled good row all documents are kept; further columns pass
through; an empty table gives an empty result."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_or_null, fresh, kth_largest, staged

BUCKETS = 1 << 16
SMOOTHING = 0.5
KEEP_GOOD = 0.995
#: Labelled good documents that model and threshold are fitted on, at most.
FIT_ROWS = 20_000
LENGTH = 256
#: Log weights are divided by it: 1 draws by the models' own ratio for LENGTH n-grams.
TEMPERATURE = 8.0
SEED = 11
_UNIT = 1 << 20  # fixed point of noisy weights


def grams(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of each word and of each pair of neighbours."""
    import zlib
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(29)
    return np.r_[h, pairs] % np.uint64(buckets)


def _roles(labels: DataFrame, fit_rows: int) -> DataFrame:
    """(doc_id, role) of the bounded fitting sample: 1 model, 2 threshold."""
    good = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long")).distinct()
    h = F.xxhash64("doc_id", F.lit(SEED))
    return good.orderBy(h, "doc_id").limit(fit_rows).select(
        "doc_id", F.when(F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(5)) == 0, 2).otherwise(1).alias("role"))


def _with_roles(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    # at most fit_rows ids: small enough to broadcast whatever the tables' size
    return columns_or_null(docs, doc_id="long", text="string").join(
        F.broadcast(_roles(labels, fit_rows)), "doc_id", "left").select(
        "doc_id", "text", F.coalesce("role", F.lit(0)).alias("role"))


@dataclass
class Model:
    """Log weight per bucket (target against raw)."""
    gains: np.ndarray
    temperature: float = TEMPERATURE

    def mean(self, text: str | None) -> tuple[int, float]:
        """Number of n-grams, log weight scaled to LENGTH n-grams (short
        texts are shrunk towards 0) and divided by the temperature."""
        g = grams(text, len(self.gains))
        return len(g), float(self.gains[g].sum()) * LENGTH / (len(g) + 10) / self.temperature


def train(rows: DataFrame, buckets: int = BUCKETS, temperature: float = TEMPERATURE) -> Model | None:
    """Raw counts over all rows, target counts over role 1: dense arrays per
    task, summed by bucket on the executors; the driver gets ``buckets``
    numbers of each."""
    def run(batches):
        total = np.zeros((2, buckets), np.int64)
        held: tuple[list, list] = ([], [])
        def add():
            for k in (0, 1):
                if held[k]:
                    total[k] += np.bincount(np.concatenate(held[k]).astype(np.int64), minlength=buckets)
                    held[k].clear()
        size = 0
        for batch in batches:
            for t, role in zip(batch.column(0), batch.column(1).to_numpy()):
                g = grams(t.as_py(), buckets)
                held[0].append(g)
                if role == 1:
                    held[1].append(g)
                size += len(g)
                if size > 1 << 20:
                    add()
                    size = 0
        add()
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])],
                                         names=["b", "raw", "good"])
    sums = (rows.select("text", "role").mapInArrow(run, "b long, raw long, good long")
            .groupBy("b").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).toArrow())
    raw, good = np.zeros(buckets), np.zeros(buckets)
    raw[sums["b"].to_numpy()], good[sums["b"].to_numpy()] = sums["raw"].to_numpy(), sums["good"].to_numpy()
    if not good.sum():
        return None
    # the smaller table sets the smoothing: pull the target towards raw where
    # it has seen little
    p_raw = (raw + 0.5) / (raw.sum() + 0.5 * buckets)
    p_good = (good + SMOOTHING * buckets * p_raw) / (good.sum() + SMOOTHING * buckets)
    return Model((np.log(p_good) - np.log(p_raw)).astype(np.float32), temperature)


@dataclass
class Draw:
    """A fitted classifier: the model and the kth noisy weight."""
    model: Model | None
    kth: int | None
    seed: int = SEED

    def keeps(self, weight: str = "weight", noise: str = "noise") -> Column:
        """Verdict over the columns of log weight and noise."""
        return F.lit(True) if self.kth is None else noisy(weight, noise) >= self.kth


def noisy(weight: str = "weight", noise: str = "noise") -> Column:
    return F.floor((F.col(weight) + F.col(noise)) * _UNIT).cast("long")


def gumbel(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    h = F.coalesce(F.xxhash64(doc_id, F.lit(seed + 2)), F.lit(0)).bitwiseXOR(
        F.when(doc_id.isNull(), F.xxhash64(text, F.lit(seed + 2))).otherwise(F.lit(0)))
    u = (F.shiftrightunsigned(h, 12) + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, keep_good: float = KEEP_GOOD,
        buckets: int = BUCKETS, share: float | None = None, temperature: float = TEMPERATURE,
        seed: int = SEED) -> tuple[Draw, DataFrame]:
    """The fitted classifier and the staged narrow table it was fitted on:
    (doc_id, n_grams, weight, noise) of every row.  ``share`` of all rows are
    drawn; where it is None, as many as reach the threshold that
    ``keep_good`` of the labelled good rows reach."""
    rows = _with_roles(docs, labels, fit_rows)
    model = train(rows, buckets, temperature)

    def run(batches):
        for batch in batches:
            got = [(0, 0.0) if model is None else model.mean(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([n for n, _ in got], pa.int64()),
                 pa.array([w for _, w in got], pa.float64()), batch.column(3)],
                names=["doc_id", "role", "n_grams", "weight", "noise"])
    scored = staged(rows.select("doc_id", "text", "role", gumbel(F.col("doc_id"), F.col("text"), seed).alias("noise"))
                    .mapInArrow(run, "doc_id long, role int, n_grams long, weight double, noise double"),
                    "weights")
    # one weight per id, so at most fit_rows numbers even if ids repeat
    marks = [r[0] for r in scored.filter("role = 2").groupBy("doc_id").agg(F.min("weight")).select(
        "min(weight)").collect()]
    if model is None or not (marks or share is not None):
        return Draw(model, None, seed), scored
    threshold = float(np.quantile(marks, 1 - keep_good)) if marks else 0.0
    rows_in, k, lo, hi = scored.agg(F.count("*"), F.count_if(F.col("weight") >= threshold), F.min(noisy()),
                                    F.max(noisy())).first()
    k = k if share is None else round(share * rows_in)
    kth, _ = kth_largest(scored.select(noisy().alias("v")), "v", k, lo, hi) if k else ((hi or 0) + 1, 0)
    return Draw(model, kth, seed), scored


def classified(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, n_grams, log_weight, kept) of every row."""
    draw, scored = fit(docs, labels, **options)
    return scored.select("doc_id", "n_grams", F.col("weight").alias("log_weight"), draw.keeps().alias("kept"))


def resample(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The drawn rows with all their columns; weights are computed again in
    the filtering pass, so no text is shuffled."""
    draw, _ = fit(docs, labels, **options)
    if draw.kth is None:
        return docs
    model = draw.model

    @F.pandas_udf("double")
    def weight(texts: pd.Series) -> pd.Series:
        return pd.Series([model.mean(t)[1] for t in texts], dtype="float64")

    w, z = fresh(docs, "weight"), fresh(docs, "noise")
    return (docs.withColumn(w, weight("text")).withColumn(z, gumbel(F.col("doc_id"), F.col("text"), draw.seed))
            .filter(draw.keeps(w, z)).select(*docs.columns))
