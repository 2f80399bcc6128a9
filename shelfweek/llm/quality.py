"""Quality classification by importance resampling.

Two models of hashed word and word-pair counts are built, one of the target
(documents labelled good) and one of the raw text (all documents). A document's
log weight is the log of the ratio of its probabilities under the two. Adding
Gumbel noise to the log weights and keeping the k largest sums draws k documents
without replacement in proportion to their weights.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweek.llm.common import checkpoint, condition, sampled, uniform
from shelfweek.llm.shingles import pair_hashes, word_lists

BUCKETS = 1 << 14
# Labelled documents that the target model is fitted on, at most.
TARGET_ROWS = 20_000
_BINS = 1024


def _buckets(column: pa.Array):
    """(words and pairs as buckets, text of each, number of texts) for some texts after the other."""
    for words, bounds in word_lists(column):
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        inside = text[1:] == text[:-1]
        grams = np.concatenate((words, pair_hashes(words)[inside]))
        yield (grams % np.uint64(BUCKETS)).astype(np.int64), np.concatenate((text, text[1:][inside])), len(bounds) - 1


def _counts(batches):
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        chosen = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
        at = 0
        for grams, text, n in _buckets(batch.column("text")):
            raw += np.bincount(grams, minlength=BUCKETS)
            target += np.bincount(grams[chosen[at : at + n][text]], minlength=BUCKETS)
            at += n
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(BUCKETS)), pa.array(raw), pa.array(target)], names=["bucket", "raw", "target"]
    )


def log_ratios(docs: DataFrame, target_ids: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    """Log probability ratio per bucket; the raw counts are those of all documents.

    ``target_ids`` (column ``id``) has TARGET_ROWS rows at most and is broadcast.
    """
    ids = target_ids.select(F.col("id").alias("__id"), F.lit(True).alias("__target"))
    marked = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(ids), F.col("__doc") == F.col("__id"), "left"
    )
    sums = (
        marked.select("text", F.coalesce("__target", F.lit(False)).alias("target"))
        .mapInArrow(_counts, "bucket bigint, raw bigint, target bigint")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .orderBy("bucket")
        .collect()
    )
    if not sums:
        return np.zeros(BUCKETS)
    raw, target = (np.array([r[c] for r in sums], float) for c in ("raw", "target"))
    if not target.sum():
        return np.zeros(BUCKETS)

    def log_share(counts):
        return np.log((counts + 1) / (counts.sum() + BUCKETS))

    return log_share(target) - log_share(raw)


def _weigh(ratios: np.ndarray, keep: list[str]):
    def weigh(batches):
        for batch in batches:
            weights, sizes = [], []
            for grams, text, n in _buckets(batch.column("__text")):
                weights.append(np.bincount(text, ratios[grams], n).astype(float))
                sizes.append(np.bincount(text, minlength=n))
            if weights:
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in keep], pa.array(np.concatenate(weights)),
                     pa.array(np.concatenate(sizes).astype(np.int64))],
                    names=[*keep, "log_weight", "n_grams"],
                )

    return weigh


def kth_largest(df: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest number of a column by counts in ever finer bins; None if there are fewer."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    while low is not None:
        bin_ = F.lit(0) if low == high else F.floor((F.col(column) - low) / (high - low) * _BINS)
        bins = (
            df.where(F.col(column).between(low, high))
            .groupBy(bin_.alias("bin"))
            .agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
            .orderBy(F.desc("bin"))
            .collect()
        )
        for row in bins:
            if row["n"] >= k:
                break
            k -= row["n"]
        else:
            return None
        if row["low"] == row["high"]:
            return row["low"]
        low, high = row["low"], row["high"]
    return None


def resample(
    docs: DataFrame,
    labels: DataFrame,
    good: Column | str,
    share: float | None = None,
    seed: int = 0,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, log_weight, n_grams, key and kept, the sample by importance.

    ``good`` is a condition on the rows of ``labels`` (with ``id_col``). ``share``
    of the documents that have words are kept, by default the share of labels
    that are good. Words are lowered (A-Z); null and empty texts have no words,
    weight 0, a null key and are not kept. Repeated rows draw the same noise and
    are kept or left together; equal keys at the border are all kept. Without
    good labels all weights are 0 and the sample is uniform; without labels and
    ``share`` all documents with words are kept. Other columns are not read.
    """
    known = labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), condition(good).alias("good"))
    total, fine = known.agg(F.count("good"), F.count_if("good")).first()
    if share is None:
        share = fine / total if total else 1.0
    chosen = sampled(known.where("good").select("id").distinct(), TARGET_ROWS, "id")
    ratios = log_ratios(docs, checkpoint(chosen), id_col, text_col)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        uniform(F.lit(seed), F.col(id_col), F.col(text_col)).alias("u"),
        F.col(text_col).cast("string").alias("__text"),
    )
    weighed = checkpoint(
        rows.mapInArrow(
            _weigh(ratios, ["id", "u"]), "id bigint, u double, log_weight double, n_grams bigint"
        )
    )
    noise = -F.log(-F.log(F.col("u")))
    keyed = weighed.withColumn("key", F.when(F.col("n_grams") > 0, F.col("log_weight") + noise))
    with_words = keyed.where(F.col("key").isNotNull())
    k = round(share * with_words.count())
    border = kth_largest(with_words, "key", k) if k else None
    kept = F.lit(False) if border is None else F.coalesce(F.col("key") >= border, F.lit(False))
    return keyed.select(
        F.col("id").alias(id_col), "log_weight", "n_grams", "key", kept.alias("kept")
    )
