"""Length-bucketed, padded batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import arrays as A
from ..plans.ordering import number_rows

POOL_BATCHES = 100


def length_batches(encoded: DataFrame, key: str, batch_size: int,
                   pool_batches: int = POOL_BATCHES) -> DataFrame:
    """Add ``batch_id``.

    Rows are taken in key order in pools of ``pool_batches`` batches; a pool is
    sorted by encoder length and cut.  A pool has a fixed number of rows, so
    every sort is small whatever the table size.
    """
    pool_rows = batch_size * pool_batches
    pooled = number_rows(encoded, key).withColumn(
        "_pool", F.floor(F.col("row_index") / pool_rows).cast("long"))
    by_length = Window.partitionBy("_pool").orderBy("enc_len", key)
    place = F.floor((F.row_number().over(by_length) - 1) / batch_size).cast("long")
    return pooled.withColumn("batch_id", F.col("_pool") * pool_batches + place).drop(
        "row_index", "_pool")


def pad_batches(batched: DataFrame, max_dec_steps: int = 100) -> DataFrame:
    """Pad encoders to the batch maximum and decoders to the fixed maximum; add masks."""
    batch = Window.partitionBy("batch_id")
    dec = F.lit(max_dec_steps)
    width = F.col("max_enc_len")
    return (
        batched
        .withColumn("max_enc_len", F.max("enc_len").over(batch))
        .withColumn("max_art_oovs", F.max(F.size("article_oovs")).over(batch))
        .withColumn("enc_batch", A.pad(F.col("enc_input"), width))
        .withColumn("enc_batch_extend_vocab", A.pad(F.col("enc_input_extend_vocab"), width))
        .withColumn("enc_padding_mask", A.mask(F.col("enc_len"), width))
        .withColumn("dec_batch", A.pad(F.col("dec_input"), dec))
        .withColumn("target_batch", A.pad(F.col("target"), dec))
        .withColumn("dec_padding_mask", A.mask(F.col("dec_len"), dec))
    )


def shuffle_batches(batched: DataFrame, seed: int = 1) -> DataFrame:
    """Batches in a reproducible random order; rows of a batch stay adjacent."""
    return batched.orderBy(F.xxhash64("batch_id", F.lit(seed)), "batch_id")


def repeat_example(encoded: DataFrame, batch_size: int) -> DataFrame:
    """Generation batches: every example repeated to fill a batch of its own."""
    return encoded.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(batch_size - 1))))
