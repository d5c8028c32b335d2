"""Splits into training and held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortum import fixed_values as fixed

# The first 7 hexadecimal digits of a digest, a whole number below this.
DIGEST_SPACE = 16**7


def key_share(key: str, seed: int = fixed.SPLIT_SEED) -> Column:
    """A number in [0, 1) that depends on nothing but the key and the seed."""
    text = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    digest = F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("bigint")
    return digest / F.lit(DIGEST_SPACE)


def in_training(
    key: str, share: float = fixed.TRAIN_SHARE, seed: int = fixed.SPLIT_SEED
) -> Column:
    """True for keys on the training side; a missing key is on it too."""
    return F.coalesce(key_share(key, seed), F.lit(0.0)) < share


def split_by_key(
    df: DataFrame,
    key: str = "id_student",
    share: float = fixed.TRAIN_SHARE,
    seed: int = fixed.SPLIT_SEED,
) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows, with all rows of a key on one side.

    The side depends only on the key: repartitioning, retries and other engines do not change it.
    """
    train = in_training(key, share, seed)
    return df.where(train), df.where(~train)


def split_at_random(
    df: DataFrame, share: float = fixed.TRAIN_SHARE, seed: int = fixed.SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows drawn row by row.

    Which rows are drawn depends on how they are partitioned, and rows of one student can land on
    both sides. ``df`` should be stored or persisted, so that both sides see the same partitions.
    """
    train, held_out = df.randomSplit([share, 1 - share], seed=seed)
    return train, held_out
