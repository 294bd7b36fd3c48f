"""Exact sets of users as bitmaps, so that distinct counts can be stored and added up.

Users get numbers in runs: sorted by the columns that groups are made of, so the
users of a group stand close together and its bitmap has few, full pieces. A piece
covers 32,768 numbers (4 KiB); a set is one row for each of its pieces. Sets are
united piece by piece and counted by their bits: the counts are exact.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def numbers(users: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``key`` and ``user_number`` of each different key of ``users`` that is not NULL, in
    runs of consecutive numbers ordered by ``order`` (a key with several rows stands
    where its smallest values do). The numbers depend on how the rows were dealt:
    write the result before it is used."""
    one = users.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.min(c).alias(c) for c in order])
    return (one.repartitionByRange(*order, key).sortWithinPartitions(*order, key)
            .select(key, (F.monotonically_increasing_id() + 1).alias("user_number")))


def pieces(rows: DataFrame, by: Sequence[str], key: str, numbered: DataFrame) -> DataFrame:
    """The sets of ``key`` of ``rows`` for each group of ``by``: ``by``, ``piece``, ``users``
    (bitmap). Rows of a heavy key are combined before they move; the rows of a
    piece meet in one task, 32,768 keys with the groups that each belongs to."""
    seen = rows.where(F.col(key).isNotNull()).groupBy(key, *by).agg(F.lit(1).alias("__one")).drop("__one")
    own = numbered.select(F.col(key).alias("__key"), "user_number")
    at = seen.join(own, seen[key] == own["__key"]).select(
        *by, F.bitmap_bucket_number("user_number").alias("piece"), F.bitmap_bit_position("user_number").alias("__bit"))
    return at.repartition("piece").groupBy(*by, "piece").agg(F.bitmap_construct_agg("__bit").alias("users"))


def counted(sets: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """``by`` and the number of different users in the union of each group's sets."""
    united = sets.groupBy(*by, "piece").agg(F.bitmap_or_agg("users").alias("users"))
    return united.groupBy(*by).agg(F.sum(F.bitmap_count("users")).alias(name))
