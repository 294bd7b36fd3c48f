"""Equal rows as one row and the number of times it stands for.

A join that fans out (a campaign tag held by many campaigns) makes rows that are equal
in every column. Kept as one row with a count (``TIMES``), they pass through the
joins and aggregates that follow as one row; :func:`repeated` writes them out again in
place, without a shuffle, where the rows themselves are wanted. A frame without the
column holds each of its rows once.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.exact import TIMES
from touchline.session import task_count

#: Rows that one step of :func:`repeated` makes of a row at most. They wait in memory
#: until the next operator has taken them.
_STEP = 1 << 12


def carried(df: DataFrame) -> list[str]:
    """The count's column, if ``df`` has one."""
    return [TIMES] if TIMES in df.columns else []


def n_rows(df: DataFrame, when: Column | None = None) -> Column:
    """Aggregate: the rows that ``df`` stands for (for which ``when`` holds)."""
    if TIMES not in df.columns:
        return F.count(F.lit(1)) if when is None else F.count_if(when)
    return F.coalesce(F.sum(TIMES if when is None else F.when(when, F.col(TIMES))), F.lit(0).cast("long"))


def in_steps(df: DataFrame, dealt_over: int | None = None) -> DataFrame:
    """``df`` with each count cut into counts of ``_STEP`` at most, so that no array grows
    with the copies of a row; the steps dealt over so many tasks, if a number is given."""
    if TIMES not in df.columns:
        return df
    step = F.lit(_STEP).cast("long")
    steps = df.withColumn("__step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(TIMES) - 1) / step))))
    if dealt_over:
        steps = steps.repartition(dealt_over, *steps.columns)
    return steps.withColumn(TIMES, F.least(step, F.col(TIMES) - F.col("__step") * step)).drop("__step")


def written(steps: DataFrame) -> DataFrame:
    """The rows of a frame that :func:`in_steps` has cut, each as often as it counts; in place."""
    if TIMES not in steps.columns:
        return steps
    # a struct without fields adds no column: nothing but the row is written again
    copies = F.inline(F.array_repeat(F.struct(), F.col(TIMES).cast("int")))
    return steps.select("*", copies).drop(TIMES)


def repeated(df: DataFrame) -> DataFrame:
    """The rows of ``df``, each as often as it counts; in place, without a shuffle."""
    return written(in_steps(df))


def dealt(df: DataFrame) -> DataFrame:
    """:func:`repeated` in even tasks. Adaptive execution sizes tasks by the counted rows it
    reads, which says little about the rows they write: a few small partitions may stand for
    nearly all of them. Here the steps are dealt out first, still counted, so no row's
    copies and no group of heavy rows are written by one task."""
    return written(in_steps(df, task_count(df.sparkSession)))
