"""Interval join by slabs of the sorted line.

``point BETWEEN lo AND hi`` on equal keys, where a few keys may hold most rows. Per
key, the days of all points and of both ends of all windows are counted (combined
map-side: one row for each key and day), and the sorted days are cut into slabs of
about ``slab`` events. A point lies in one slab; a window goes to each slab that it
reaches into, once, however many months it covers. Points meet only the windows
of their slab, and of those only the ones that begin or end inside it may not match,
so what is compared in vain stays within ``slab`` a point, and no key compares all its
points with all its windows. A slab whose single day holds more points than that is
dealt over several parts by a hash, its windows copied to each.

Nothing is counted while the query is planned: the slabs are an aggregate of the same
plan, small (at most one row for each key and day) and broadcast by adaptive
execution where they are; where not, all joins are plain shuffle joins on
(key, day) or (key, slab, part), whose skew it can split.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Points and window ends that a slab should hold.
EVENTS_PER_SLAB = 100_000


def line(points: DataFrame, windows: DataFrame, point_keys: Sequence[str], window_keys: Sequence[str], point: str, lo: str, hi: str,
         slab: int = EVENTS_PER_SLAB) -> DataFrame:
    """One row for each key (``__k0`` ..) and day with an event: its ``slab`` and the
    number of points on it. NULL keys and days, and windows that end before they
    begin, match nothing and are left out."""
    names = [f"__k{i}" for i in range(len(point_keys))]
    at = points.select(*[F.col(k).alias(n) for k, n in zip(point_keys, names, strict=True)], F.col(point).alias("day"))
    ends = (windows.filter(F.col(lo) <= F.col(hi))
            .select(*[F.col(k).alias(n) for k, n in zip(window_keys, names, strict=True)], F.explode(F.array(lo, hi)).alias("day")))
    counted = (at.groupBy(*names, "day").agg(F.count(F.lit(1)).alias("points")).withColumn("events", F.col("points"))
               .unionByName(ends.groupBy(*names, "day").agg(F.count(F.lit(1)).alias("events")).withColumn("points", F.lit(0).cast("long"))))
    days = counted.dropna().groupBy(*names, "day").agg(F.sum("points").alias("points"), F.sum("events").alias("events"))
    # one row for each day of the calendar at most, so a key's days fit one task
    before = F.sum("events").over(Window.partitionBy(*names).orderBy("day").rowsBetween(Window.unboundedPreceding, -1))
    return days.select(*names, "day", "points", F.floor(F.coalesce(before, F.lit(0)) / slab).alias("slab"))


def sweep_join(points: DataFrame, windows: DataFrame, *, point_keys: Sequence[str], window_keys: Sequence[str], point: str,
               lo: str, hi: str, part_on: str, slab: int = EVENTS_PER_SLAB) -> DataFrame:
    """Inner join of ``points`` and ``windows`` on equal keys and
    ``points[point] BETWEEN windows[lo] AND windows[hi]`` (dates). Column names of
    the two sides must be disjoint. ``part_on``: the point column whose hash deals
    the points of a crowded day."""
    names = [f"__k{i}" for i in range(len(point_keys))]
    days = line(points, windows, point_keys, window_keys, point, lo, hi, slab)
    slabs = days.groupBy(*names, "slab").agg(
        F.min("day").alias("first"), F.max("day").alias("last"), F.ceil(F.sum("points") / slab).alias("parts"))

    # points: their day's slab, and a part of it
    own = days.select(*names, F.col("day").alias("__day"), F.col("slab").alias("__slab"))
    crowded = slabs.select(*[F.col(n).alias(f"{n}s") for n in names], F.col("slab").alias("__of"), "parts")
    own = own.join(crowded, [F.col(n) == F.col(f"{n}s") for n in names] + [F.col("__slab") == F.col("__of")]).select(
        *names, "__day", "__slab", "parts")
    match = [points[k] == own[n] for k, n in zip(point_keys, names, strict=True)] + [points[point] == own["__day"]]
    left = points.join(own, match).withColumn("__part", F.pmod(F.xxhash64(part_on), F.greatest("parts", F.lit(1)))).drop(*names, "__day", "parts")

    # windows: every slab of their key that they reach into, and each of its parts
    of_key = slabs.filter("parts > 0").groupBy(*names).agg(F.collect_list(F.struct("first", "last", "slab", "parts")).alias("__slabs"))
    valid = windows.filter(F.col(lo) <= F.col(hi))
    reach = F.filter("__slabs", lambda s: (s["first"] <= F.col(hi)) & (s["last"] >= F.col(lo)))
    right = (valid.join(of_key, [valid[k] == of_key[n] for k, n in zip(window_keys, names, strict=True)])
             .withColumn("__s", F.explode(reach)).drop("__slabs", *names)
             .withColumn("__wslab", F.col("__s.slab"))
             .withColumn("__wpart", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__s.parts") - 1))).drop("__s"))
    on = [left[k] == right[w] for k, w in zip(point_keys, window_keys, strict=True)]
    out = left.join(right, on + [left["__slab"] == right["__wslab"], left["__part"] == right["__wpart"],
                                 left[point].between(right[lo], right[hi])])
    return out.drop("__slab", "__part", "__wslab", "__wpart")
