"""Join operators with explicit, size-checked physical choices.

* :func:`bounded_broadcast` broadcasts a side only after counting its rows and
  bytes (one aggregate: each task sends one row) and finding both within bounds;
  beyond them the caller's shuffle path is used instead.
* :func:`lookup_join` is the many-to-one tag lookup: broadcast when small,
  else reduced to the probe's keys and re-checked, else a salted shuffle join.
* :func:`interval_join` is the campaign-window join: equality on some keys
  plus ``point BETWEEN lo AND hi``.  The windows are bucketed by month so the
  equality part is selective.  On the non-broadcast path the rows of a crowded
  bucket are dealt over parts (:func:`bucket_parts`), because the equality keys
  (channel x company x month) have very low cardinality and one of them may
  hold a large share of the rows; a bucket that fits one part is not copied.
* :func:`null_aware_anti_count` counts probe rows for which ``NOT IN
  (subquery)`` is TRUE without Spark's broadcast-only null-aware anti join.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.session import task_count

# Largest side we ship to every executor.
DEFAULT_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 << 20
# Probe rows per salt of a salted join (a key may hold all of them).
ROWS_PER_SALT = 2_000_000
# Points, and windows, of a bucket that meet in one part of the interval join.
ROWS_PER_PART = 32_768


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` by one aggregate: text by its length, any other
    value as 16 bytes."""
    width = F.lit(0)
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        width = width + (F.coalesce(F.octet_length(c), F.lit(0)) + 16 if kind in ("string", "binary") else F.lit(16))
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width.cast("long"))).first()
    return rows, size or 0


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Return ``(df_with_broadcast_hint, True)`` if ``df`` is within both bounds,
    else ``(df, False)`` so the join falls back to a shuffle join."""
    rows, size = measured(df)
    if rows <= max_rows and size <= max_bytes:
        return F.broadcast(df), True
    return df, False


def salts_for(probe: DataFrame, least: int = 16) -> int:
    """Salts that leave ``ROWS_PER_SALT`` rows to a task even if one key holds
    all of ``probe``; grows with it."""
    return max(least, -(-probe.count() // ROWS_PER_SALT))


def broadcast_lookup(lookup: DataFrame, probe: DataFrame, lookup_key: str, probe_key: str,
                     max_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Prepare the lookup side of a many-to-one join on ``probe_key == lookup_key``.

    1. Broadcast it if it is provably small.
    2. Otherwise keep only lookup rows whose key occurs in the probe (semi join
       against the probe's distinct keys, combined map-side) and broadcast that
       if it is provably small: tag-like keys have few distinct values even when
       the lookup table is huge.
    3. Otherwise return the reduced side, not broadcast (:func:`lookup_join`
       then salts the shuffle join).
    """
    side, small = bounded_broadcast(lookup, max_rows)
    if small:
        return side, True
    keys = probe.select(F.col(probe_key).alias("__pk")).where(F.col("__pk").isNotNull()).distinct()
    reduced = lookup.join(keys, lookup[lookup_key] == keys["__pk"], "left_semi")
    return bounded_broadcast(reduced, max_rows)


def _salts(n: int) -> Column:
    """Generator of the salt values 0 .. n-1 (BIGINT, like ``pmod(xxhash64(..), n)``)."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))


def lookup_join(probe: DataFrame, lookup: DataFrame, probe_key: str, lookup_key: str, how: str = "left",
                max_rows: int = DEFAULT_BROADCAST_ROWS, *, salt_on: str,
                salt_buckets: int | None = None) -> DataFrame:
    """Many-to-one join of ``probe`` to ``lookup`` on ``probe_key == lookup_key``.

    Broadcasts the lookup side when it (or its reduction to the probe's keys,
    see :func:`broadcast_lookup`) is provably small.  Otherwise the join is a
    salted shuffle join: every probe row gets a salt in [0, salt_buckets) from
    ``salt_on`` and the (reduced) lookup side is replicated once per salt, so a
    key held by a large share of the probe rows - or a NULL key - is spread over
    ``salt_buckets`` tasks.  (AQE cannot split this join by itself: the reduced
    side arrives already partitioned by the key, without an exchange to split.)
    """
    side, small = broadcast_lookup(lookup, probe, lookup_key, probe_key, max_rows)
    if small or salt_buckets == 1:
        return probe.join(side, probe[probe_key] == side[lookup_key], how)
    salt_buckets = salt_buckets or salts_for(probe)
    p = probe.withColumn("__salt", F.pmod(F.xxhash64(F.col(salt_on)), F.lit(salt_buckets)))
    s = side.withColumn("__salt", _salts(salt_buckets))
    return p.join(s, (p[probe_key] == s[lookup_key]) & (p["__salt"] == s["__salt"]), how).drop("__salt")


def literal_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a relation whose size is fixed by construction (inline literals)."""
    return F.broadcast(df)


def month_buckets(df: DataFrame, lo: str, hi: str, bucket: str = "bucket_month") -> DataFrame:
    """One row per calendar month touched by ``[lo, hi]`` (inclusive).

    An inverted window (hi < lo) gets no bucket, so it can never match, which is
    what ``x BETWEEN lo AND hi`` gives for it.
    """
    lo_m, hi_m = F.trunc(F.col(lo), "month"), F.trunc(F.col(hi), "month")
    months = F.when(hi_m >= lo_m, F.sequence(lo_m, hi_m, F.expr("INTERVAL 1 MONTH")))
    return df.withColumn(bucket, F.explode(months))


def bucket_parts(points: DataFrame, windows: DataFrame, point_keys: Sequence[str], window_keys: Sequence[str],
                 rows: int = ROWS_PER_PART) -> DataFrame:
    """For each key (``__k0`` ..) that both sides hold: in how many parts its points
    (``__of_points``) and its windows (``__of_windows``) are dealt.  A part holds about ``rows``
    of each, so a side is copied only where the other side's bucket is larger than that."""
    names = [f"__k{i}" for i in range(len(point_keys))]

    def sizes(df: DataFrame, by: Sequence[str], own: str, other: str) -> DataFrame:
        return (df.groupBy(*[F.col(k).alias(n) for k, n in zip(by, names, strict=True)])
                .agg(F.count(F.lit(1)).alias(own)).withColumn(other, F.lit(0).cast("long")))

    both = (sizes(points, point_keys, "__points", "__windows")
            .unionByName(sizes(windows, window_keys, "__windows", "__points"))
            .dropna().groupBy(*names).agg(F.sum("__points").alias("__points"), F.sum("__windows").alias("__windows")))
    return both.filter("__points > 0 AND __windows > 0").select(
        *names, F.ceil(F.col("__points") / rows).alias("__of_points"), F.ceil(F.col("__windows") / rows).alias("__of_windows"))


def _in_parts(points: DataFrame, windows: DataFrame, pk: Sequence[str], wk: Sequence[str],
              salt_on: str, rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``__salt`` for each part of their bucket that they belong to; rows of
    buckets that only one side holds are left out.  A bucket of P x Q parts deals its points
    over P rows of parts, its windows over Q columns."""
    parts = bucket_parts(points, windows, pk, wk, rows)
    names = [c for c in parts.columns if c.startswith("__k")]

    def side(df: DataFrame, by: Sequence[str], salts: Column) -> DataFrame:
        # another set of attributes for each side
        own = parts.select(*[F.col(n).alias(f"{n}_of") for n in names], "__of_points", "__of_windows")
        met = df.join(own, [df[k] == own[f"{n}_of"] for k, n in zip(by, names, strict=True)])
        return met.withColumn("__salt", F.explode(salts)).drop(*[f"{n}_of" for n in names], "__of_points", "__of_windows")

    def upto(n: str) -> Column:
        return F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)

    row = F.pmod(F.xxhash64(salt_on), F.col("__of_points"))
    column = F.pmod(F.xxhash64(*windows.columns), F.col("__of_windows"))
    return (side(points, pk, F.transform(upto("__of_windows"), lambda q: row * F.col("__of_windows") + q)),
            side(windows, wk, F.transform(upto("__of_points"), lambda p: p * F.col("__of_windows") + column)))


def interval_join(points: DataFrame, windows: DataFrame, *, point_keys: Sequence[str],
                  window_keys: Sequence[str], point: str, lo: str, hi: str,
                  bucketed: bool = True, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                  salt_buckets: int | None = None, salt_on: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Inner join ``points`` to ``windows`` on equal keys and
    ``points[point] BETWEEN windows[lo] AND windows[hi]``.

    Column names of the two sides must be disjoint.  With ``bucketed`` the
    window side is expanded to one row per month it covers and the month of
    ``point`` joins as an extra equality key; each (point, window) pair still
    meets in exactly one bucket, so no de-duplication is needed.

    If the (bucketed) window side is too large to broadcast, both sides are
    reduced to the keys that both hold, and the rows of a bucket that is larger
    than ``rows_per_part`` are dealt over parts: points by the hash of
    ``salt_on``, windows by that of the whole row, each copied once for each part of the other
    side only.  With ``salt_buckets`` every point gets a salt in ``[0, salt_buckets)``
    instead and every window is replicated once per salt value.
    """
    pk, wk = list(point_keys), list(window_keys)
    if bucketed:
        windows = month_buckets(windows, lo, hi, "__bucket")
        points = points.withColumn("__pbucket", F.trunc(F.col(point), "month"))
        pk, wk = pk + ["__pbucket"], wk + ["__bucket"]
    side, small = bounded_broadcast(windows, max_broadcast_rows)
    if not small and salt_buckets != 1:
        if salt_buckets:
            points = points.withColumn("__salt", F.pmod(F.xxhash64(F.col(salt_on)), F.lit(salt_buckets)))
            side = windows.withColumn("__salt", _salts(salt_buckets))
        else:
            points, side = _in_parts(points, windows, pk, wk, salt_on, rows_per_part)
            # a task's work is its points times its windows, which adaptive execution does not see
            n = task_count(points.sparkSession)
            points, side = points.repartition(n, *pk, "__salt"), side.repartition(n, *wk, "__salt")
        pk, wk = pk + ["__salt"], wk + ["__salt"]
    cond: Column = F.col(point).between(F.col(lo), F.col(hi))
    for a, b in zip(pk, wk):
        cond = cond & (points[a] == side[b])
    out = points.join(side, cond, "inner")
    return out.drop(*[c for c in ("__bucket", "__pbucket", "__salt") if c in out.columns])


def null_aware_anti_count(probe: DataFrame, build: DataFrame, probe_key: str, build_key: str,
                          max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """One-row frame: probe rows for which ``probe_key NOT IN (SELECT build_key ...)``
    is TRUE.  A NULL probe key never counts, and a single NULL on the build side
    makes the predicate NULL for every row, so the count is 0 then.

    Spark's own NOT IN plan is a null-aware *broadcast* anti join and degrades
    to a nested-loop join when the build side is large; here the anti join is an
    ordinary equi anti join on the non-NULL keys (broadcast when provably
    small, else a shuffle join), and the build side's NULL is a separate scalar
    subquery.
    """
    keys = build.select(F.col(build_key).alias("__k"))
    build_has_null = keys.agg(F.max(F.col("__k").isNull().cast("int"))).scalar()
    present, _ = bounded_broadcast(keys.where(F.col("__k").isNotNull()), max_broadcast_rows)
    misses = (probe.where(F.col(probe_key).isNotNull())
              .join(present, probe[probe_key] == present["__k"], "left_anti")
              .agg(F.count(F.lit(1)).alias("__misses")))
    return misses.select(
        F.when(F.coalesce(build_has_null, F.lit(0)) == 1, F.lit(0).cast("bigint"))
         .otherwise(F.col("__misses")).alias("n"))
