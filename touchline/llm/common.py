"""Helpers shared by the operators of this subpackage: table access, stored
intermediate results, fixed-size key filters and Arrow tokenisation."""
from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Positions of the fixed-size key filter (a bitmap of 512 KiB, whatever the input).
FILTER_BITS = 1 << 22


def ship(module_name: str) -> None:
    """Send the functions of a module to the Python workers by value, so that
    the workers need no copy of this package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or the checkpoint folder that the
    application has set; a private one is made only where there is neither
    (local tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    jsc = spark.sparkContext._jsc.sc()
    if not path and jsc.getCheckpointDir().isDefined():
        path = jsc.getCheckpointDir().get()
    if not path:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="touchline-llm-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


#: Rows that a Python worker is handed at once (Spark's own default is 10,000).
BATCH_ROWS = 1024


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within it, jobs hand Python workers at most ``BATCH_ROWS`` rows at once:
    the buffers on both sides hold whole texts. The session's setting is put
    back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(name))
    if not 0 < before <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, str(before))


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the
    lineage ends at files that every executor can read."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of ``monotonically_increasing_id`` that hold a row's place in its partition.
PLACE_BITS = 33


def numbered(rows: DataFrame, order: list[str], parts: int, name: str) -> DataFrame:
    """``rows`` with ``name``: each row's place in the given order, from 0. A
    range partitioning orders them; the rows of the partitions before come from
    one count each, so no task sees more than its own partition."""
    placed = stored(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .withColumn("__place__", F.monotonically_increasing_id()))
    part = F.shiftright("__place__", PLACE_BITS)
    starts, before = [], 0
    for r in sorted(placed.groupBy(part.alias("part")).count().collect()):      # one row for each partition
        starts.append((r["part"], before))
        before += r["count"]
    firsts = rows.sparkSession.createDataFrame(starts, "__part__ long, __first__ long")
    return (placed.withColumn("__part__", part).join(F.broadcast(firsts), "__part__")
            .withColumn(name, F.col("__first__") + F.col("__place__").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))
            .drop("__part__", "__first__", "__place__"))


def clean_text(text: Column | str = "text") -> Column:
    """The text, empty if null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def crc_mod(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n (a null key counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def key_filter(keys: DataFrame, col: str) -> np.ndarray:
    """Bitmap of ``FILTER_BITS`` positions with the keys' remainders set. It is
    built by Spark and has the same size for any number of keys; a key that is
    not in it is surely absent, one that is in it needs an exact check."""
    pos = F.pmod(F.col(col), F.lit(FILTER_BITS))
    rows = (keys.select((F.bitmap_bucket_number(pos)).alias("bucket"), F.bitmap_bit_position(pos).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    out = np.zeros(FILTER_BITS // 8 + 4096, np.uint8)
    for r in rows:  # at most FILTER_BITS / 32768 + 1 rows of 4 KiB
        if r["bucket"] == 0:    # position 0 has a bucket of its own
            out[-1] = 1
        else:
            at = (r["bucket"] - 1) * 4096
            out[at:at + 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each int64 key may be in the filter."""
    pos = np.mod(keys, FILTER_BITS)
    # bucket b >= 1 holds positions (b - 1) * 32768 + 1 .. b * 32768, bit = (pos - 1) % 32768
    at = np.maximum(pos - 1, 0)
    hit = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1
    hit[pos == 0] = bits[-1]
    return hit.astype(bool)


def lower(texts: pa.Array) -> pa.Array:
    """The texts (large strings, null as empty) with A-Z lower-cased. A slice
    is copied first: the kernels below expect an array of its own."""
    texts = pc.cast(pc.fill_null(texts, ""), pa.large_string())
    return pc.ascii_lower(texts.take(pa.array(np.arange(len(texts)))))


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts with A-Z lower-cased (null:
    none), as (documents' offsets, codes, dictionary): document i has the codes
    ``codes[offsets[i]:offsets[i + 1]]``."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    lists = pc.ascii_split_whitespace(lower(texts))
    encoded = pc.dictionary_encode(lists.flatten())
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    words = encoded.dictionary
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:  # leading or trailing white space leaves empty pieces
        keep = codes != empty
        before = np.concatenate([[0], np.cumsum(keep)])
        offsets, codes = before[offsets], codes[keep]
    return offsets, codes, words


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (uint64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word, the same in every process."""
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin hash (mod 2**64, then mixed) of every window of k values."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base, out = np.uint64(0x9E3779B97F4A7C15), np.zeros(n, np.uint64)
    for j in range(k):
        out = out * base + hashes[j:j + n]
    return mix(out + np.uint64(k))


def batch_of(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    """A record batch from columns in the schema's order."""
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type)
                                       for c, f in zip(columns, schema, strict=True)], schema=schema)


def give_back() -> None:
    """Hand the freed memory of this process back to the system: workers are
    kept for later tasks, and their heaps would stay at their peaks."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):    # another C library than glibc
        pass


def byte_slices(batches: Iterator[pa.RecordBatch], column: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts in ``column`` take at most ``size``
    bytes; a longer text is a slice of its own."""
    pa.set_memory_pool(pa.system_memory_pool())
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column % b.num_columns)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        i, before = 0, 0
        while i < b.num_rows:
            j = max(int(np.searchsorted(ends, before + size, "right")), i + 1)
            yield b.slice(i, j - i)
            i, before = j, int(ends[j - 1])
    give_back()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in slices, which bound a worker's memory."""
    pa.set_memory_pool(pa.system_memory_pool())
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
    give_back()
