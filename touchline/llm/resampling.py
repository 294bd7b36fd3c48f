"""Target-distribution importance resampling (operator 11).

Documents are drawn with a preference for those whose n-grams are frequent in a
target corpus and rare in the documents at large:

* The texts, A-Z lower-cased, go through an untrained pre-tokeniser: a regex Split
  returns words with offsets. The words are laid out with single spaces between
  them, and the windows of 1 to ``n`` words are pairs of offsets into that layout.
* The crc32 of a window's UTF-8 bytes, modulo ``buckets``, is its bucket. A
  document is kept as its sparse histogram; the histograms of all documents and of
  the target add up to ``buckets`` counts each, whatever the input.
* A bucket's gain is ``floor(1000 ln((t+1)(S+B) / ((s+1)(T+B))))``; a document's
  weight is the sum of the gains of its windows. Adding Gumbel noise, which the
  document's id and ``seed`` decide, and taking the highest scores draws without
  replacement in proportion to ``exp(weight / 1000)``.
* Ranks come from a range partitioning by score, the place in the partition and
  the counts of the partitions before: no task sees all rows.

Texts are tokenised once; the histograms are written to the shared folder and
read for the sums and for the weights. Texts are cut at a sign that stands in no
word every few thousand signs, so that a very long one needs no more memory than
its own bytes.

Cases: null or empty text: no words, weight 0, never drawn; a null doc_id draws
its noise from the empty id and comes last among equal scores; repeated rows are
rows of their own; ties go to the smaller doc_id; an empty target gives gains
from the counts of the documents alone; an empty table gives no rows; other
columns are ignored.
"""
from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import byte_slices, lower, numbered, ship, stored, table

ship(__name__)

# What a word is, and the signs that stand in none.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"

#: Signs of a text that are tokenised at once.
PIECE = 1 << 13
COUNTS = "doc_id long, n_words long, n_features long, buckets array<int>, counts array<long>"


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces that end where no word goes on."""
    gap, at = re.compile(GAP), 0
    while len(text) - at > size:
        cut = gap.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def windows(words: list[str], n: int, first: int = 0) -> Iterator[bytes]:
    """The runs of 1 to n consecutive words that end at word ``first`` or later:
    slices between two offsets of the words' layout with one space between them."""
    raw = [w.encode() for w in words]
    if n == 1:
        yield from raw[first:]
        return
    layout = b" ".join(raw)
    ends = (np.cumsum([len(w) + 1 for w in raw]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    for j in range(first, len(raw)):
        for i in range(max(0, j - n + 1), j + 1):
            yield layout[starts[i]:ends[j]]


def _histograms(n: int, buckets: int):
    """doc_id, n_words, n_features and the buckets with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Regex, pre_tokenizers

        split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
        known: dict[bytes, int] = {}        # a bounded memo of crc32

        def codes(found: Iterator[bytes]) -> Iterator[int]:
            for w in found:
                c = known.get(w)
                if c is None:
                    if len(known) >= 1 << 17:
                        known.clear()
                    c = known[w] = zlib.crc32(w) % buckets
                yield c

        for b in byte_slices(batches, 1):
            words, features, at, keys, counts = [], [], [0], [], []
            for text in lower(b.column(1)).to_pylist():
                total, size, last, sums = 0, 0, [], None
                bucket, count = np.empty(0, np.int32), np.empty(0, np.int64)
                for piece in pieces(text):
                    own = last + [w for w, _ in split.pre_tokenize_str(piece)]
                    new = np.fromiter(codes(windows(own, n, len(last))), np.int32)
                    total += len(own) - len(last)
                    size += len(new)
                    last = own[max(0, len(own) - n + 1):] if n > 1 else []
                    if len(text) <= PIECE:
                        bucket, count = np.unique(new, return_counts=True)
                    else:
                        sums = np.bincount(new, minlength=buckets) + (0 if sums is None else sums)
                if sums is not None:
                    bucket = np.nonzero(sums)[0].astype(np.int32)
                    count = sums[bucket]
                words.append(total)
                features.append(size)
                at.append(at[-1] + len(bucket))
                keys.append(bucket)
                counts.append(count)
            offsets = pa.array(np.array(at, np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(words, pa.int64()), pa.array(features, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(keys))),
                 pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(counts)))],
                names=["doc_id", "n_words", "n_features", "buckets", "counts"])
    return run


def _sums(buckets: int):
    """The added-up histogram of a task, as rows of bucket and count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            np.add.at(total, b.column(0).flatten().to_numpy(), b.column(1).flatten().to_numpy())
        own = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(total[own])], names=["bucket", "n"])
    return run


def histograms(texts: DataFrame, n: int, buckets: int) -> DataFrame:
    """Sparse window histograms of ``texts`` (doc_id, text), one row each."""
    return texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_histograms(n, buckets), COUNTS)


def total(counts: DataFrame, buckets: int) -> np.ndarray:
    """The sum of all histograms: ``buckets`` numbers, added up in the tasks first."""
    rows = (counts.select("buckets", "counts").mapInArrow(_sums(buckets), "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(buckets, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain, in thousandths."""
    b, s_all, t_all = len(documents), int(documents.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(s_all + b) / (float(s + 1) * float(t_all + b))))
                     for s, t in zip(documents.tolist(), target.tolist(), strict=True)], np.int64)


def _scores(gain, seed: int):
    """doc_id, n_words, n_features, weight, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = gain.value
        for b in batches:
            lists = b.column(3)
            at = lists.offsets.to_numpy().astype(np.int64)
            added = np.concatenate([[0], np.cumsum(own[lists.flatten().to_numpy()] * b.column(4).flatten().to_numpy())])
            weight = added[at[1:] - at[0]] - added[at[:-1] - at[0]]
            noise = []
            for i in b.column(0).to_pylist():
                h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
                noise.append(math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(weight), pa.array(weight + np.array(noise, np.int64))],
                names=["doc_id", "n_words", "n_features", "weight", "score"])
    return run


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10000, seed: int = 2024,
             min_words: int = 20, percent: int = 10) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with n_features, weight, score and rank:
    of the documents of ``min_words`` words or more, ``percent`` per cent (rounded
    down) are drawn by the highest scores, towards the texts of ``target``."""
    spark = docs.sparkSession
    counts = stored(histograms(docs, n, buckets))
    aim = total(histograms(target.select(F.lit(0).alias("doc_id"), "text"), n, buckets), buckets)
    gain = spark.sparkContext.broadcast(gains(total(counts, buckets), aim))     # ``buckets`` numbers
    scored = stored(counts.mapInArrow(_scores(gain, seed), "doc_id long, n_words long, n_features long, weight long, score long"))
    pool = F.col("n_words") >= min_words
    drawn = percent * scored.filter(pool).count() // 100
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = numbered(scored.withColumn("out", ~pool).withColumn("low", -F.col("score")).withColumn("none", F.col("doc_id").isNull()),
                      ["out", "low", "none", "doc_id"], parts, "place")
    return ranked.select("doc_id", "n_features", "weight", "score",
                         F.when(~F.col("out") & (F.col("place") < drawn), F.col("place") + 1).alias("rank"))


def op11_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents``: doc_id, n_features, weight, score, rank, drawn
    towards ``benchmark`` by single words in 10,000 buckets."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: crc32 goes byte by byte through the table of its polynomial (3988292384, reflected).
OP11_SQL = r"""
WITH RECURSIVE bits(i, k, c) AS (
    SELECT i, 0, i::UBIGINT FROM range(256) r(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM bits WHERE k < 8
), tab AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8),
doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), doc_grams AS (SELECT doc_id, unnest(words) AS w FROM doc_words),
target_grams AS (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
    FROM benchmark
), known AS (SELECT DISTINCT w FROM (SELECT w FROM doc_grams UNION ALL SELECT w FROM target_grams)),
raw AS (
    SELECT w, hex(encode(w)) AS h FROM known
), coded AS (
    SELECT w, (xor(list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::UBIGINT)),
        lambda c, b: xor(c >> 8, tab[((xor(c, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) % 10000)::BIGINT AS bucket
    FROM raw, tab
), s AS (SELECT bucket, count(*) AS s FROM doc_grams JOIN coded USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM target_grams JOIN coded USING (w) GROUP BY bucket),
gain AS (
    SELECT s.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM doc_grams) + 10000)::DOUBLE
                     / ((s + 1)::DOUBLE * ((SELECT count(*) FROM target_grams) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM s LEFT JOIN t ON s.bucket = t.bucket
), weights AS (
    SELECT doc_id, sum(gain)::BIGINT AS weight FROM doc_grams JOIN coded USING (w) JOIN gain USING (bucket) GROUP BY doc_id
), scored AS (
    SELECT d.doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::UBIGINT + 0.5::DOUBLE)
                                                      / 4294967296::DOUBLE)))::BIGINT AS score
    FROM doc_words d LEFT JOIN weights w ON d.doc_id = w.doc_id
), ranked AS (
    SELECT *, n_features >= 20 AS pool, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place
    FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN pool AND place <= 10 * (SELECT count(*) FROM ranked WHERE pool) // 100 THEN place END AS rank
FROM ranked
"""
