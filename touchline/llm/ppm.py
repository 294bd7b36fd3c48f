"""Language-model scores by prediction by partial matching (operator 6).

The model is a trie of byte contexts up to ``order`` bytes with the counts of
the bytes that follow, learned from the training documents (lower case A-Z; a
text starts after zero bytes and ends with one). A byte is coded in the longest
context that has seen it; each shorter step pays the escape (method C: distinct
over distinct plus total), and bytes that the longer context has seen are
excluded from the shorter one. Below order 0 the bytes left are equally likely.

Spark counts the grams (context and byte), and joins the trie's levels to give
each distinct gram of any document its log-probability, so the trie is never
whole in one place. The grams' table is sent out in blocks of ``block`` rows
(12 bytes each), and a document's score is the sum over its bytes. Besides, the
operator gives the base score, a word model with add-one smoothing: counts of
the ``frequent`` most frequent words are sent out, all others are joined.

Cases: null text counts as empty; an empty text consists of its end; repeated
rows are scored alike, each on its own row; without training documents the
model has no counts (every byte costs log10(1/256), the base score is 0); a
null doc_id counts as empty text for the fold; an empty table gives no rows;
other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import clean_text, crc_mod, lower, ship, stored, table, word_codes

ship(__name__)

#: Bytes of text whose grams are handled at once; bounds a worker's memory.
SLICE = 1 << 21
#: Grams that a counting task holds at most before it passes them on.
HELD = 1 << 21


def runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of documents of about SLICE bytes: (first, end)."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    start = 0
    while start < len(size):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + SLICE, "right")))
        yield start, stop
        start = stop


def grams(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram (the ``order`` bytes before and the byte itself, packed) at
    every byte of the texts, ends included, and the texts' offsets."""
    low = pc.cast(lower(texts), pa.large_binary())
    at = np.frombuffer(low.buffers()[1], np.int64)[:len(low) + 1]
    raw = np.frombuffer(low.buffers()[2], np.uint8)[:at[-1]] if low.buffers()[2] is not None else np.empty(0, np.uint8)
    size = np.diff(at) + 1
    offsets = np.concatenate([[0], np.cumsum(size)])
    flat = np.zeros(offsets[-1], np.int64)          # each text, then its end (a zero byte)
    body = np.ones(offsets[-1], bool)
    body[offsets[1:] - 1] = False
    flat[body] = raw
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], size)
    out = flat.copy()
    for k in range(1, order + 1):
        before = np.zeros_like(flat)
        before[k:] = flat[:-k]
        before[place < k] = 0
        out |= before << (8 * k)
    return out, offsets


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal keys added up."""
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    flat, n = flat[order], np.concatenate(counts)[order]
    first = np.nonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))[0]
    return flat[first], np.add.reduceat(n, first)


def _count(order: int):
    """(word, gram, n, n_train): counts of words and grams by fold; grams are
    added up over a task's documents as long as at most HELD are held."""
    def gram_rows(held: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        key, n = held
        return _rows(None, key >> 1, n, np.where(key & 1, n, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        held = (np.empty(0, np.int64), np.empty(0, np.int64))
        for b in batches:
            for start, stop in runs(b.column(1)):
                train = b.column(0).slice(start, stop - start).to_numpy(zero_copy_only=False).astype(bool)
                texts = b.column(1).slice(start, stop - start)
                offsets, codes, words = word_codes(texts)
                own = np.repeat(train, np.diff(offsets))
                n = np.bincount(codes, minlength=len(words))
                n_train = np.bincount(codes[own], minlength=len(words))
                used = pa.array(np.nonzero(n)[0])
                some = pc.cast(words.take(used), pa.string())
                yield _rows(some, None, n[n > 0], n_train[n > 0])
                flat, at = grams(texts, order)
                # the training fold is one more bit, so that one sort counts both
                key, count = np.unique(flat << 1 | np.repeat(train, np.diff(at)), return_counts=True)
                held = merged([held[0], key], [held[1], count])
                if len(held[0]) > HELD:
                    yield gram_rows(held)
                    held = (held[0][:0], held[1][:0])
        if len(held[0]):
            yield gram_rows(held)
    return run


def _rows(words: pa.Array | None, keys: np.ndarray | None, n: np.ndarray, n_train: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [words if words is not None else pa.nulls(len(n), pa.string()),
         pa.array(keys, pa.int64()) if keys is not None else pa.nulls(len(n), pa.int64()),
         pa.array(n, pa.int64()), pa.array(n_train, pa.int64())], names=["word", "gram", "n", "n_train"])


def gram_scores(counts: DataFrame, order: int) -> DataFrame:
    """log10 probability of each gram: gram, logp. ``counts``: gram, n_train (0
    for a gram that no training document has)."""
    low = lambda c, size: F.col(c).bitwiseAND(F.lit((1 << (8 * size)) - 1))
    seen: list[DataFrame] = [None] * (order + 1)       # by level: g (context and byte), n
    seen[order] = counts.filter("n_train > 0").select(F.col("gram").alias("g"), F.col("n_train").alias("n"))
    for j in range(order - 1, -1, -1):
        seen[j] = stored(seen[j + 1].groupBy(low("g", j + 1).alias("g")).agg(F.sum("n").alias("n")))
    contexts: list[DataFrame] = []                      # by level: c, total, kinds, and what it excludes below
    for j in range(order + 1):
        here = seen[j].select(F.shiftright("g", 8).alias("c"), "g", "n")
        if j:
            below = seen[j - 1].select(F.col("g").alias("b"), F.col("n").alias("below"))
            below = F.broadcast(below) if j <= 2 else below     # at most 256 ** 2 rows
            here = here.withColumn("b", low("g", j)).join(below, "b")
        else:
            here = here.withColumn("below", F.lit(0).cast("long"))
        contexts.append(stored(here.groupBy("c").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"),
                                                     F.sum("below").alias("gone"))))
    asked = counts.select("gram", F.col("gram").alias("g"), F.when(F.col("n_train") > 0, F.col("n_train")).alias("n"),
                          F.lit(0.0).alias("logp"), F.lit(0).cast("long").alias("gone"), F.lit(0).cast("long").alias("kinds_above"))
    done: list[DataFrame] = []
    for j in range(order, -1, -1):
        if j < order:
            own = seen[j].select("g", "n")
            own = F.broadcast(own) if j <= 1 else own
            asked = asked.withColumn("g", low("g", j + 1)).join(own, "g", "left")
        ctx = contexts[j].select("c", "total", "kinds", F.col("gone").alias("gone_below"))
        ctx = F.broadcast(ctx) if j <= 2 else ctx               # at most 256 ** 2 contexts
        asked = asked.withColumn("c", F.shiftright("g", 8)).join(ctx, "c", "left")
        total = F.coalesce("total", F.lit(0)) - F.col("gone")           # counts of bytes not excluded
        kinds = F.coalesce("kinds", F.lit(0)) - F.col("kinds_above")
        asked = asked.select("gram", "g", "n", "logp", total.alias("t"), kinds.alias("d"),
                             F.coalesce("gone_below", F.lit(0)).alias("gone"), F.coalesce("kinds", F.lit(0)).alias("kinds_above"))
        asked = stored(asked)      # each level reads what the one above has left
        done.append(asked.filter(F.col("n").isNotNull()).select(
            "gram", (F.col("logp") + F.log10(F.col("n") / (F.col("t") + F.col("d")))).alias("logp")))
        escape = F.when(F.col("d") > 0, F.log10(F.col("d") / (F.col("t") + F.col("d")))).otherwise(F.lit(0.0))
        asked = asked.filter(F.col("n").isNull()).select("gram", "g", (F.col("logp") + escape).alias("logp"), "gone", "kinds_above")
    done.append(asked.select("gram", (F.col("logp") - F.log10(F.lit(256) - F.col("kinds_above"))).alias("logp")))
    out = done[0]
    for d in done[1:]:
        out = out.unionAll(d)
    return out


def summed(texts: pa.Array, order: int, keys: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """Sum of ``logp`` over each text's grams that are in ``keys`` (sorted)."""
    out = []
    for start, stop in runs(texts):
        flat, at = grams(texts.slice(start, stop - start), order)
        own, inverse = np.unique(flat, return_inverse=True)
        place = np.searchsorted(keys, own)
        place[place == len(keys)] = 0
        value = np.where(keys[place] == own, logp[place], 0.0) if len(keys) else np.zeros(len(own))
        out.append(np.add.reduceat(value[inverse.ravel()], at[:-1]))    # no text is without its end
    return np.concatenate(out) if out else np.empty(0)


def _score(order: int, sent, frequent):
    """row, doc_id, key, held_out, n_tokens, n_known, base (both of frequent
    words), score, rest (other words), times of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        keys, logp = sent.value
        top, ends = frequent.value       # word -> training count; training count of the end
        for b in batches:
            for start, stop in runs(b.column(4)):
                texts = b.column(4).slice(start, stop - start)
                n_docs = stop - start
                offsets, codes, words = word_codes(texts)
                count = np.array([top.get(w, -1) for w in words.to_pylist()], np.int64)
                doc = np.repeat(np.arange(n_docs), np.diff(offsets))
                c = count[codes] if len(codes) else np.empty(0, np.int64)
                easy = c >= 0
                base = np.bincount(doc[easy], np.log10(c[easy] + 1.0), n_docs) + np.log10(ends + 1.0)
                known = np.bincount(doc[easy], c[easy] > 0, n_docs).astype(np.int64) + (ends > 0)
                pair, times = np.unique(doc[~easy].astype(np.int64) * max(1, len(words)) + codes[~easy], return_counts=True)
                cuts = np.searchsorted(pair, np.arange(n_docs + 1) * max(1, len(words))).astype(np.int32)
                rest = pa.ListArray.from_arrays(pa.array(cuts), pc.cast(words.take(pa.array(pair % max(1, len(words)))), pa.string()))
                own = [b.column(i).slice(start, n_docs) for i in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(np.diff(offsets) + 1), pa.array(known), pa.array(base), pa.array(summed(texts, order, keys, logp)),
                     rest, pa.ListArray.from_arrays(pa.array(cuts), pa.array(times, pa.int32()))],
                    names=["row", "doc_id", "key", "held_out", "n_tokens", "n_known", "base", "score", "rest", "times"])
    return run


def _more(order: int, sent):
    """key, score: what a further block adds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        keys, logp = sent.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(summed(b.column(1), order, keys, logp))], names=["key", "more"])
    return run


def score(docs: DataFrame, held_out: Column, order: int = 5, frequent: int = 1 << 16, block: int = 1 << 22) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text), learned from the rows for
    which ``held_out`` is false: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score. ``order`` is at most 6."""
    sc = docs.sparkSession.sparkContext
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), clean_text("text").alias("text"))
    counts = stored(src.select(~F.col("held_out"), "text").mapInArrow(_count(order), "word string, gram long, n long, n_train long")
                    .groupBy("word", "gram").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train")))
    words, byte_counts = counts.filter(F.col("word").isNotNull()), counts.filter(F.col("gram").isNotNull())
    ends = src.filter(~F.col("held_out")).count()
    totals = words.agg(F.sum("n_train"), F.sum((F.col("n_train") > 0).cast("long"))).first()
    tokens, kinds = (totals[0] or 0) + ends, (totals[1] or 0) + (ends > 0)

    ready = stored(gram_scores(byte_counts.select("gram", "n_train"), order))
    n_grams = ready.count()
    n_blocks = max(1, -(-n_grams // block))
    blocks = []
    for i in range(n_blocks):       # of a bounded size each
        part = ready.filter(F.pmod(F.xxhash64("gram"), F.lit(n_blocks)) == i).orderBy("gram").toArrow()
        blocks.append(sc.broadcast((part["gram"].to_numpy(), part["logp"].to_numpy())))
    top = words.orderBy(F.col("n").desc(), "word").limit(frequent).select("word", "n_train").toArrow()
    known = sc.broadcast((dict(zip(top["word"].to_pylist(), top["n_train"].to_pylist(), strict=True)), ends))

    scored = stored(src.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.md5("text").alias("key"), "held_out", "text")
                    .mapInArrow(_score(order, blocks[0], known),
                                "row long, doc_id long, key string, held_out boolean, n_tokens long, n_known long, base double, "
                                "score double, rest array<string>, times array<int>"))
    for sent in blocks[1:]:
        more = (src.select(F.md5("text").alias("key"), "text").mapInArrow(_more(order, sent), "key string, more double")
                .groupBy("key").agg(F.first("more").alias("more")))
        scored = scored.join(more, "key").withColumn("score", F.col("score") + F.col("more")).drop("more")
    rest = (scored.select("row", F.explode(F.arrays_zip("rest", "times")).alias("w"))
            .select("row", F.col("w.rest").alias("word"), F.col("w.times").alias("times"))
            .join(words.filter("n_train > 0").select("word", "n_train"), "word")
            .groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n_train") + 1.0)).alias("rest_base"),
                                F.sum("times").alias("rest_known")))
    least = F.log10(F.lit(float(tokens + kinds + 1)))
    return (scored.drop("rest", "times", "key").join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest_base", F.lit(0.0)) - F.col("n_tokens") * least).alias("base_score"), "score"))


def op6_ppm_scores(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` scored by the trie learned from the
    documents outside the fold crc32(doc_id) modulo 7 = 2: doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score."""
    return score(table(spark, sf_dir, "documents").select("doc_id", "text"), crc_mod("doc_id", 7) == 2)
