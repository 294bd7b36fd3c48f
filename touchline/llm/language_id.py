"""Language identification by language-bitmask n-gram filters (operator 13).

* Training counts the character n-grams (1 to ``longest`` letters, word borders
  included) of each language's texts. A language keeps the n-grams that make up at
  least one in ``share`` of its occurrences, so at most ``share`` of them.
* All languages' Bloom filters lie side by side, bit-sliced: position p holds one
  bit for each language. An n-gram has ``hashes`` positions; the bits that all of
  them have set are the languages that (may) contain it, found in one look-up
  whatever the number of languages.
* A text's n-grams are looked up, and for each language the hits are counted. A
  filter whose share of set bits is f passes ``f ** hashes`` of foreign n-grams;
  with G n-grams and h hits, ``(h - G f**k) / (1 - f**k)`` remain. The language
  with the most decides; the score is its part of all languages' remainders.

The counts cover all training documents and are added up by Spark; the filter has
a fixed number of positions and is sent out. N-grams are made once for each
different word of a slice of texts, so a long text costs its words.

Cases: null text or a text without a letter: ``und`` with score 0; a text whose
n-grams no language has: the language with the most training text, score 0; ties
go to the language with more training text, then to the smaller name; with no
training row every text is ``und``; rows with a null lang are not learned from;
repeated rows count as often as they occur; an empty table gives no rows; other
columns pass through unless they are named lang_pred or score, which are replaced.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import byte_slices, crc_mod, mix, ship, stored, table

ship(__name__)

#: Languages that are learned: those with the most training text.
MAX_LANGUAGES = 256
UNKNOWN = "und"


@dataclass(frozen=True)
class Filters:
    """Bit-sliced Bloom filters. ``bits[p, w]`` holds, at position p, the bits of
    languages 64 w to 64 w + 63; ``passes`` is each language's false-positive rate."""

    languages: list[str]
    bits: np.ndarray
    passes: np.ndarray
    longest: int
    hashes: int


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(documents' offsets, codes, for each code its word): the lower-case runs of
    letters of the texts; what lies between runs is left as one empty word."""
    texts = pc.cast(pc.fill_null(texts, ""), pa.large_string())
    texts = texts.take(pa.array(np.arange(len(texts))))     # the kernels below expect an array of its own
    lists = pc.split_pattern(pc.replace_substring_regex(pc.utf8_lower(texts), r"\P{L}+", " "), " ")
    coded = pc.dictionary_encode(lists.flatten())
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


def grams_of(words: list[str], longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(word number, 64-bit n-gram) of every n-gram, 1 to ``longest`` signs, of the
    words, each with a border sign before and after. Borders alone are no n-gram."""
    sizes = np.array([len(w) + 2 if w else 0 for w in words], np.int64)
    signs = np.frombuffer("".join(f"\x02{w}\x03" for w in words if w).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(signs):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    at, base = np.arange(len(signs)), np.uint64(0x9E3779B97F4A7C15)
    word, gram, value = [], [], np.zeros(len(signs), np.uint64)
    for n in range(1, longest + 1):
        value = value[:max(len(signs) - n + 1, 0)] * base + signs[n - 1:]
        ok = at[:len(value)] + n <= ends[:len(value)]
        if n == 1:
            ok &= signs > 3
        word.append(owner[:len(value)][ok])
        gram.append(mix(value[ok] + np.uint64(n)))
    return np.concatenate(word), np.concatenate(gram)


def positions(grams: np.ndarray, hashes: int, size: int) -> Iterator[np.ndarray]:
    """``hashes`` times a position below ``size`` (a power of two) of each n-gram."""
    step, last = mix(grams ^ np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1), np.uint64(size - 1)
    at = grams
    for _ in range(hashes):
        yield (at & last).astype(np.int64)
        at = at + step


def _counts(longest: int):
    """lang, gram, n of the texts of a slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, 1):
            offsets, codes, words = words_of(b.column(1))
            owner, grams = grams_of(words, longest)
            coded = pc.dictionary_encode(pa.array(grams.view(np.int64)))
            own, place = coded.dictionary.to_numpy(), coded.indices.to_numpy()
            lang = pc.dictionary_encode(b.column(0))
            of = np.repeat(lang.indices.to_numpy(zero_copy_only=False), np.diff(offsets))
            for i, name in enumerate(lang.dictionary.to_pylist()):
                times = np.bincount(codes[of == i], minlength=len(words))
                n = np.bincount(place, times[owner], len(own)).astype(np.int64) if len(own) else np.empty(0, np.int64)
                some = np.nonzero(n)[0]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(own[some]),
                                                  pa.array(n[some])], names=["lang", "gram", "n"])
    return run


def _marks(hashes: int, size: int):
    """The positions that n-grams set, with the word and the bit of their language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang = b.column(0).to_numpy()
            at = positions(b.column(1).to_numpy().view(np.uint64), hashes, size)
            own = np.unique(np.concatenate([a * MAX_LANGUAGES + lang for a in at]))
            number = own % MAX_LANGUAGES
            bit = np.uint64(1) << (number % 64).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(own // MAX_LANGUAGES), pa.array(number // 64), pa.array(bit.view(np.int64))],
                                             names=["position", "word", "bit"])
    return run


def train(labelled: DataFrame, longest: int = 5, share: int = 100_000, hashes: int = 4, size: int = 1 << 20) -> Filters:
    """Filters from all rows of ``labelled`` (lang, text) with a lang. Of their
    languages the ``MAX_LANGUAGES`` with the most n-grams are learned. What reaches
    the driver is a row for each position that is set, ``size`` at most."""
    rows = labelled.filter("lang IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), "text")
    counts = stored(rows.mapInArrow(_counts(longest), "lang string, gram long, n long")
                    .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy(F.col("total").desc(), "lang").limit(MAX_LANGUAGES).collect()
    languages = [r["lang"] for r in totals]
    width = max(1, -(-len(languages) // 64))
    bits = np.zeros((size, width), np.uint64)
    if languages:
        known = labelled.sparkSession.createDataFrame(
            [(r["lang"], i, r["total"]) for i, r in enumerate(totals)], "lang string, number long, total long")
        kept = counts.join(F.broadcast(known), "lang").filter(F.col("n") * share >= F.col("total")).select("number", "gram")
        words = [F.bit_or(F.when(F.col("word") == w, F.col("bit")).otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in range(width)]
        found = (kept.mapInArrow(_marks(hashes, size), "position long, word long, bit long").groupBy("position").agg(*words).toArrow())
        at = found["position"].to_numpy()
        for w in range(width):
            bits[at, w] = found[f"w{w}"].to_numpy().astype(np.int64).view(np.uint64)
    full = np.array([((bits[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
    return Filters(languages, bits, full ** hashes, longest, hashes)


def hits(filters: Filters, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each word its number of n-grams, and of those each language has."""
    owner, grams = grams_of(words, filters.longest)
    mask = np.full((len(grams), filters.bits.shape[1]), ~np.uint64(0))
    for at in positions(grams, filters.hashes, len(filters.bits)):
        mask &= filters.bits[at]
    n = np.bincount(owner, minlength=len(words))
    by = np.zeros((len(words), len(filters.languages)), np.int64)
    for i in range(len(filters.languages)):
        one = (mask[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
        by[:, i] = np.bincount(owner, one, len(words))
    return n, by


def _decided(filters):
    """The columns with lang_pred and score added; the text is the last column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Filters = filters.value
        names = np.array([*own.languages, UNKNOWN], object)
        for b in byte_slices(batches, -1):
            offsets, codes, words = words_of(b.column(b.num_columns - 1))
            each, by = hits(own, words)

            def summed(values: np.ndarray, codes=codes, offsets=offsets) -> np.ndarray:
                before = np.concatenate([[0], np.cumsum(values[codes])])
                return before[offsets[1:]] - before[offsets[:-1]]

            grams = summed(each)
            left = np.zeros((b.num_rows, len(own.languages)))
            for i, p in enumerate(own.passes):
                left[:, i] = np.maximum((summed(by[:, i]) - grams * p) / (1 - p), 0) if p < 1 else 0
            if len(own.languages):
                best = left.argmax(1)
                every = left.sum(1)
                score = np.divide(left[np.arange(b.num_rows), best], every, out=np.zeros(b.num_rows), where=every > 0)
                best[grams == 0] = len(own.languages)
                score[grams == 0] = 0
            else:
                best, score = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(names[best], pa.string()), pa.array(score)],
                                             names=[*b.schema.names[:-1], "lang_pred", "score"])
    return run


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """The columns of ``docs`` but text, with lang_pred and score of the text."""
    sent = docs.sparkSession.sparkContext.broadcast(filters)
    docs = docs.drop("lang_pred", "score")
    kept = [c for c in docs.columns if c != "text"]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(*kept, F.col("text").cast("string").alias("text")).mapInArrow(_decided(sent), schema)


def op13_language_id(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents``: doc_id, held_out, lang_pred, score; learned from
    the rows whose fold (crc32 of doc_id modulo 5) is not 0."""
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 5) == 0
    filters = train(docs.filter(~held_out).select("lang", "text"))
    return identify(docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text"), filters).select(
        "doc_id", "held_out", "lang_pred", "score")
