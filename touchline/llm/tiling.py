"""Benchmark decontamination by greedy string tiling (operator 1).

Words are compared in lower case without punctuation. Every window of
``min_match`` words of a benchmark item is a seed. A document keeps the
stretches of its words that seeds cover, which is all that a tile can cover;
documents without any are done. Seeds join stretches and items to pairs, and a
pair whose seeds cannot reach the wanted coverage is dropped. Each remaining
pair is tiled: running Karp-Rabin finds the matches of unmarked words, the
longest are marked first, and the search length falls to ``min_match``. The
share of the item's words under tiles is its coverage; pairs of ``coverage`` or
more are returned. Tiles may lie in any order, so reordered passages count.

A bitmap of fixed size holds the seeds' remainders when the documents are
scanned; an exact join follows.

Cases: null or empty texts (and those without letters or digits) match nothing;
an item with fewer than ``min_match`` words is one seed of its own length;
repeated items are items of their own by item_id, and repeated rows of a
document give one result row each; a null item_id or doc_id is kept as null;
empty tables give no rows; other columns are ignored.
"""
from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import byte_slices, in_filter, key_filter, rolling, ship, slices, stored, table, word_codes

ship(__name__)

NOT_WORD = re.compile(r"[\W_]+")


def normal_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """(documents' offsets, word numbers, words, hash of each word) of the
    words in lower case without punctuation; words of punctuation alone go."""
    import xxhash

    offsets, codes, words = word_codes(texts)
    place: dict[str, int] = {}
    number = np.array([place.setdefault(NOT_WORD.sub("", w.lower()), len(place)) for w in words.to_pylist()], np.int64)
    codes = number[codes] if len(codes) else codes.astype(np.int64)
    if "" in place:
        keep = codes != place[""]
        offsets, codes = np.concatenate([[0], np.cumsum(keep)])[offsets], codes[keep]
    return offsets, codes, list(place), np.array([xxhash.xxh3_64_intdigest(w) for w in place], np.uint64)


def _items(min_match: int):
    """item row, item_id, words, seeds of each benchmark item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets, codes, words, hashes = normal_words(b.column(2))
            out_words, seeds = [], []
            for i in range(b.num_rows):
                own = codes[offsets[i]:offsets[i + 1]]
                out_words.append([words[c] for c in own])
                k = min(min_match, len(own))
                seeds.append(rolling(hashes[own], k).view(np.int64).tolist() if k else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out_words, pa.list_(pa.string())), pa.array(seeds, pa.list_(pa.int64()))],
                names=["item", "item_id", "item_words", "seeds"])
    return run


def _stretches(bits, lengths: list[int]):
    """row, doc_id, text_hash, stretches (their words joined by spaces), starts,
    seeds of each document that a seed may hit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(byte_slices(batches, 3, 1 << 20)):
            offsets, codes, words, hashes = normal_words(b.column(3))
            total = len(codes)
            flat = hashes[codes] if total else hashes[:0]
            doc_of = np.repeat(np.arange(b.num_rows), np.diff(offsets))
            depth = np.zeros(total + 1, np.int32)
            hit_docs, hit_keys = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for k in lengths:
                keys = rolling(flat, k).view(np.int64)
                at = np.nonzero(in_filter(bits.value, keys))[0] if len(keys) else np.empty(0, np.int64)
                at = at[at + k <= offsets[doc_of[at] + 1]]     # not beyond the document's end
                np.add.at(depth, at, 1)
                np.add.at(depth, at + k, -1)
                hit_docs.append(doc_of[at])
                hit_keys.append(keys[at])
            covered = np.cumsum(depth)[:total] > 0
            docs, keys = np.concatenate(hit_docs), np.concatenate(hit_keys)
            order = np.argsort(docs, kind="stable")
            docs, keys = docs[order], keys[order]
            which = np.unique(docs)
            out = [[], [], [], []]
            for d in which.tolist():
                lo, hi = int(offsets[d]), int(offsets[d + 1])
                edge = np.diff(np.concatenate([[0], covered[lo:hi].astype(np.int8), [0]]))
                starts, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
                out[0].append(d)
                out[1].append([" ".join([words[c] for c in codes[lo + s:lo + e]]) for s, e in zip(starts, ends, strict=True)])
                out[2].append(starts.tolist())
                out[3].append(np.unique(keys[np.searchsorted(docs, d):np.searchsorted(docs, d, "right")]).tolist())
            pick = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i).take(pick) for i in range(3)], pa.array(out[1], pa.list_(pa.string())),
                 pa.array(out[2], pa.list_(pa.int32())), pa.array(out[3], pa.list_(pa.int64()))],
                names=["row", "doc_id", "text_hash", "stretches", "starts", "seeds"])
    return run


MOD, BASE = (1 << 61) - 1, 1_000_003


def windows(tokens: list[int], marked: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """(start, running Karp-Rabin hash) of each window of unmarked tokens."""
    top, h, run = pow(BASE, size, MOD), 0, 0
    for i, t in enumerate(tokens):
        if marked[i]:
            h, run = 0, 0
            continue
        h = (h * BASE + t) % MOD
        run += 1
        if run > size:
            h = (h - tokens[i - size] * top) % MOD
        if run >= size:
            yield i - size + 1, h


def tile(item: list[int], doc: list[int], min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (item start, document start, length) by greedy string tiling.
    Negative numbers match nothing."""
    in_item, in_doc = [False] * len(item), [t < 0 for t in doc]
    tiles: list[tuple[int, int, int]] = []
    size = max(min_match, min(len(item), 32))
    while item and doc:
        places: dict[int, list[int]] = defaultdict(list)
        for start, h in windows(doc, in_doc, size):
            places[h].append(start)
        found: dict[int, list[tuple[int, int]]] = defaultdict(list)
        longest = 0
        for start, h in windows(item, in_item, size):
            for d in places.get(h, ()):
                k = 0
                while (start + k < len(item) and d + k < len(doc) and not in_item[start + k] and not in_doc[d + k]
                       and item[start + k] == doc[d + k]):
                    k += 1
                if k >= size:
                    found[k].append((start, d))
                    longest = max(longest, k)
            if longest > 2 * size:
                break
        if longest > 2 * size:      # a far longer match: look for matches of that length first
            size = longest
            continue
        for k in sorted(found, reverse=True):
            for start, d in found[k]:
                # what an earlier tile has taken goes; the rest is found again at its length
                if not any(in_item[start:start + k]) and not any(in_doc[d:d + k]):
                    in_item[start:start + k] = in_doc[d:d + k] = [True] * k
                    tiles.append((start, d, k))
        if size == min_match:
            if not found:
                break
            continue
        size = max(min_match, size // 2)
    return tiles


def _tiled(min_match: int, coverage: float):
    """doc_id, item_id, ... of each pair (columns as joined)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                place: dict[str, int] = {}
                item = [place.setdefault(w, len(place) + 1) for w in r["item_words"]]
                doc, at = [], []
                for start, stretch in zip(r["starts"], r["stretches"], strict=True):
                    own = stretch.split(" ")
                    doc += [place.get(w, -1) for w in own] + [-1]
                    at += list(range(start, start + len(own) + 1))
                tiles = tile(item, doc, min(min_match, len(item)))
                matched = sum(k for _, _, k in tiles)
                if matched >= coverage * len(item):
                    rows.append((r["doc_id"], r["text_hash"], r["item_id"], matched, len(item), matched / len(item),
                                 [{"item_start": i, "doc_start": at[d], "length": k} for i, d, k in sorted(tiles)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, TYPES, strict=True)], names=NAMES)
    return run


NAMES = ["doc_id", "text_hash", "item_id", "matched_words", "item_words", "coverage", "tiles"]
TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(),
         pa.list_(pa.struct([("item_start", pa.int32()), ("doc_start", pa.int32()), ("length", pa.int32())]))]
SCHEMA = ("doc_id long, text_hash long, item_id long, matched_words long, item_words long, coverage double, "
          "tiles array<struct<item_start:int,doc_start:int,length:int>>")


def contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, coverage: float = 0.5) -> DataFrame:
    """Pairs of ``docs`` (doc_id, text) and ``benchmark`` (item_id, text) whose
    tiles cover ``coverage`` of the item or more: doc_id, text_hash (xxhash64 of
    the text), item_id, matched_words, item_words, coverage, tiles (places in
    words)."""
    items = stored(benchmark.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"), "text")
                   .mapInArrow(_items(min_match), "item long, item_id long, item_words array<string>, seeds array<long>")
                   .filter(F.size("item_words") > 0))
    seeds = items.select("item", F.size("item_words").alias("n"), F.explode("seeds").alias("seed"))
    lengths = sorted(r[0] for r in items.select(F.least(F.size("item_words"), F.lit(min_match))).distinct().collect())
    bits = docs.sparkSession.sparkContext.broadcast(key_filter(seeds, "seed"))
    hits = stored(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"),
                              F.xxhash64("text").alias("text_hash"), "text")
                  .mapInArrow(_stretches(bits, lengths), "row long, doc_id long, text_hash long, stretches array<string>, "
                                                         "starts array<int>, seeds array<long>"))
    # a seed that the document has counts once for each of its places in the item
    places = seeds.groupBy("seed", "item", "n").agg(F.count(F.lit(1)).alias("places"))
    reach = F.sum("places") * F.least(F.lit(min_match), F.first("n"))
    pairs = (hits.select("row", F.explode("seeds").alias("seed")).join(places, "seed")
             .groupBy("row", "item").agg(reach.alias("reach"), F.first("n").alias("n"))
             .filter(F.col("reach") >= F.col("n") * coverage).select("row", "item"))
    ready = (pairs.join(items.select("item", "item_id", "item_words"), "item")
             .join(hits.select("row", "doc_id", "text_hash", "stretches", "starts"), "row"))
    return ready.mapInArrow(_tiled(min_match, coverage), SCHEMA)


def clean(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the rows in ``found`` (by doc_id and text)."""
    bad = found.select(F.col("doc_id").alias("__id__"), F.col("text_hash").alias("__hash__")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__id__"]) & (F.xxhash64(docs["text"]) == bad["__hash__"]), "left_anti")


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    """Contaminated rows of ``documents`` with the item of ``benchmark``:
    doc_id, item_id, matched_words, item_words, coverage."""
    found = contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"),
                         table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select("doc_id", "item_id", "matched_words", "item_words", "coverage")
