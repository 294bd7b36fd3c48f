"""Importance resampling (operator 11) against a plain version."""
import collections
import hashlib
import math
import re
import zlib

import pytest

from touchline.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string"


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_codes(text, n, buckets):
    words = plain_words(text)
    return [zlib.crc32(" ".join(words[i:i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, n=1, buckets=10000, seed=2024, min_words=20, percent=10):
    s, t = collections.Counter(), collections.Counter()
    for _, text in docs:
        s.update(plain_codes(text, n, buckets))
    for text in target:
        t.update(plain_codes(text, n, buckets))
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        codes = plain_codes(text, n, buckets)
        weight = sum(math.floor(1000 * math.log((t[c] + 1.0) * (s_all + buckets) / ((s[c] + 1.0) * (t_all + buckets)))) for c in codes)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(codes), weight, score, None, len(plain_words(text))])
    pool = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(pool[:percent * len(pool) // 100]):
        r[4] = i + 1
    return rows


def as_rows(rows):
    return sorted((tuple(r[:5]) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


LONG = ("Alpha beta-Gamma ÉÈ 12 " * 4000) + "x" * 30000 + " end " + "𝔘nicode中 " * 900
TEXTS = [None, "", " .,;", "one", "A B c é É 日本 x\x00y {z}", LONG, "word " * 25, "word " * 25, "benchmark passage " * 15,
         *[f"text number {i} of some words that go on and on and on and repeat the words of number {i} until twenty or more" for i in range(40)]]


@pytest.mark.parametrize(("n", "buckets", "percent"), [(1, 10000, 10), (1, 7, 50), (3, 500, 40)])
def test_resampling_equals_a_plain_version(spark, n, buckets, percent):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "one"), (None, "of null id " * 10), (-5, "word " * 25)]
    target = ["Benchmark passage and words", None, "", "text number of words"]
    got = resampling.resample(
        spark.createDataFrame([(i, t, "s", 7) for i, t in docs], DOCS + ", score string, place int"),
        spark.createDataFrame([(t,) for t in target], "text string"), n=n, buckets=buckets, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert all(k == "bigint" for _, k in got.dtypes)
    assert as_rows(got.collect()) == as_rows(plain(docs, target, n, buckets, percent=percent))


def test_resampling_of_empty_tables_and_targets(spark):
    none, no_target = spark.createDataFrame([], DOCS), spark.createDataFrame([], "text string")
    assert resampling.resample(none, no_target).count() == 0
    docs = [(i, t) for i, t in enumerate(TEXTS)]
    got = resampling.resample(spark.createDataFrame(docs, DOCS), no_target)
    assert as_rows(got.collect()) == as_rows(plain(docs, []))


def test_pieces_lose_no_word():
    for size in (1, 5, 64, 1 << 13):
        cut = list(resampling.pieces(LONG, size))
        assert "".join(cut) == LONG
        assert [w for p in cut for w in WORD.findall(p)] == WORD.findall(LONG)
