"""Language identification (operator 13): filters against plain sets, held-out accuracy, cases."""
import collections
import re

import numpy as np
import pytest

from touchline.llm import language_id as L

SMALL = "/root/testdata/sf0.001"
CHECK = "/root/testdata/sf0.01"


def plain_grams(text, longest):
    """N-grams of the lower-case letter runs with a border sign on either side."""
    out = collections.Counter()
    for run in re.findall(r"[^\W\d_]+", (text or "").lower()):
        signs = f"\x02{run}\x03"
        for n in range(1, longest + 1):
            out.update(g for g in (signs[i:i + n] for i in range(len(signs) - n + 1)) if g.strip("\x02\x03"))
    return out


TRAIN = [("en", "the cat and the dog"), ("en", "the house and the tree"), ("de", "der Hund und die Katze"), ("de", "das Haus und der Baum"),
         ("fr", "le chat et le chien; la maison"), (None, "zzz zzz"), ("en", None), ("el", "η γάτα και ο σκύλος")]


@pytest.fixture(scope="module")
def filters(spark):
    return L.train(spark.createDataFrame([(a, b, 1) for a, b in TRAIN], "lang string, text string, number int"), longest=4)


def test_filters_hold_every_gram_of_a_language(filters):
    sets = collections.defaultdict(collections.Counter)
    for lang, text in TRAIN:
        if lang:
            sets[lang].update(plain_grams(text, 4))
    assert sorted(filters.languages) == sorted(sets)
    assert filters.languages == sorted(sets, key=lambda a: (-sum(sets[a].values()), a))
    for lang in sets:
        for word in {w for t in TRAIN if t[0] == lang for w in re.findall(r"[^\W\d_]+", (t[1] or "").lower())}:
            n, by = L.hits(filters, [word])
            assert n[0] == sum(plain_grams(word, 4).values())
            assert by[0, filters.languages.index(lang)] == n[0]       # a Bloom filter never loses a member


def test_hits_are_those_of_plain_sets_but_for_false_positives(filters):
    sets = {a: set() for a in filters.languages}
    for lang, text in TRAIN:
        if lang:
            sets[lang] |= set(plain_grams(text, 4))
    for word in ("tree", "unbekannt", "σκύλος", "日本"):
        grams = plain_grams(word, 4)
        n, by = L.hits(filters, [word])
        for i, lang in enumerate(filters.languages):
            true = sum(c for g, c in grams.items() if g in sets[lang])
            assert true <= by[0, i] <= true + max(1, 4 * filters.passes[i] * n[0])


def test_a_bit_for_each_of_many_languages(spark):
    rows = [(f"l{i:03}", f"{chr(0x4E00 + 7 * i)}{chr(0x4E01 + 7 * i)} {chr(0x4E02 + 7 * i)}") for i in range(150)]
    own = L.train(spark.createDataFrame(rows, "lang string, text string"))
    assert own.bits.shape[1] == 3
    got = L.identify(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string"), own)
    assert {r.doc_id: r.lang_pred for r in got.collect()} == {i: a for i, (a, _) in enumerate(rows)}


def test_rare_grams_are_not_kept(spark):
    rows = [("en", "aaaa " * 500 + "qqqq"), ("de", "bbbb " * 500)]
    own = L.train(spark.createDataFrame(rows, "lang string, text string"), share=100)
    n, by = L.hits(own, ["aaaa", "qqqq"])
    assert by[0, own.languages.index("en")] == n[0] and by[1].sum() < n[1]


def test_cases(spark, filters):
    texts = [(1, None), (2, ""), (3, "123 ... _ ½ Ⅷ"), (4, "the tree"), (5, "und das Haus"), (6, "日本語"), (7, "Σκύλος"), (8, "the tree"),
             (None, "LE CHIEN"), (9, "the and dog " * 100_000), (10, "x" * 1_000_000)]
    df = spark.createDataFrame([(i, t, "kept", 5, "old") for i, t in texts], "doc_id long, text string, lang string, score int, lang_pred string")
    got = {r.doc_id: r for r in L.identify(df, filters).collect()}
    assert len(got) == len(texts) and set(got[4].asDict()) == {"doc_id", "lang", "lang_pred", "score"}
    assert [(got[i].lang_pred, got[i].score) for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert [got[i].lang_pred for i in (4, 5, 7, 8, None, 9)] == ["en", "de", "el", "en", "fr", "en"]
    assert got[6].lang_pred in filters.languages and got[10].lang_pred in filters.languages
    assert all(0 <= r.score <= 1 for r in got.values()) and got[4] == got[8].__class__(**{**got[8].asDict(), "doc_id": 4})
    assert all(r.lang == "kept" for r in got.values())


def test_empty_tables(spark, filters):
    none = spark.createDataFrame([], "lang string, text string")
    untaught = L.train(none)
    assert untaught.languages == []
    got = L.identify(spark.createDataFrame([(1, "the tree")], "doc_id long, text string"), untaught).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert L.identify(spark.createDataFrame([], "doc_id long, text string"), filters).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{CHECK}/documents.parquet").select("doc_id", "lang")
    got = L.op13_language_id(spark, CHECK).join(docs, "doc_id").filter("held_out AND lang IS NOT NULL").collect()
    assert len(got) > 100 and np.mean([r.lang == r.lang_pred for r in got]) >= 0.99
