"""Toxicity by non-negative positive-unlabelled learning (operator 2).

A linear model over the presence of words and word beginnings (hashed) is
fitted in numpy from confirmed positive texts and unlabelled ones. Its risk is
pi * R_p(+) + max(0, R_u(-) - pi * R_p(-)) with the logistic loss and the class
prior pi: where a mini-batch's corrected negative risk falls below zero, the
step undoes it (the non-negative estimator). An L1 step keeps few weights, so
scoring looks at few features of any text.

The fit reads at most ``max_positive`` positive and ``max_unlabelled``
unlabelled documents, those with the smallest hash of their id, as hashed
features of the whole texts; the prior is counted over all labelled rows.
Scoring covers every whole text.

Cases: null text counts as empty; an empty text has the score of the bias alone;
a null score is never given; repeated rows are scored alike, each on its own
row; a doc_id with several labels counts as positive if one of them is 1; null
labels are left out; without any positive the model is the prior alone; empty
tables give no rows; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import byte_slices, crc_mod, ship, slices, small_batches, table, word_codes

ship(__name__)

#: Length of the word beginnings that are features besides the word.
PREFIXES = (4, 5, 6, 7)
#: Bytes of text that a worker lays out as features at once.
SLICE = 1 << 20
STRIP = ".,;:!?\"'()[]{}|*#$%&@<>=+-_/\\~`^«»„“”’…"


@dataclass(frozen=True)
class Settings:
    max_positive: int = 4096
    max_unlabelled: int = 8192
    min_positive_docs: int = 3   # a feature occurs in so many positive texts at least
    steps: int = 1000            # mini-batches in all, in whole rounds over the unlabelled texts
    batch: int = 512
    rate: float = 0.1
    l1: float = 2e-4
    beta: float = 0.0            # corrected negative risk below -beta is undone
    seed: int = 7


@dataclass(frozen=True)
class Model:
    bias: float
    keys: np.ndarray             # sorted feature hashes (uint32)
    weights: np.ndarray


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of each word: the word without outer punctuation, and its
    beginnings. Returns (hashes, number of the word)."""
    import xxhash

    h, out, owner = xxhash.xxh32_intdigest, [], []
    for i, w in enumerate(words):
        w = w.strip(STRIP).lower()
        if not w:
            continue
        out.append(h("=" + w))
        owner.append(i)
        for k in PREFIXES:
            if len(w) >= k:
                out.append(h("^" + w[:k]))
                owner.append(i)
    return np.array(out, np.uint32), np.array(owner, np.int64)


def text_features(texts: pa.Array, keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) pairs of the texts; with ``keys`` (sorted)
    only those features, as places in ``keys``."""
    offsets, codes, words = word_codes(texts)
    feats, owner = word_features(words.to_pylist())
    if keys is not None:
        at = np.searchsorted(keys, feats)
        at[at == len(keys)] = 0
        hit = keys[at] == feats if len(keys) else np.zeros(len(feats), bool)
        feats, owner = at[hit], owner[hit]
    count = np.bincount(owner, minlength=len(words)) if len(owner) else np.zeros(len(words), np.int64)
    starts = np.cumsum(count) - count
    docs_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    has = count[codes] > 0 if len(codes) else np.zeros(0, bool)
    codes, docs_of = codes[has], docs_of[has]
    if not len(codes):
        return np.empty(0, np.int64), feats[:0]
    # each word once per document before its features are laid out
    pair = np.unique(docs_of.astype(np.int64) * len(words) + codes)
    docs_of, codes = pair // len(words), pair % len(words)
    size = count[codes]
    ends = np.cumsum(size)
    at = np.repeat(starts[codes] - (ends - size), size) + np.arange(ends[-1])
    doc, feat = np.repeat(docs_of, size), feats[at]
    order = np.lexsort((feat, doc))
    doc, feat = doc[order], feat[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (feat[1:] != feat[:-1])
    return doc[first], feat[first]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, positive, features of each text."""
    for b in slices(byte_slices(batches, 2, SLICE)):
        doc, feat = text_features(b.column(2))
        offsets = np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(offsets), pa.array(feat.view(np.int32)))],
            names=["doc_id", "positive", "features"])


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, settings: Settings) -> Model:
    """Fit by mini-batches (AdaGrad with an L1 step)."""
    prior = float(np.clip(prior, 1e-3, 1 - 1e-3))
    flat = np.concatenate(positive) if positive else np.empty(0, np.uint32)
    keys, docs = np.unique(flat, return_counts=True)
    keys = keys[docs >= settings.min_positive_docs]
    bias = float(np.log(prior / (1 - prior)))
    if not len(keys) or not unlabelled:
        return Model(bias, np.empty(0, np.uint32), np.empty(0))

    def rows(texts: list[np.ndarray]) -> list[np.ndarray]:
        out = []
        for f in texts:
            at = np.searchsorted(keys, f)
            at[at == len(keys)] = 0
            out.append(at[keys[at] == f])
        return out

    def gather(some: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(some), np.repeat(np.arange(len(some)), [len(x) for x in some])

    def logits(w: np.ndarray, b: float, cols: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(doc, w[cols], n) + b

    p_rows, u_rows = rows(positive), rows(unlabelled)
    rng = np.random.default_rng(settings.seed)
    w, acc, acc_b = np.zeros(len(keys)), np.full(len(keys), 1e-6), 1e-6
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    n_batches = max(1, len(u_rows) // settings.batch)
    for _ in range(-(-settings.steps // n_batches)):
        u_order, p_order = rng.permutation(len(u_rows)), rng.permutation(len(p_rows))
        for part, p_part in zip(np.array_split(u_order, n_batches),
                                np.array_split(np.resize(p_order, max(len(p_order), n_batches * 64)), n_batches), strict=True):
            pc_, pd_ = gather([p_rows[i] for i in p_part])
            uc, ud = gather([u_rows[i] for i in part])
            zp, zu = logits(w, bias, pc_, pd_, len(p_part)), logits(w, bias, uc, ud, len(part))
            # derivatives of the mean losses: l(z, +) = log(1 + e^-z), l(z, -) = log(1 + e^z)
            r_u = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            gp_pos, gp_neg, gu_neg = -sig(-zp) / len(p_part), sig(zp) / len(p_part), sig(zu) / len(part)
            if r_u >= -settings.beta:
                gp, gu = prior * gp_pos - prior * gp_neg, gu_neg
            else:
                gp, gu = prior * gp_neg, -gu_neg
            g = np.bincount(pc_, gp[pd_], len(w)) + np.bincount(uc, gu[ud], len(w))
            gb = gp.sum() + gu.sum()
            acc += g * g
            acc_b += gb * gb
            step = settings.rate / np.sqrt(acc)
            w -= step * g
            w = np.sign(w) * np.maximum(np.abs(w) - step * settings.l1, 0)
            bias -= settings.rate / np.sqrt(acc_b) * gb
    used = np.abs(w) > 1e-6
    return Model(float(bias), keys[used], w[used])


def train(docs: DataFrame, labelled: DataFrame, settings: Settings | None = None) -> Model:
    """Model from ``docs`` (doc_id, text) and ``labelled`` (doc_id, toxic), the
    rows whose labels may be learned from. Positives are the labelled rows with
    1; the unlabelled texts are labelled rows with the label set aside."""
    s = settings or Settings()
    labelled = (labelled.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
                .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n, ones = labelled.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not n:
        return Model(0.0, np.empty(0, np.uint32), np.empty(0))
    by_hash = lambda seed: (F.xxhash64(F.col("doc_id"), F.lit(seed)), F.col("doc_id"))
    marked = lambda rows, positive: rows.select("doc_id", F.lit(positive).alias("positive"))
    sample = marked(labelled.filter("toxic = 1").orderBy(*by_hash(s.seed)).limit(s.max_positive), True).unionAll(
        marked(labelled.orderBy(*by_hash(s.seed + 1)).limit(s.max_unlabelled), False))
    texts = docs.join(F.broadcast(sample), "doc_id").select("doc_id", "positive", "text")
    with small_batches(docs.sparkSession):
        rows = (texts.mapInArrow(_features, "doc_id long, positive boolean, features array<int>")
                .groupBy("doc_id", "positive").agg(F.min("features").alias("features")).toArrow())
    order = np.lexsort((rows["doc_id"].to_numpy(),))
    lists = rows["features"].combine_chunks()
    at, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint32)
    positive = rows["positive"].to_numpy()
    pick = lambda which: [flat[at[i]:at[i + 1]] for i in order if positive[i] == which]
    return fit(pick(True), pick(False), ones / n, s)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score``: the probability of the label 1 (double)."""
    sent = docs.sparkSession.sparkContext.broadcast((model.bias, model.keys, model.weights))
    keep = [c for c in docs.columns if c.lower() != "score"]
    at = keep.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, keys, weights = sent.value
        for b in slices(byte_slices(batches, at, SLICE)):
            doc, place = text_features(b.column(at), keys)
            z = (np.bincount(doc, weights[place], b.num_rows) if len(doc) else np.zeros(b.num_rows)) + bias
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(len(keep))], pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))],
                names=[*b.schema.names[:len(keep)], "score"])

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("score", T.DoubleType())])
    return docs.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)


def train_on_folds(spark, docs: DataFrame, sf_dir: str) -> Model:
    """The model of the registered query: labels of rows whose crc32(doc_id)
    modulo 5 is not 0."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(crc_mod("doc_id", 5) != 0)
    return train(docs.select("doc_id", "text"), labels)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` scored: doc_id, held_out, score,
    predicted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train_on_folds(spark, docs, sf_dir))
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
