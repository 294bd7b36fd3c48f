"""Corpus preparation: five stages over ``documents``, each by one operator.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept, and returns a DataFrame that is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``.
Stages that hand whole texts to Python write their result themselves
(:func:`stored`), in small batches: executors keep the memory that large ones took.

Cases: null and empty texts pass every filter (they have no toxic word, no
shingle, no benchmark passage and no secret); of repeated rows and of any group
of near duplicates the row with the smallest doc_id stays; rows with null ids
are kept like others; an empty table stays empty; further columns pass through.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import bpe, jaccard, secrets, tiling, toxicity
from touchline.llm.common import shared_dir, stored, table

#: No SQL can train a classifier; the tests hold the stages against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier scores below 0.5."""
    model = toxicity.train_on_folds(spark, docs, sf_dir)
    scored = toxicity.score(docs.withColumnsRenamed({"score": "__score__"}), model)
    return stored(scored.filter(F.col("score") < 0.5).drop("score").withColumnsRenamed({"__score__": "score"}).select(*docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest
    doc_id. Texts without a word are in no group; all distinct ones stay. Rows
    are known by a hash of doc_id and text, which repeated rows share."""
    row = F.xxhash64("doc_id", "text")
    found = jaccard.near_duplicates(docs.select(row.alias("doc_id"), "text"))
    member = found.select(F.col("doc_id").alias("__row__"), "component_id").distinct()
    names = docs.select(row.alias("__row__"), "doc_id").distinct()
    first = (member.join(names, "__row__").groupBy("component_id")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row__"))["__row__"].alias("__row__")))
    return (docs.withColumn("__row__", row).join(first.select("__row__"), "__row__").dropDuplicates(["__row__"])
            .select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = tiling.contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return tiling.clean(docs, stored(found.select("doc_id", "text_hash").distinct()))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by ``[SECRET]``, n_chars with it."""
    ratios = secrets.train(secrets.labelled_samples(docs))
    spans = secrets.scan(docs.select("text", F.struct(*docs.columns).alias("__all__")), ratios)
    cols = [F.col("text") if c == "text" else F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
            else F.col("__all__")[c].alias(c) for c in docs.columns]
    return secrets.redact(spans).select(*cols)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text with a digest of the decoded bytes: doc_id, lang,
    source, n_tokens, ids (little-endian unsigned 32-bit), decoded_sha256."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = stored(bpe.encode(docs.select("doc_id", "lang", "source", "text"), path).drop("text"))
    return stored(bpe.decode(ids, path).select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256")))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is written to
    the shared folder."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
