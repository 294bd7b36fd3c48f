"""The pipeline's stages on planted cases, and run() end to end."""
import numpy as np
import pytest

import corpus_pipeline as P

SMALL = "/root/testdata/sf0.001"


@pytest.fixture()
def planted(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    near = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    rows = [(900001, near), (900002, near), (900003, near + " phi"), (900004, "before words here " + item + " after words there"),
            (900005, "the password = hunter2hunter2 is here"), (900006, ""), (900007, None), (900008, "clean words only")]
    own = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], docs.schema)
    return docs.unionByName(own), [i for i, _ in rows]


def test_stages_keep_clean_rows_and_act_on_planted_ones(spark, planted):
    docs, ids = planted
    columns = docs.columns
    kept = {}
    for name, stage in P.STAGES[:4]:
        out = stage(spark, docs, SMALL)
        assert out.columns == columns and out.dtypes == docs.dtypes
        kept[name] = {r.doc_id: r for r in out.collect()}
    assert set(ids) <= set(kept["toxicity"])
    assert {i for i in ids if i in kept["near_duplicates"]} == set(ids) - {900002, 900003}
    assert {i for i in ids if i in kept["decontamination"]} == set(ids) - {900004}
    assert len(kept["secrets"]) == docs.count()
    assert kept["secrets"][900005].text == "the [SECRET] is here" and kept["secrets"][900005].n_chars == 20
    assert kept["secrets"][900007].text is None


def test_empty_table_and_repeated_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0
    one = docs.limit(1)
    assert P.drop_near_duplicates(spark, one.union(one), SMALL).count() == 1


def test_run_ends_in_the_ids_of_the_kept_texts(spark):
    out = P.run(spark, SMALL).collect()
    assert 0 < len(out) < spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert all(r.n_tokens == len(np.frombuffer(r.ids, "<u4")) for r in out)


def test_python_workers_are_handed_whole_texts_in_small_batches(spark, monkeypatch):
    """The stages that score and encode write in batches of the shared size,
    whatever their result is written with."""
    from touchline.llm import common

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    small = common.small_batches

    def watched(session):
        seen.append(True)
        return small(session)

    monkeypatch.setattr(common, "small_batches", watched)
    for stage in (P.drop_toxic, P.encode):
        seen.clear()
        out = stage(spark, docs, SMALL)
        assert seen and "MapInArrow" not in out._jdf.queryExecution().executedPlan().toString()
    assert int(spark.conf.get(name)) > common.BATCH_ROWS
