"""Versions and the pointer, observed column tests, failing rows."""
import os
import re

import pytest
from pyspark.sql import functions as F

from test_sources import source_dir  # noqa: F401
from touchline.plans import model_tests
from touchline.plans.warehouse import Warehouse
from touchline.registry import raw_layer, warehouse
from touchline.run import refresh
from touchline.sources import fixtures
from touchline.sources.publish import current, new_version, publish
from util import SF_SMALL


def test_pointer_names_one_version(spark, tmp_path):
    root = str(tmp_path / "set")
    assert current(spark, root) is None
    seen = []
    for n in (1, 2, 3):
        v = new_version(root)
        spark.range(n).write.parquet(f"{v}/t")
        publish(spark, root, v)
        seen.append(v)
        assert current(spark, root) == v and spark.read.parquet(f"{current(spark, root)}/t").count() == n
    assert seen == sorted(seen) and sorted(os.listdir(f"{root}/versions")) == [os.path.basename(v) for v in seen]
    assert not [f for f in os.listdir(root) if f.startswith(".CURRENT-") and not f.endswith(".crc")]
    with pytest.raises(FileNotFoundError):
        publish(spark, root, f"{root}/versions/none")
    assert current(spark, root) == seen[-1]


def test_a_failing_refresh_leaves_the_published_tables(spark, source_dir, tmp_path):  # noqa: F811
    root = str(tmp_path / "out")
    refresh(spark, source_dir, root)
    good = current(spark, root)
    facts = spark.read.parquet(f"{good}/marts/fct_attributed_revenue").count()
    with open(os.path.join(source_dir, "campaign_metadata.csv"), "a") as f:
        f.write("CMP-003,blog_c,blog,CTC-001,100,2024-01-01,2024-05-01,cmp_001\n")
    with pytest.raises(model_tests.ModelTestError, match="utm_campaign"):
        refresh(spark, source_dir, root)
    assert current(spark, root) == good and spark.read.parquet(f"{good}/marts/fct_attributed_revenue").count() == facts
    bad, = (v for v in os.listdir(f"{root}/versions") if v != os.path.basename(good))
    rows = spark.read.parquet(f"{root}/versions/{bad}/failing_rows/unique.stg_campaign_metadata.utm_campaign").collect()
    assert [(r.utm_campaign, r.n_records) for r in rows] == [("cmp_001", 2)]


def summary_of(df):
    return sorted(((r.test_name, r.model, r.column_name or "", r.failing_rows) for r in df.collect()))


@pytest.mark.parametrize("dirty", [False, True])
def test_watched_models_give_the_same_tests(spark, tmp_path, dirty):
    raw = raw_layer(spark, SF_SMALL)
    w = Warehouse(spark, fixtures.dirtied(raw) if dirty else raw)
    stored = w.materialize(str(tmp_path / "a"))
    watched = w.materialize(str(tmp_path / "b"), metrics=model_tests.metrics)
    plain = model_tests.not_null(stored).unionByName(model_tests.unique(stored)).unionByName(
        model_tests.accepted_values(stored)).unionByName(model_tests.relationships(stored))
    want = summary_of(plain)
    assert len(want) == 59 and any(r[3] for r in want) == dirty
    assert summary_of(model_tests.column_tests(stored)) == want
    assert summary_of(model_tests.column_tests(watched)) == want
    for name, seen in watched.observed.items():
        assert seen["rows"] == watched.model(name).count()
    for test, model, column, n in want:
        if n:
            assert model_tests.failing_rows(watched, test, model, column).count() == n


def test_watched_models_are_read_for_uniqueness_only(spark, tmp_path):
    w = warehouse(spark, SF_SMALL).materialize(str(tmp_path), metrics=model_tests.metrics)
    text = model_tests.column_tests(w)._jdf.queryExecution().optimizedPlan().toString()
    scans = re.findall(r"Relation \[([^\]]*)\] parquet", text)
    unique = sum(m in w.observed for m, _ in model_tests.UNIQUE)
    related = sum(c in w.observed for c, _, _, _ in model_tests.RELATIONSHIPS)
    others = sum(m not in w.observed for m, _ in model_tests.UNIQUE) + 2 * 2 + 4
    assert len(scans) <= unique + related + others
    seen = model_tests.observed_tests(w)
    assert "Relation" not in seen._jdf.queryExecution().optimizedPlan().toString()


def test_campaign_attribution_above_the_total_trips(spark, tmp_path):
    """A journey counted twice is attributed twice."""
    w = warehouse(spark, SF_SMALL)
    twice = Warehouse(spark, w.raw, overrides={"int_campaign_attribution": w.int_campaign_attribution.unionAll(
        w.int_campaign_attribution.withColumn("attributed_revenue", F.lit(1e12)))})
    failing = {(r.test_name, r.model) for r in model_tests.failing_tests(twice).collect()}
    assert ("campaign_attribution_not_exceeds_total", "int_campaign_attribution") in failing
    assert model_tests.failing_rows(twice, "campaign_attribution_not_exceeds_total", "int_campaign_attribution", None).first().failing_rows == 1
