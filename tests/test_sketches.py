"""Sketches that merge, and rollups kept per date."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from checks import events
from flowmarts.operators import sketches
from flowmarts.plans import rollups
from flowmarts.plans.rollup_store import KEYS, RollupStore

COUNTED = ["traffic_cube", "category_port", "ip_category", "ip_port"]


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_rank_errors_are_within_the_bound(spark, size):
    rows = sketches.percentile_sketch_errors(events.flows(spark, f"/root/testdata/{size}"), k=512).collect()
    assert len(rows) == 9 or len(rows) == 10
    for r in rows:
        assert all(r[c] for c in r.__fields__ if c != "attack_category"), r


def test_a_wrong_report_is_found(spark, flows):
    report = sketches.flow_percentiles_sketched(flows).withColumn("p90_bytes", F.col("p90_bytes") * 2)
    rows = sketches.within_rank_error(flows, report, 0.001).collect()
    assert not any(r.p90_bytes for r in rows if r.attack_category == "Benign") and all(r.p50_bytes for r in rows)


def test_a_task_merges_no_more_than_the_salts(spark, flows):
    """With 60 splits and 8 salts the first level has a row per salt and category."""
    many = flows.repartition(60)
    salts = many.groupBy("attack_category", (F.spark_partition_id() % 8).alias("s")).count().groupBy("attack_category").agg(F.count("*").alias("n"))
    assert max(r.n for r in salts.collect()) == 8
    plan = sketches.percentile_sketches(many, salts=8)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and "% 8" in plan
    n = {r.attack_category: r.n for r in sketches.percentile_sketches(many, salts=8).select("attack_category", F.kll_sketch_get_n_double("bytes_sketch").alias("n")).collect()}
    assert n == {r.attack_category: r["count"] for r in flows.groupBy("attack_category").count().collect()}


def test_sketches_without_values(make_flows):
    none = make_flows({}).limit(0)
    assert sketches.flow_percentiles_sketched(none).collect() == []
    nulls = make_flows({"flow_bytes_s": None, "flow_duration": None, "attack_category": None}, {"attack_category": "Bot", "flow_bytes_s": 3.456, "flow_duration": 7})
    got = {r.attack_category: tuple(r)[1:] for r in sketches.flow_percentiles_sketched(nulls).collect()}
    assert got == {None: (None,) * 5, "Bot": (3.46, 3.46, 3.46, 7, 7)}
    report = sketches.flow_percentiles_sketched(nulls)
    checked = {r.attack_category: tuple(r)[1:] for r in sketches.within_rank_error(nulls, report, 0.0).collect()}
    assert checked == {None: (None,) * 5, "Bot": (True,) * 5}


def test_distinct_counts_merge(spark):
    flows = spark.range(40_000).selectExpr("'Bot' as attack_category", "concat('a', id % 9000) as source_ip", "concat('b', id) as destination_ip", "cast(id % 3 as int) as destination_port", "id % 4 as part")
    by = ["part", "attack_category"]
    merged = sketches.distinct_of(sketches.merged_distinct(sketches.distinct_sketches(flows, by), by[1:]), by[1:]).first()
    assert merged.unique_destination_port == 3
    assert abs(merged.unique_source_ip / 9_000 - 1) < 0.04 and abs(merged.unique_destination_ip / 40_000 - 1) < 0.04


def whole(flows, name):
    return sorted(map(str, rollups.BUILDERS[name](flows).collect()))


def rounded(df):
    """Sums of doubles depend on their order in the last digits."""
    return df.select(*[F.round(c, 3).alias(c) if t == "double" else c for c, t in df.dtypes])


def test_two_runs_merge_to_the_whole(spark, flows, tmp_path):
    store = RollupStore(spark, str(tmp_path / "store"))
    flows = flows.withColumn("date", F.when(F.col("date") > "2024-01-02", F.col("date")))
    dates = sorted((r[0] for r in flows.select("date").distinct().collect()), key=lambda d: (d is not None, d))
    assert dates[0] is None and len(dates) > 3
    half = flows.filter(F.col("date") <= F.lit(dates[2]))
    assert store.add(half) == dates[1:3]
    assert store.add(flows) == [None, *dates[3:]] and store.dates() == set(dates)
    assert store.add(flows) == []
    for name in COUNTED:
        built = rollups.BUILDERS[name](flows)
        columns = sorted(built.columns)
        assert sorted(map(str, rounded(store.read(name).select(*columns)).collect())) == sorted(map(str, rounded(built.select(*columns)).collect())), name
    some = store.read("category_port", first=dates[1], last=dates[2])
    assert sorted(map(str, some.collect())) == whole(half, "category_port")
    categories = flows.select("attack_category").distinct().count()
    assert store.percentiles().count() == store.distinct(last=dates[-1]).count() == categories


def test_a_run_that_failed_is_repeated(spark, flows, tmp_path, monkeypatch):
    store = RollupStore(spark, str(tmp_path / "store"))
    built = rollups.BUILDERS["ip_category"]
    monkeypatch.setitem(rollups.BUILDERS, "ip_category", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.add(flows)
    assert os.path.exists(f"{store.base}/traffic_cube") and store.dates() == set()
    monkeypatch.setitem(rollups.BUILDERS, "ip_category", built)
    store.add(flows)
    for name in ("category_port", "ip_category"):
        columns = rollups.BUILDERS[name](flows).columns
        assert sorted(map(str, store.read(name).select(*columns).collect())) == whole(flows, name)


def test_an_empty_store(spark, make_flows, tmp_path):
    store = RollupStore(spark, str(tmp_path / "store"))
    assert store.dates() == set()
    with pytest.raises(FileNotFoundError):
        store.read("ip_port")
    dated = make_flows({}).withColumn("date", F.lit(datetime.date(2020, 1, 1)))
    assert store.add(dated.limit(0)) == [] and store.add(dated) == [datetime.date(2020, 1, 1)]
    assert set(KEYS) >= set(rollups.BUILDERS)


def test_new_flows_are_computed_once(spark, flows, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    store = RollupStore(spark, str(tmp_path / "store"))
    dates = sorted(r[0] for r in flows.select("date").distinct().collect())
    half = flows.filter(F.col("date") <= F.lit(dates[2]))
    watched = flows.withColumn("flow_bytes_s", counted("flow_bytes_s"))
    store.add(half)
    store.add(watched)
    assert seen.value == flows.count() - half.count()
    assert sorted(os.listdir(store.base)) == sorted(KEYS)
    for name in ("category_port", "ip_category"):
        columns = rollups.BUILDERS[name](flows).columns
        assert sorted(map(str, store.read(name).select(*columns).collect())) == whole(flows, name)
