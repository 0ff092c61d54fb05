import os

import pytest

from pyspark.sql import functions as F

from flowmarts.operators import bruteforce, ip, severity
from flowmarts.plans import jobs, rollups
from flowmarts.plans.rollups import Rollups
from flowmarts.schema import MART_SCHEMAS
from flowmarts.session import shared_dir
from flowmarts.sources import flow_table, sinks


@pytest.fixture(scope="module")
def run(spark, flows, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("marts"))
    assert not sinks.results_available(spark, out)
    return out, jobs.run_marts(spark, flows, out).collect()


def test_all_jobs_succeed(run):
    _, timings = run
    assert [r.job for r in timings] == [*jobs.JOBS, "total"]
    assert {r.status for r in timings} == {"ok"}
    assert all(r.seconds > 0 for r in timings)


def test_written_marts_have_the_declared_schema(spark, flows, run):
    out, _ = run
    assert sinks.results_available(spark, out)
    rollups = Rollups(spark, flows)
    for job, build in jobs.JOBS.items():
        marts = build(flows, rollups)
        assert set(marts) == set(MART_SCHEMAS[job])
        for name, mart in marts.items():
            read = sinks.read_mart(spark, out, job, name)
            assert sorted(read.dtypes) == sorted(mart.dtypes), name
            want = sorted(map(str, mart.select(*read.columns).collect()))
            assert sorted(map(str, read.collect())) == want, name
    rollups.drop()


def test_rollup_tables_are_written_once_and_removed(spark, flows, tmp_path):
    base = tmp_path / "rollups"
    rollups = Rollups(spark, flows, str(base))
    first = rollups["category_port"]
    assert rollups["category_port"] is first
    assert sorted(os.listdir(base)) == ["category_port"]
    assert first.count() > 0
    rollups.drop()
    assert not base.exists()


def test_failing_job_is_recorded_and_others_run(spark, flows, tmp_path):
    def broken(flows, rollups):
        raise ValueError("no such report")

    def failing_write(flows, rollups):
        return {"bad": flows.selectExpr("raise_error('inside a task')")}

    chosen = {
        "broken": broken,
        "failing_write": failing_write,
        "attack_distribution": jobs.JOBS["attack_distribution"],
    }
    rows = {r.job: r for r in jobs.run_marts(spark, flows, str(tmp_path), jobs=chosen).collect()}
    assert rows["broken"].status == "failed" and "no such report" in rows["broken"].error
    assert rows["failing_write"].status == "failed"
    assert rows["attack_distribution"].status == "ok" and rows["total"].status == "failed"


def test_missing_mart_is_empty(spark, tmp_path):
    read = sinks.read_mart(spark, str(tmp_path), "suspicious_ip", "top_suspicious_ips")
    assert read.count() == 0 and "attack_types" in read.columns


def test_documents(spark, flows, tmp_path):
    out = str(tmp_path)
    assert sinks.read_document(spark, out, "suspicious_ip") == {}
    chosen = {"suspicious_ip": jobs.JOBS["suspicious_ip"]}
    jobs.run_marts(spark, flows, out, fmt="document", jobs=chosen)
    stored = sinks.read_document(spark, out, "suspicious_ip")
    assert set(stored) == set(MART_SCHEMAS["suspicious_ip"])
    want = [r.asDict() for r in ip.top_suspicious_ips(flows).collect()]
    assert stored["top_suspicious_ips"] == want
    timings = sinks.read_document(spark, out, "run")["job_timings"]
    assert [t["job"] for t in timings] == ["suspicious_ip", "total"]


def test_documents_have_no_row_limit(spark, tmp_path):
    rows = spark.range(12_000).select("id", F.lit(None).cast("string").alias("note")).orderBy(F.desc("id"))
    sinks.write_document(str(tmp_path), "x", {"many": rows, "one": rows.limit(1)})
    stored = sinks.read_document(spark, str(tmp_path), "x")
    assert [r["id"] for r in stored["many"]] == list(range(11_999, -1, -1))
    assert stored["one"] == [{"id": 11_999, "note": None}]


def test_a_failed_rollup_is_tried_again(spark, flows, monkeypatch, tmp_path):
    calls = []

    def flaky(frame):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("once")
        return rollups.category_port_counts(frame)

    monkeypatch.setitem(rollups.BUILDERS, "category_port", flaky)
    kept = rollups.Rollups(spark, flows, str(tmp_path))
    with pytest.raises(RuntimeError):
        kept["category_port"]
    assert kept["category_port"].count() > 0


def test_a_table_without_optional_columns_keeps_its_jobs(spark, flows, tmp_path):
    timings = jobs.run_marts(spark, flows.drop("hour", "syn_flag_count"), str(tmp_path)).collect()
    assert {r.status for r in timings} == {"ok"}
    matrix = sinks.read_mart(spark, str(tmp_path), "attack_distribution", "attack_hour_matrix")
    assert matrix.agg(F.sum("no_hour")).first()[0] == flows.where("attack_category <> 'Benign'").count()


def test_rollups_answer_the_default_threshold_only(flows):
    cube = rollups.traffic_cube(flows)
    assert bruteforce.high_syn(cube).collect() == bruteforce.high_syn(flows).collect()
    with pytest.raises(ValueError, match="rollup"):
        bruteforce.high_syn(cube, threshold=1)


def test_a_foreign_severity_column_is_not_trusted(flows):
    foreign = flows.withColumn("severity", F.lit("Odd"))
    assert severity.severity_totals(foreign).collect() == severity.severity_totals(flows).collect()


def test_view_under_capture_headers(spark, flows):
    flow_table.register_flow_view(flows, "captured", capture_headers=True)
    row = spark.sql("select max(`Flow Bytes/s`), count(distinct `Source IP`) from captured").first()
    assert row[0] > 0 and row[1] > 1


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    else:
        assert os.path.isdir(shared_dir(spark))


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_a_failed_rerun_leaves_the_former_report(spark, flows, tmp_path, fmt):
    """A mart that fails in its tasks, after others of its job are written."""
    base = str(tmp_path)
    marts = {"total_records": flows.groupBy().count(), "attack_categories": flows.groupBy("attack_category").count()}
    sinks.write_marts(base, "attack_distribution", marts, fmt)
    first = sinks.current_version(spark, f"{base}/attack_distribution")
    before = {m: _rows(spark.read.format(fmt).load(sinks.mart_path(spark, base, "attack_distribution", m))) for m in marts}
    broken = {"total_records": flows.limit(3).groupBy().count(), "attack_categories": flows.selectExpr("raise_error('lost')")}
    with pytest.raises(Exception, match="lost"):
        sinks.write_marts(base, "attack_distribution", broken, fmt)
    assert sinks.current_version(spark, f"{base}/attack_distribution") == first
    assert {m: _rows(spark.read.format(fmt).load(sinks.mart_path(spark, base, "attack_distribution", m))) for m in marts} == before
    assert sorted(n for n in os.listdir(f"{base}/attack_distribution") if n.startswith("v-")) == [first]


def test_a_failed_document_leaves_the_former_one(spark, flows, tmp_path):
    base = str(tmp_path)
    sinks.write_document(base, "run", {"total": flows.groupBy().count()})
    before = sinks.read_document(spark, base, "run")
    assert before["total"]
    with pytest.raises(Exception, match="lost"):
        sinks.write_document(base, "run", {"total": flows.selectExpr("raise_error('lost')")})
    assert sinks.read_document(spark, base, "run") == before


def test_a_reader_keeps_its_version_and_older_ones_go(spark, flows, tmp_path):
    base = str(tmp_path)
    sizes = []
    for n in (1, 2, 3, 4):
        sinks.write_marts(base, "run", {"job_timings": spark.range(n)}, "parquet")
        path = sinks.mart_path(spark, base, "run", "job_timings")
        sizes.append(spark.read.parquet(path))
    assert [df.count() for df in sizes[2:]] == [3, 4]
    assert len([n for n in os.listdir(f"{base}/run") if n.startswith("v-")]) == 2
