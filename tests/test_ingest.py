import datetime

import pytest
from pyspark.sql import functions as F

from flowmarts.operators import ingest
from flowmarts.plans import capture_load
from flowmarts.plans.jobs import run_ingest
from flowmarts.schema import NAME_TO_TYPE
from flowmarts.sources import flow_table
from flowmarts.sources.raw import read_captures, read_raw_flows, unique_names

RAW_DDL = "source_file string, flow_duration string, flow_bytes_s string, flow_packets_s string, label string"


def raw(spark, *rows):
    return spark.createDataFrame(rows, RAW_DDL)


def test_bad_rates_go(spark):
    texts = ["1.5", "Infinity", "-Infinity", "NaN", "", "n/a", None]
    rows = [("f", str(i), t, "1", "BENIGN") for i, t in enumerate(texts)]
    rows += [("f", "9", "1", "NaN", "BENIGN")]
    kept = ingest.drop_bad_rates(ingest.coerce_rates(raw(spark, *rows))).collect()
    assert [(r.flow_duration, r.flow_bytes_s) for r in kept] == [("0", 1.5)]


def test_repeats_go_per_file_after_label_repair(spark):
    df = raw(
        spark,
        ("a", "1", "1.0", "2", "BENIGN"),
        ("a", "1", "1", "2.0", " BENIGN "),
        ("b", "1", "1", "2", "BENIGN"),
        ("a", None, "1", "2", "DDoS"),
        ("a", None, "1", "2", "DDoS"),
    )
    cleaned = ingest.clean_flows(df)
    got = sorted((r.source_file, r.attack_category) for r in cleaned.collect())
    assert got == [("a", "Benign"), ("a", "DDoS"), ("b", "Benign")]


def test_one_row_repeated_everywhere(spark):
    rows = spark.range(30000).select(
        F.lit("a").alias("source_file"),
        F.when(F.col("id") % 3 == 0, "0").otherwise(F.col("id").cast("string")).alias("flow_duration"),
        F.lit("1").alias("flow_bytes_s"),
        F.lit("1").alias("flow_packets_s"),
        F.lit("BENIGN").alias("label"),
    )
    assert ingest.clean_flows(rows).count() == 20001
    audit = ingest.ingest_audit(rows).collect()
    assert [tuple(r) for r in audit] == [("a", 30000, 0, 9999, 20001)]


def test_audit(spark):
    df = raw(
        spark,
        ("a", "1", "1", "2", "BENIGN"),
        ("a", "1", "1", "2", "BENIGN"),
        ("a", "1", "NaN", "2", "BENIGN"),
        ("a", "1", "NaN", "2", "BENIGN"),
        ("b", "1", "x", "2", "Bot"),
    )
    got = {r[0]: tuple(r)[1:] for r in ingest.ingest_audit(df).collect()}
    assert got == {"a": (4, 2, 1, 1), "b": (1, 1, 0, 0)}


def test_values_that_captures_lack_are_added_and_repeat(spark):
    rows = [("Monday.csv", str(i), "1", "2", "DDoS") for i in range(200)]
    once = ingest.clean_flows(raw(spark, *rows))
    again = ingest.clean_flows(raw(spark, *reversed(rows)).repartition(5)).select(*once.columns)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))
    for r in once.collect():
        assert r.source_ip.startswith("203.0.113.") and r.destination_ip.startswith("10.0.0.")
        assert 0 <= r.hour < 24 and 1024 <= r.source_port < 65535 and 1 <= r.destination_port < 1024
        assert r.date == datetime.date(2017, 7, 3)
        assert r.protocol == (17 if r.destination_port in (53, 67, 68, 123) else 6)


def test_columns_that_captures_have_are_kept(spark):
    df = raw(spark, ("f.csv", "1", "1", "2", "Bot")).withColumns(
        {
            "source_ip": F.lit("9.9.9.9"),
            "destination_port": F.lit("53.0"),
            "protocol": F.lit("6"),
            "ts": F.lit("2017-07-07 08:15:00"),
            "extra": F.lit("kept"),
        }
    )
    row = ingest.clean_flows(df).first()
    assert (row.source_ip, row.destination_port, row.protocol, row.hour) == ("9.9.9.9", 53, 6, 8)
    assert row.extra == "kept" and row.ts == datetime.datetime(2017, 7, 7, 8, 15)


def test_header_names():
    headers = [" Flow Bytes/s", "Label ", "Odd  Name", "Odd Name"]
    assert unique_names(headers) == ["flow_bytes_s", "label", "odd_name", "odd_name_1"]


def test_files_of_one_folder_may_differ_in_their_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Label, Fwd Header Length, Fwd Header Length, Flow Bytes/s\nBot,1,2,9\n")
    (tmp_path / "b.csv").write_text(" Flow Bytes/s,Fwd Header Length,Fwd Header Length,Label\n7,3,4,DDoS\n")
    (tmp_path / "c d.csv").write_text("Label,Timestamp\nBENIGN,x\n")
    (tmp_path / "Combined_all.csv").write_text("Label,Timestamp\nBENIGN,y\n")
    (tmp_path / "empty.csv").write_text("")
    rows = {r.source_file: r for r in read_raw_flows(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a.csv", "b.csv", "c%20d.csv"} and len(read_captures(spark, [str(tmp_path)])) == 3
    assert (rows["a.csv"].label, rows["a.csv"].flow_bytes_s, rows["a.csv"].fwd_header_length_1) == ("Bot", "9", "2")
    assert (rows["b.csv"].label, rows["b.csv"].flow_bytes_s, rows["b.csv"].fwd_header_length) == ("DDoS", "7", "3")
    assert rows["c%20d.csv"].ts == "x" and rows["c%20d.csv"].flow_bytes_s is None


def test_distinct_rows_stay_distinct(spark):
    df = raw(spark, *[("a", text, "1", "2", "BENIGN") for text in ("1.2", "1.9", "junk", "trash", "1", "1.0", " 1e0", None)])
    cleaned = ingest.clean_flows(df)
    assert cleaned.count() == 6
    assert sorted(r.flow_duration for r in cleaned.collect() if r.flow_duration is not None) == [1]


def test_capture_columns_with_reserved_names_are_set_aside(spark):
    df = raw(spark, ("a", "1", "1", "2", "Bot")).withColumns({"severity": F.lit("x"), "flow_weight": F.lit("7")})
    row = ingest.clean_flows(df).first()
    assert (row.capture_severity, row.capture_flow_weight) == ("x", "7") and "severity" not in row.asDict()


HEAD = " Destination Port, Flow Duration,Flow Bytes/s, Flow Packets/s, Fwd Header Length, Label"


@pytest.fixture
def captures(tmp_path):
    days = tmp_path / "days"
    timed = tmp_path / "timed"
    days.mkdir()
    timed.mkdir()
    (days / "Monday-WorkingHours.csv").write_text(
        f"{HEAD}\n53,10,1.5,2,20,BENIGN\n53,10,1.5,2,20,BENIGN\n80,5,Infinity,NaN,20,BENIGN\n"
    )
    (days / "Thursday-Web.csv").write_text(f"{HEAD}\n80,7,20001,4,8,Web Attack � XSS\n", encoding="utf-8")
    (timed / "friday.csv").write_text(f"Timestamp,{HEAD}\n7/7/2017 9:05,22,3,8,9,1,SSH-Patator\n")
    return [str(days), str(timed)]


def test_raw_scan(spark, captures):
    df = read_raw_flows(spark, captures)
    assert set(df.columns) == {
        "destination_port", "flow_duration", "flow_bytes_s", "flow_packets_s",
        "fwd_header_length", "label", "source_file", "ts",
    }
    got = {(r.source_file, r.destination_port, r.ts) for r in df.collect()}
    assert got == {
        ("Monday-WorkingHours.csv", "53", None),
        ("Monday-WorkingHours.csv", "80", None),
        ("Thursday-Web.csv", "80", None),
        ("friday.csv", "22", "7/7/2017 9:05"),
    }
    assert df.count() == 5


def test_repeated_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Label, Size, Size,End\nx,1,2,3\n")
    row = read_raw_flows(spark, str(tmp_path)).first()
    assert (row.label, row["size"], row.size_1, row.end) == ("x", "1", "2", "3")


def test_header_that_only_looks_repeated(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Label,Size1,Size2\nx,1,2\n")
    assert read_raw_flows(spark, str(tmp_path)).columns[:3] == ["label", "size1", "size2"]


def test_ingest_to_table(spark, captures, tmp_path):
    table = str(tmp_path / "flows")
    run_ingest(spark, captures, table, types={"fwd_header_length": "int"})
    flows = flow_table.read_flows(spark, table)
    types = dict(flows.dtypes)
    assert {n: types[n] for n in NAME_TO_TYPE} == NAME_TO_TYPE
    assert flows.count() == 3
    got = {r.label: r for r in flows.collect()}
    want = {
        "BENIGN": ("2017-07-03", "Benign", 20, 53, 17),
        "Web Attack – XSS": ("2017-07-06", "Web Attack", 8, 80, 6),
        "SSH-Patator": ("2017-07-07", "Brute Force", 1, 22, 6),
    }
    for label, row in got.items():
        found = (str(row.date), row.attack_category, row.fwd_header_length)
        assert (*found, row.destination_port, row.protocol) == want[label]
        assert row.source_ip and 0 <= row.hour < 24
    # The hour is parsed where the capture has a timestamp and drawn where it has none.
    assert got["SSH-Patator"].hour == 9 and got["SSH-Patator"].ts is not None
    assert got["BENIGN"].ts is None


def test_table_as_csv(spark, flows, tmp_path):
    from flowmarts.schema import NAME_TO_HEADER

    path = str(tmp_path / "csv")
    table = flow_table.conform(flows.drop("source_file")).withColumn("Odd One", F.lit("x"))
    table.withColumnsRenamed(NAME_TO_HEADER).write.option("header", True).csv(path)
    read = flow_table.read_flows(spark, path, "csv")
    assert dict(read.dtypes) == {**NAME_TO_TYPE, "odd_one": "string"}
    # CSV text holds milliseconds.
    second = F.date_trunc("second", "ts")
    columns = ["flow_id", "source_ip", "destination_port", "flow_bytes_s", second, "date", "hour"]
    assert sorted(map(tuple, read.select(*columns).collect())) == sorted(
        map(tuple, table.select(*columns).collect())
    )


def test_filters_and_columns_reach_the_scan(spark, flows, tmp_path):
    path = str(tmp_path / "flows")
    flow_table.write_flows(flow_table.conform(flows.drop("source_file")), path)
    from flowmarts.operators import bruteforce

    table = flow_table.read_flows(spark, path)
    day = table.first().date
    plan = bruteforce.brute_ports_top(table.filter(F.col("date") == day))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(attack_category,Brute Force)" in text
    assert "PartitionFilters: [isnotnull(date" in text
    assert "ReadSchema: struct<destination_port:int,attack_category:string>" in text


# -- the load from files ---------------------------------------------------------


def written(folder, **files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


SHORT = "Flow Duration,Flow Bytes/s,Flow Packets/s,Label"


def test_load_reports_what_the_audit_counts(spark, tmp_path):
    rng = __import__("random").Random(3)
    files = {}
    for day in ("Monday", "tuesday", "other"):
        rows = [f"{rng.choice('123')},{rng.choice(['1', '1.0', 'NaN', 'x', '2', '-0.0', '0'])},{rng.choice(['1', 'inf', '3'])},{rng.choice(['BENIGN', ' BENIGN', 'Bot', 'DDoS'])}" for _ in range(400)]
        files[day] = "\n".join([SHORT, *rows, *["7,7,7,Bot"] * 500]) + "\n"
    folder = written(tmp_path / "in", **files)
    report = run_ingest(spark, folder, str(tmp_path / "out"))
    want = ingest.ingest_audit(read_raw_flows(spark, folder))
    assert sorted(map(tuple, report.audit.collect())) == sorted(map(tuple, want.select(*report.audit.columns).collect()))
    table = flow_table.read_flows(spark, str(tmp_path / "out"))
    assert table.count() == sum(r.saved_rows for r in report.audit.collect())
    counted = {r.attack_category: r["count"] for r in table.groupBy("attack_category").count().collect()}
    assert {r.attack_category: r.flows for r in report.categories.collect()} == counted
    plain = [ingest.clean_flows(c) for c in read_captures(spark, folder)]
    columns = ["flow_duration", "flow_bytes_s", "flow_packets_s", "label", "attack_category", "source_ip", "source_port", "destination_port", "hour", "date"]
    assert sorted(map(str, table.select(*columns).collect())) == sorted(str(r) for p in plain for r in p.select(*columns).collect())


def test_unlisted_columns_have_the_type_of_their_values(spark, tmp_path):
    head = f"{SHORT},Whole,Real,Mixed,Text,None,Big,Late"
    one = [head, "1,1,1,Bot,1,1,1,a,,1,1", "1,1,1,Bot,1.,1.5,NA,1,,2,2", "1,1,1,Bot,,nan,2,,NaN,99999999999999999999,3"]
    two = [head, "2,1,1,Bot,5,2,x,2.5,,3,4.5"]
    # The same row in other spellings of its numbers; text that looks like a number differs by spelling.
    one += ["9,9,9,Bot,1,2,z,1,,4,1", "9,9,9,Bot,1,2.0,z,1,,4.0,1.0", "9,9,9,Bot,1,2,z,1.0,,4,1"]
    one[2] = one[2].replace("1.,", "1,")
    folder = written(tmp_path / "in", Monday="\n".join(one) + "\n", Tuesday="\n".join(two) + "\n")
    run_ingest(spark, folder, str(tmp_path / "out"))
    table = flow_table.read_flows(spark, str(tmp_path / "out"))
    types = dict(table.dtypes)
    assert {n: types[n] for n in ("whole", "real", "mixed", "text", "none", "big", "late")} == {
        "whole": "bigint", "real": "double", "mixed": "string", "text": "string", "none": "double", "big": "double", "late": "double",
    }
    assert table.where("flow_duration = 9").count() == 2 and table.count() == 6
    assert sorted(r.late for r in table.collect()) == [1, 1, 1, 2, 3, 4.5]
    run_ingest(spark, folder, str(tmp_path / "asked"), types={"whole": "string", "late": "double"})
    assert dict(flow_table.read_flows(spark, str(tmp_path / "asked")).dtypes)["whole"] == "string"


def test_whole_rows_are_shuffled_once(spark, tmp_path, monkeypatch):
    from flowmarts.plans import capture_load

    rows = [f"{i % 50},{i % 7},1,Bot" for i in range(2_000)] + ["5,5,5,BENIGN"] * 3_000
    folder = written(tmp_path / "in", Monday="\n".join([SHORT, *rows]) + "\n", Tuesday="\n".join([SHORT, *rows]) + "\n")
    plans, shuffled = [], []

    def save(flows, path, fmt="parquet"):
        plans.append(flows._jdf.queryExecution().executedPlan().toString())
        flow_table.save_laid_out(flows, path, fmt)

    monkeypatch.setattr(capture_load, "save_laid_out", save)
    monkeypatch.setattr(capture_load, "HOT_KEYS", 4)
    found = capture_load._unrepeated

    def counted(keyed, hot, types):
        out = found(keyed, hot, types)
        shuffled.append(out.count())
        return out

    monkeypatch.setattr(capture_load, "_unrepeated", counted)
    capture_load.load_captures(spark, folder, str(tmp_path / "out"), rows_per_file=100)
    plan = plans[0]
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line or "ShufflePartitionId" in line]
    assert len([x for x in exchanges if "_slot" in x]) == 1 and len([x for x in exchanges if "hashpartitioning(_slot" not in x]) == 0, exchanges
    # The 3,000 copies, more than a quarter of all rows, meet the shuffle as one row of each file.
    assert shuffled and sum(shuffled) == 2 * 2_001
    table = flow_table.read_flows(spark, str(tmp_path / "out"))
    assert table.count() == 2 * 351
    files = [r[0] for r in table.select(F.col("_metadata.file_path")).distinct().collect()]
    assert 4 <= len(files) <= 8


def test_headers_come_from_the_first_bytes(spark, tmp_path):
    import gzip

    from flowmarts.sources.raw import file_headers

    long = ",".join(f"Column {i}" for i in range(9_000))
    folder = written(tmp_path / "in", a=f"{SHORT}\r\n1,1,1,Bot\r\n", b=f"\ufeff{long}\n1\n", empty="", combined_x="no\n")
    (tmp_path / "in" / "with %41 blank.csv").write_text("Label\nBot")
    (tmp_path / "in" / "z.csv.gz").write_bytes(gzip.compress(f"{SHORT}\n1,1,1,Bot\n".encode()))
    found = {path.rsplit("/", 1)[-1]: header for path, header in file_headers(spark, [folder], "*.csv*")}
    assert found == {"a.csv": tuple(SHORT.split(",")), "b.csv": tuple(long.split(",")), "with %41 blank.csv": ("Label",), "z.csv.gz": tuple(SHORT.split(","))}
    assert len(long) > 65_536


def test_nothing_to_load(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        run_ingest(spark, written(tmp_path / "in", empty=""), str(tmp_path / "out"))
    folder = written(tmp_path / "bad", Monday=f"{SHORT}\n1,x,1,Bot\n")
    report = run_ingest(spark, folder, str(tmp_path / "out"))
    assert [tuple(r) for r in report.audit.collect()] == [("Monday.csv", 1, 1, 0, 0)] and report.categories.collect() == []


def test_a_task_sorts_few_files(spark):
    """The files are dealt out, so that no task holds more than the rows of three of them."""
    raw = spark.range(6_000).selectExpr(
        "case when id % 3 = 0 then 'Monday-WorkingHours.csv' else 'Tuesday-WorkingHours.csv' end as source_file", "cast(id as string) as flow_id",
        "'80' as destination_port", "'1' as flow_bytes_s", "'2' as flow_packets_s", "'BENIGN' as label",
    )
    keyed = capture_load._keyed(ingest.repaired(raw).withColumn("_at", F.xxhash64("flow_id")), {})
    counts = capture_load._counts([keyed])
    table = capture_load.laid_out([keyed], counts, {}, rows_per_file=200)
    sizes = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 6_000 and len(sizes) >= 24 and max(sizes) < 750, sizes
    assert capture_load.ROWS_PER_FILE <= 250_000
