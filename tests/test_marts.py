import pytest
from pyspark.sql import functions as F

from flowmarts.operators import bruteforce, distribution, ip, ranking, severity, timings, traffic
from flowmarts.plans import rollups, sql


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def hostile(n, **row):
    return [{"attack_category": "DDoS", "label": "DDoS", **row}] * n


def benign(n, **row):
    return [row] * n


def test_distribution_edges(make_flows, spark):
    one = make_flows(*benign(3))
    assert rows(distribution.attack_distribution(one)) == [("Benign", 3, 100.0)]
    none = one.limit(0)
    assert rows(distribution.attack_distribution(none)) == []
    assert rows(distribution.total_flows(none)) == [(0,)]
    assert rows(distribution.malicious_split(none)) == [("Attack", 0), ("Benign", 0)]


def test_null_category(make_flows):
    df = make_flows(*hostile(2), *benign(1), {"attack_category": None})
    # Shown as hostile in the overview, but not matched by the attack filter.
    assert rows(distribution.malicious_split(df)) == [("Attack", 3), ("Benign", 1)]
    assert rows(traffic.top_ports(df)) == [(80, 4, 2, 50.0)]
    assert rows(ip.overview_kpis(df)) == [(4, 3, 1, 0, 2)]


def test_matrix_has_all_hours(make_flows):
    df = make_flows(*hostile(2, hour=3), *benign(1, hour=4))
    matrix = distribution.attack_hour_matrix(df)
    assert matrix.columns == ["attack_category"] + [f"h{h:02d}" for h in range(24)] + ["no_hour"]
    assert rows(matrix) == [("DDoS", 0, 0, 0, 2, *[0] * 21)]


def test_threat_levels(make_flows):
    data = []
    for address, n in {"none": 0, "one": 1, "nine": 9, "ten": 10}.items():
        data += hostile(n, source_ip=address) + benign(1, source_ip=address)
    df = make_flows(*data)
    levels = dict(rows(ip.ip_threat_profile(df), "source_ip", "threat_level"))
    assert levels == {"none": "LOW", "one": "MEDIUM", "nine": "MEDIUM", "ten": "HIGH"}
    types = dict(rows(ip.ip_threat_profile(df), "source_ip", "attack_types"))
    assert types["none"] is None and types["ten"] == ["DDoS"]
    assert dict(rows(ip.threat_summary(df))) == {"LOW": 1, "MEDIUM": 2, "HIGH": 1}
    assert rows(ip.threat_kpis(df)) == [(1, 2, 1, 4, 25.0)]
    assert rows(ip.high_threat_ip_count(df)) == [(1,)]
    assert rows(ip.threat_kpis(df.limit(0))) == [(0, 0, 0, 0, 0.0)]


def test_both_profile_forms_agree_with_unknown_addresses(make_flows):
    df = make_flows(
        *hostile(12, source_ip=None),
        *hostile(3, source_ip="x"),
        *benign(2, source_ip="x"),
        {"source_ip": "x", "attack_category": None},
        {"source_ip": "x", "attack_category": "Bot"},
    )
    one = ip.ip_threat_profile(df)
    two = ip.ip_threat_profile_joined(df).select(*one.columns)
    assert sorted(rows(one), key=str) == sorted(rows(two), key=str)
    got = {r.source_ip: r for r in one.collect()}
    assert got[None].threat_level == "LOW" and got[None].total_flows == 12
    assert got["x"].attack_types == ["Bot", "DDoS"] and got["x"].attack_flows == 4


def test_classes(make_flows):
    cases = {"clean": (0, 5), "bad": (12, 0), "bad_too": (12, 3), "mixed": (4, 3), "unclear": (4, 0)}
    data = []
    for address, (attacks, normal) in cases.items():
        data += hostile(attacks, source_ip=address) + benign(normal, source_ip=address)
    got = dict(rows(ip.ip_class(make_flows(*data)), "source_ip", "ip_class"))
    assert got == {
        "clean": "clean", "bad": "malicious", "bad_too": "malicious", "mixed": "mixed", "unclear": None,
    }


def test_ties_at_the_end_of_a_top_list_keep_the_smaller_key(make_flows):
    df = make_flows(*[{"destination_port": p} for p in range(20, 0, -1)])
    assert [r[0] for r in rows(traffic.top_ports(df))] == list(range(1, 16))
    assert rows(traffic.top_ports(df, k=1)) == [(1, 1, 0, 0.0)]


def test_correlation_ratio_is_rounded_first_and_ties_fan_out(make_flows):
    data = hostile(1251, source_ip="a") + benign(1249, source_ip="a")  # 50.04 -> 50.0
    data += hostile(1252, source_ip="b") + benign(1248, source_ip="b", destination_port=81)
    data += hostile(2, source_ip="c", destination_port=7) + hostile(2, source_ip="c", destination_port=5)
    got = rows(ip.ip_port_correlation(make_flows(*data)))
    assert got == [
        ("b", 2500, 1252, 2, 50.1, 80, 1252),
        ("c", 4, 4, 2, 100.0, 5, 2),
        ("c", 4, 4, 2, 100.0, 7, 2),
    ]


def test_correlation_forms_agree_with_unknown_addresses(make_flows):
    data = hostile(3, source_ip="a") + hostile(2, source_ip="a", destination_port=5)
    data += hostile(2, source_ip=None) + hostile(2, source_ip=None, destination_port=9)
    data += hostile(1, source_ip="b", destination_port=None) + hostile(1, source_ip="b")
    df = make_flows(*data)
    one, two = ip.ip_port_correlation(df), ip.ip_port_correlation_joined(df)
    assert one.dtypes == two.dtypes
    assert sorted(rows(one), key=str) == sorted(rows(two), key=str)
    assert (None, 4, 4, 2, 100.0, None, None) in rows(one)


def test_correlation_scans_once(flows):
    plan = ip.ip_port_correlation(flows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_ranks_keep_ties(make_flows):
    data = []
    for address, n in {"a": 5, "b": 5, "c": 3}.items():
        data += hostile(n, source_ip=address)
    got = rows(ranking.top_ips_per_attack(make_flows(*data)))
    assert got == [
        ("a", "DDoS", 5, 1, 1, 38.46),
        ("b", "DDoS", 5, 1, 1, 38.46),
        ("c", "DDoS", 3, 3, 2, 23.08),
    ]
    data = []
    for i, n in enumerate([9, 8, 7, 6, *[5] * 6, 4]):
        data += hostile(n, source_ip=f"ip{i:02d}")
    got = rows(ranking.top_ips_per_attack(make_flows(*data)), "source_ip", "rank", "dense_rank")
    assert len(got) == 10 and got[-1] == ("ip09", 5, 5)
    share = rows(ranking.top_ips_per_attack(make_flows(*data)), "pct_of_category")[0][0]
    assert share == round(9 / 64 * 100, 2)


def test_ranks_equal_a_plain_window(spark, flows):
    from pyspark.sql import Window

    spread = flows.withColumn("source_ip", (F.xxhash64("flow_id") % 97).cast("string"))
    per_ip = ip.ip_category_counts(spread)
    order = Window.partitionBy("attack_category").orderBy(F.col("flow_weight").desc())
    plain = per_ip.select(
        "attack_category", F.col("flow_weight").alias("flow_count"),
        F.rank().over(order).alias("rank"), F.dense_rank().over(order).alias("dense_rank"),
    ).distinct()
    levels = ranking.rank_levels(per_ip).select(*plain.columns)
    assert sorted(rows(plain)) == sorted(rows(levels))


def test_delta_crosses_gaps(make_flows):
    df = make_flows(*hostile(4, hour=1), *hostile(6, hour=3))
    assert rows(ranking.hourly_attack_delta(df)) == [
        (1, "DDoS", 4, None, 0, 0.0),
        (3, "DDoS", 6, 4, 2, 50.0),
    ]
    dense = rows(ranking.hourly_attack_delta_dense(df))
    assert len(dense) == 24
    assert dense[2] == (2, "DDoS", 0, 4, -4, -100.0) and dense[3] == (3, "DDoS", 6, 0, 6, 0.0)
    assert rows(ranking.attack_running_total(df))[-1] == (3, "DDoS", 6, 10)


def test_top_port_text(make_flows):
    guess = {"attack_category": "Brute Force"}
    df = make_flows(*[{**guess, "destination_port": p} for p in (22, 21, 22, 21)])
    assert rows(bruteforce.top_targeted_port(df)) == [("21",)]
    assert rows(bruteforce.top_targeted_port(make_flows(*benign(1)))) == [("N/A",)]


def test_login_ports(make_flows):
    guess = {"attack_category": "Brute Force"}
    df = make_flows(*[{**guess, "destination_port": p} for p in (21, 22, 23, 3389, 80)], *benign(1))
    assert bruteforce.brute_flows(df).count() == 5
    assert bruteforce.brute_flows(df, login_ports_only=True).count() == 4


def test_timings(spark):
    tasks = spark.createDataFrame([("load",), ("failed_logins",), ("zero",)], "task string")
    before = spark.createDataFrame([("load", 29.201), ("zero", 1.0)], "task string, seconds double")
    after = spark.createDataFrame(
        [("load", 7.56), ("failed_logins", 0.2), ("zero", 0.0)], "task string, seconds double"
    )
    both = timings.compare_timings(tasks, before, after)
    assert sorted(rows(both)) == [
        ("Failed Logins", 0.0, 0.2, 0.0, "Baseline"),
        ("Load", 29.201, 7.56, 3.86, "Candidate"),
        ("Zero", 1.0, 0.0, 0.0, "Candidate"),
    ]
    total = timings.overall_speedup(both).first()
    assert total.overall_speedup == round(30.201 / 7.76, 2)


def test_approximate_distinct_counts(flows):
    exact = ip.ip_category_stats(flows).agg(F.sum("unique_ports")).first()[0]
    close = ip.ip_category_stats(flows, approx=True).agg(F.sum("unique_ports")).first()[0]
    assert abs(exact - close) <= 0.05 * exact


# What the stored results of the workload satisfy holds on any input.
def test_invariants(flows):
    def total(df, column):
        return df.agg(F.sum(column)).first()[0]

    n = flows.count()
    assert total(traffic.hourly_traffic(flows), "flows") == n
    assert total(traffic.protocol_distribution(flows), "flow_count") == n
    assert total(traffic.port_activity(flows), "total_flows") == n
    brute = bruteforce.brute_total(flows).first()[0]
    assert total(bruteforce.brute_hourly(flows), "brute_flows") == brute
    assert total(bruteforce.brute_ips_top(flows, k=10**6), "attack_flows") == brute
    levels = total(ip.threat_summary(flows), "count")
    assert levels == flows.select("source_ip").distinct().count()
    by_hour = traffic.hourly_traffic(flows).groupBy("attack_category").agg(F.sum("flows").alias("n"))
    by_category = distribution.attack_distribution(flows).select("attack_category", "count")
    assert sorted(rows(by_hour)) == sorted(rows(by_category))
    assert {r[0] for r in rows(ip.top_suspicious_ips(flows), "threat_level")} <= {"HIGH"}
    last = ranking.attack_running_total(flows).groupBy("attack_category").agg(
        F.max("running_total"), F.sum("flows")
    )
    assert all(a == b for _, a, b in rows(last))
    graded = severity.severity_distribution(flows).groupBy("severity").agg(F.sum("count"))
    assert sorted(rows(graded)) == sorted(rows(severity.severity_totals(flows)))


@pytest.fixture(scope="module")
def tables(flows):
    return {name: build(flows) for name, build in rollups.BUILDERS.items()}


ON_ROLLUPS = [
    (distribution.total_flows, "traffic_cube"),
    (distribution.attack_distribution, "traffic_cube"),
    (distribution.label_distribution, "traffic_cube"),
    (distribution.attack_hour_matrix, "traffic_cube"),
    (distribution.malicious_split, "traffic_cube"),
    (traffic.protocol_names, "traffic_cube"),
    (traffic.hourly_traffic, "traffic_cube"),
    (traffic.dos_ddos_counts, "traffic_cube"),
    (traffic.flow_profile, "traffic_cube"),
    (traffic.top_ports, "category_port"),
    (traffic.top_ports, "ip_port"),
    (bruteforce.brute_total, "traffic_cube"),
    (bruteforce.brute_hourly, "traffic_cube"),
    (bruteforce.high_syn, "traffic_cube"),
    (bruteforce.brute_ports_top, "category_port"),
    (bruteforce.top_targeted_port, "category_port"),
    (bruteforce.brute_ips_top, "ip_category"),
    (ip.ip_totals, "ip_category"),
    (ip.ip_attacks, "ip_category"),
    (ip.ip_threat_profile, "ip_category"),
    (ip.top_suspicious_ips, "ip_category"),
    (ip.threat_summary, "ip_category"),
    (ip.threat_kpis, "ip_category"),
    (ip.high_threat_ip_count, "ip_category"),
    (ip.overview_kpis, "ip_category"),
    (ip.ip_class, "ip_category"),
    (ip.ip_profile, "ip_port"),
    (ip.top_port_per_ip, "ip_port"),
    (ip.ip_port_correlation, "ip_port"),
    (ip.ip_port_correlation_joined, "ip_port"),
    (ranking.top_ips_per_attack, "ip_category"),
    (ranking.hourly_attack_delta, "traffic_cube"),
    (ranking.attack_running_total, "traffic_cube"),
    (severity.severity_distribution, "traffic_cube"),
    (severity.severity_totals, "traffic_cube"),
]


@pytest.mark.parametrize("operator, table", ON_ROLLUPS, ids=lambda v: getattr(v, "__name__", v))
def test_rollup_gives_the_same_result(flows, tables, operator, table):
    direct, rolled = operator(flows), operator(tables[table])
    assert direct.dtypes == rolled.dtypes
    assert sorted(rows(direct), key=str) == sorted(rows(rolled), key=str)


def test_attack_profile_forms_agree(flows, tables):
    text = sql.sql_attack_profile(flows)
    rolled = rollups.attack_profile(tables["traffic_cube"], tables["ip_category"], tables["category_port"])
    assert rows(text) == rows(rolled.select(*text.columns))
