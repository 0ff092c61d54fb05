import math

import pytest
from pyspark.sql import functions as F

from flowmarts.functions import draws, labels, network, numbers
from flowmarts.functions.severity import severity_classifier, severity_of
from flowmarts.schema import SOURCE_RANGES, snake_case

LABELS = {
    "  BENIGN ": "BENIGN",
    " Bot ": "Bot",
    " DDoS\t\n": "DDoS",
    "Web Attack � XSS": "Web Attack – XSS",
    "Web Attack â€“ XSS": "Web Attack – XSS",
    "Web Attack — XSS": "Web Attack – XSS",
    "Web Attack–XSS": "Web Attack – XSS",
    "Web Attack - XSS": "Web Attack – XSS",
    "Web Attack €– XSS": "Web Attack – – XSS",
    None: None,
}


def test_label_repair(one_column):
    assert one_column(labels.normalise_label, LABELS) == list(LABELS.values())


@pytest.mark.parametrize(
    "label, category",
    [
        ("BENIGN", "Benign"),
        ("DoS slowloris", "DoS"),
        ("Web Attack – Sql Injection", "Web Attack"),
        ("SSH-Patator", "Brute Force"),
        ("benign", "Other"),
        ("DoS-Hulk", "Other"),
        ("Web Attack – – XSS", "Other"),
        (None, "Other"),
    ],
)
def test_category(one_column, label, category):
    assert one_column(labels.category_of, [label]) == [category]


def test_finite_double(one_column):
    texts = ["1.5", "1e3", "Infinity", "-Infinity", "NaN", "", "n/a", None]
    assert one_column(numbers.finite_double, texts) == [1.5, 1000.0] + [None] * 6
    values = [2.0, math.inf, -math.inf, math.nan, None]
    assert one_column(numbers.finite_double, values, "double") == [2.0] + [None] * 4


def test_lenient_long(one_column):
    texts = ["80", "80.0", " 7 ", "9007199254740993", "1.2", "x", "", None]
    want = [80, 80, 7, 9007199254740993, None, None, None, None]
    assert one_column(numbers.lenient_long, texts) == want


def test_percent_rounds_half_up_and_survives_zero(spark):
    df = spark.createDataFrame([(1, 800), (0, 5), (3, 0)], "a bigint, b bigint")
    assert [r[0] for r in df.select(numbers.percent(df.a, df.b, 2)).collect()] == [0.13, 0.0, None]


def test_formatting(one_column):
    assert one_column(numbers.thousands, [1234567, 12], "bigint") == ["1,234,567", "12"]
    assert one_column(numbers.title_words, ["failed_logins", "load"]) == ["Failed Logins", "Load"]


def test_file_dates(one_column):
    names = ["Monday-x.csv", "Friday-Morning.csv", "wednesday-y.csv", "a.csv", "friday-monday.csv"]
    got = [str(d) for d in one_column(network.date_of_file, names)]
    assert got == ["2017-07-03", "2017-07-07", "2017-07-05", "2017-07-07", "2017-07-03"]


def test_protocols(one_column):
    ports = [53, 67, 68, 123, 80, 0, None]
    assert one_column(network.infer_protocol, ports, "int") == [17] * 4 + [6] * 3
    numbers_ = [6, 17, 1, 0, 99, None]
    want = ["TCP", "UDP", "ICMP", "HOPOPT", "99", None]
    assert one_column(network.protocol_name, numbers_, "int") == want


def test_timestamps(spark, one_column):
    texts = {
        "2017-07-07 08:15:00": "2017-07-07 08:15:00",
        "2017-07-07T08:15:00.25": "2017-07-07 08:15:00.25",
        "7/6/2017 3:30": "2017-07-06 03:30:00",
        "7/6/2017 3:30:59": "2017-07-06 03:30:59",
        "7/6/2017 3:30 PM": "2017-07-06 15:30:00",
        "7/6/2017 12:05:00 am": "2017-07-06 00:05:00",
        "7/6/2017 12:05 PM": "2017-07-06 12:05:00",
        "3/12/2017 2:30": "2017-03-12 02:30:00",  # does not exist in New York
        "junk": None,
        "31/12/2017 3:30": None,
        "": None,
        None: None,
    }

    def parsed():
        return one_column(lambda c: network.parse_timestamp(c).cast("string"), texts)

    assert parsed() == list(texts.values())
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert parsed() == list(texts.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_draws_repeat_and_stay_in_range(spark):
    df = spark.range(3000).withColumn("digest", draws.row_digest([F.col("id")]))
    columns = [
        draws.draw(F.col("digest"), draws.SOURCE_PORT, 1024, 65535).alias("port"),
        draws.draw(F.col("digest"), draws.HOUR, 0, 24).alias("hour"),
    ]
    once = df.select("id", *columns).orderBy("id").collect()
    again = df.repartition(7).select("id", *columns).orderBy("id").collect()
    assert once == again
    assert all(1024 <= r.port < 65535 for r in once)
    assert {r.hour for r in once} == set(range(24))
    other = df.select(draws.row_digest([F.col("id")], seed=7).alias("d")).distinct().count()
    assert other == 3000


def test_source_addresses_follow_their_range(spark):
    names = [*SOURCE_RANGES, "Other"]
    place = (F.col("id") % len(names) + 1).cast("int")
    df = spark.range(5000).select(
        F.element_at(F.array(*[F.lit(n) for n in names]), place).alias("c"),
        draws.row_digest([F.col("id")]).alias("d"),
    )
    for row in df.select("c", draws.source_address(F.col("c"), F.col("d")).alias("ip")).collect():
        prefix, third, last = SOURCE_RANGES.get(row.c, SOURCE_RANGES["Benign"])
        assert row.ip.startswith(prefix)
        octets = [int(o) for o in row.ip.split(".")]
        assert len(octets) == 4 and last[0] <= octets[3] < last[1]
        if third:
            assert third[0] <= octets[2] < third[1]


def python_severity(category, rate, syn):
    if category in ("DDoS", "DoS"):
        return "Critical" if rate is not None and rate > 20000 else "High"
    if category == "Brute Force":
        return "High" if syn is not None and syn > 1 else "Medium"
    return "Medium" if category in ("Port Scan", "Bot") else "Low"


def test_severity_forms_agree(spark):
    categories = ["DoS", "DDoS", "Brute Force", "Port Scan", "Bot", "Web Attack", "Other", "Benign", None]
    rates = [None, math.nan, 0.0, 20000.0, 20001.0, math.inf]
    rows = [(c, r, s) for c in categories for r in rates for s in (None, 0, 1, 2)]
    df = spark.createDataFrame(rows, "c string, r double, s int")
    native = severity_of(F.col("c"), F.col("r"), F.col("s")).alias("native")
    vector = severity_classifier()(F.col("c"), F.col("r"), F.col("s")).alias("vector")
    for row in df.select("c", "r", "s", native, vector).collect():
        assert row.native == row.vector == python_severity(row.c, row.r, row.s), row


def test_names():
    assert snake_case(" Flow Bytes/s") == "flow_bytes_s"
    assert snake_case("Total Length of Fwd Packets") == "total_len_fwd"
    assert snake_case(" Bwd Avg Bulk Rate ") == "bwd_avg_bulk_rate"
