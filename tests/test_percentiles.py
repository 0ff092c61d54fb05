import itertools
import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from flowmarts.functions.numbers import double_of_order, order_of_double
from flowmarts.operators.percentiles import exact_percentiles, flow_percentiles_exact
from flowmarts.plans.sql import flow_percentiles, percentile_rank_errors

PROBABILITIES = (0.01, 0.5, 0.9, 0.99, 1.0)


def discrete(values, p):
    ordered = sorted(values, key=lambda v: (isinstance(v, float) and math.isnan(v), v))
    return ordered[max(1, math.ceil(Fraction(str(p)) * len(ordered))) - 1]


def series(name, n, rng):
    return {
        "uniform": lambda: [rng.uniform(0, 1e5) for _ in range(n)],
        "wide": lambda: [math.copysign(10 ** rng.uniform(-12, 300), rng.random() - 0.3) for _ in range(n)],
        "constant": lambda: [7.25] * n,
        "close": lambda: [1.0 + i * 2**-52 for i in range(n)],
        "tiny": lambda: [rng.random() * 1e-300 for _ in range(n)],
        "special": lambda: [rng.choice([math.inf, -math.inf, math.nan, 0.0, -1.5, 2.0]) for _ in range(n)],
        "single": lambda: [42.0],
    }[name]()


def test_exact_against_sorting(spark):
    rng = random.Random(5)
    names = ["uniform", "wide", "constant", "close", "tiny", "special", "single"]
    data = {name: series(name, 400, rng) for name in names}
    longs = {name: [rng.randrange(-(2**62), 2**62) for _ in v] for name, v in data.items()}
    longs["close"] = [2**61 + i for i in range(400)]
    rows = [(c, x, y) for c in names for x, y in zip(data[c], longs[c])]
    rows += [("uniform", None, None), (None, 3.0, 4)]
    df = spark.createDataFrame(rows, "attack_category string, x double, y bigint").repartition(6)
    found = exact_percentiles(df, {"x": PROBABILITIES, "y": PROBABILITIES}).collect()
    got = {(r.attack_category, r.metric, r.p): r.x if r.metric == "x" else r.y for r in found}
    assert len(got) == len(found) == (len(names) + 1) * 2 * len(PROBABILITIES)
    for name in names:
        for p in PROBABILITIES:
            for metric, values in (("x", data[name]), ("y", longs[name])):
                want, have = discrete(values, p), got[name, metric, p]
                assert have == want or (math.isnan(want) and math.isnan(have)), (name, metric, p)
    assert got[None, "x", 0.5] == 3.0 and got[None, "y", 0.99] == 4


def test_most_rows_in_one_value(spark):
    df = spark.range(20000).selectExpr(
        "'Benign' as attack_category", "if(id % 3 > 0, 5.0D, id / 7) as x"
    )
    values = [5.0 if i % 3 else i / 7 for i in range(20000)]
    found = exact_percentiles(df, {"x": PROBABILITIES}).collect()
    assert {r.p: r.x for r in found} == {p: discrete(values, p) for p in PROBABILITIES}


def test_report_forms_agree(flows):
    exact, close = flow_percentiles_exact(flows), flow_percentiles(flows)
    assert exact.dtypes == close.dtypes
    assert {r.attack_category for r in exact.collect()} == {r.attack_category for r in close.collect()}
    assert all(r.within for r in percentile_rank_errors(flows).collect())


def test_order_of_doubles(spark):
    rng = random.Random(6)
    edges = [0.0, 2.0**-1074, 2.0**-1023, 2.0**-1022, 2.0**-1022 - 2.0**-1074, 1.0, 3.0, 1e-11, 2.0**53, 1.7976931348623157e308, math.inf]
    edges += [math.nextafter(2.0**e, d) for e in range(-1070, 1024, 7) for d in (0.0, math.inf)] + [2.0**e for e in range(-1074, 1024)]
    edges += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3_000)]
    values = sorted({v for x in edges if not math.isnan(x) for v in (x, -x)})
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", order_of_double(F.col("x")).alias("k")).select("x", "k", double_of_order(F.col("k")).alias("back")).collect()
    assert all(r.back == r.x for r in rows)
    keys = {r.x: r.k for r in rows}
    assert all(keys[a] < keys[b] for a, b in itertools.pairwise(values))
    odd = spark.createDataFrame([(-0.0,), (math.nan,), (None,)], "x double").select(order_of_double(F.col("x")).alias("k")).collect()
    assert odd[0].k == 0 and odd[1].k > keys[math.inf] and odd[2].k is None


@pytest.mark.parametrize("kind", ["tiny", "near_2_62", "mixed"])
def test_many_different_values_in_a_narrow_range(spark, kind):
    """Values that share their leading digits still part by their bits: no step counts over more than 2^22 slices."""
    n = 200_000
    x, y = {
        "tiny": ("rand(3) * 1e-11", "id"),
        "near_2_62": ("1.0D + id * 2.220446049250313E-16D", "4611686018427387904 - id * 3"),
        "mixed": ("pow(10.0D, id % 600 - 300) * (id % 7 - 3)", "id * 46116860184273 - 4611686018427387904"),
    }[kind]
    df = spark.range(n).selectExpr("'Benign' as attack_category", f"{x} as x", f"{y} as y")
    rows = df.collect()
    found = exact_percentiles(df, {"x": PROBABILITIES, "y": PROBABILITIES}).collect()
    for metric in ("x", "y"):
        values = sorted(r[metric] for r in rows)
        want = {p: values[max(1, math.ceil(Fraction(str(p)) * n)) - 1] for p in PROBABILITIES}
        assert {r.p: r[metric] for r in found if r.metric == metric} == want


def test_other_types_are_refused(spark):
    df = spark.createDataFrame([("Benign", "1")], "attack_category string, x string")
    with pytest.raises(TypeError, match="x is string"):
        exact_percentiles(df, {"x": (0.5,)})


def test_single_flow(make_flows):
    df = make_flows({"flow_bytes_s": 12.345, "flow_duration": 9})
    want = ("Benign", 12.35, 12.35, 12.35, 9, 9)
    assert tuple(flow_percentiles_exact(df).first()) == want
    assert tuple(flow_percentiles(df).first()) == want


@pytest.mark.parametrize("form", [flow_percentiles_exact, flow_percentiles])
def test_no_flows(make_flows, form):
    assert form(make_flows({}).limit(0)).collect() == []


def test_report_of_many_values_has_no_rank_error(spark):
    """120,000 different values in 40 splits: a merged sketch of 10,000 entries is some ranks off."""
    df = spark.range(0, 120_000, 1, 40).selectExpr(
        "'Benign' as attack_category", "abs(xxhash64(id)) % 1000003 / 7 as flow_bytes_s", "abs(xxhash64(id, 1)) % 1000003 as flow_duration"
    )
    rates, durations = zip(*[(r.flow_bytes_s, r.flow_duration) for r in df.collect()])
    got = flow_percentiles(df).first()
    assert got[1:4] == tuple(pytest.approx(discrete(rates, p), abs=0.006) for p in (0.5, 0.9, 0.99))
    assert got[4:] == tuple(discrete(durations, p) for p in (0.5, 0.9))
    assert all(r.within for r in percentile_rank_errors(df, accuracy=120_000).collect())
