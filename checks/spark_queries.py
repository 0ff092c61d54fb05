"""One query per operator: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmarts.functions import numbers
from flowmarts.operators import bruteforce, counting, distribution, ingest, ip, percentiles
from flowmarts.operators import ranking, severity, sketches, timings, traffic
from flowmarts.plans import jobs, rollups, sql
from flowmarts.plans.rollup_store import RollupStore
from flowmarts.schema import MART_SCHEMAS, NAME_TO_HEADER
from flowmarts.session import shared_dir
from checks import events as source
from flowmarts.sources import flow_table, sinks
from flowmarts.sources.raw import union_captures

Query = Callable[[SparkSession, str], DataFrame]

_FLOW_COLUMNS = [
    "flow_id",
    "source_ip",
    "destination_ip",
    "source_port",
    "destination_port",
    "protocol",
    "ts",
    "flow_duration",
    "flow_bytes_s",
    "flow_packets_s",
    "syn_flag_count",
    "label",
    "attack_category",
    "hour",
    "date",
]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty rows with repeats."""
    return source.raw_flows(_events(spark, sf_dir), duplicates=True)


def _on_flows(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(source.flows(spark, sf_dir))


def _on_raw(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_raw(spark, sf_dir))


def _texted(profile: DataFrame) -> DataFrame:
    """Attack types as text, so that result rows compare as plain values."""
    return profile.withColumn("attack_types", F.array_join("attack_types", ","))


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# -- ingest ---------------------------------------------------------------------


def _repaired_rates(raw: DataFrame) -> DataFrame:
    coerced = ingest.coerce_rates(raw)
    return coerced.select("flow_id", "flow_bytes_s", "flow_packets_s")


def _kept(raw: DataFrame) -> DataFrame:
    kept = ingest.drop_bad_rates(ingest.coerce_rates(raw))
    return kept.select("source_file", "flow_id", "flow_bytes_s", "flow_packets_s")


def _deduplicated(raw: DataFrame) -> DataFrame:
    cleaned = ingest.drop_bad_rates(ingest.coerce_rates(ingest.clean_labels(raw)))
    kept = ingest.drop_repeats(cleaned)
    return kept.select("source_file", "flow_id", "label", "attack_category", "flow_bytes_s")


def _addresses(raw: DataFrame) -> DataFrame:
    bare = ingest.clean_labels(raw).drop("source_ip", "destination_ip")
    assigned = ingest.assign_ips(bare, keys=["flow_id"])
    return assigned.select("flow_id", "attack_category", "source_ip", "destination_ip")


def _ports(raw: DataFrame) -> DataFrame:
    assigned = ingest.assign_ports(raw.drop("destination_port"), keys=["flow_id"])
    return assigned.select("flow_id", "source_port", "destination_port")


def _hours(raw: DataFrame) -> DataFrame:
    """Parsed from text, every eleventh text damaged, and drawn where there is none."""
    text = F.when(F.col("flow_id").cast("bigint") % 11 == 0, "junk").otherwise(F.col("ts").cast("string"))
    parsed = ingest.add_hour(raw.withColumn("ts", text)).withColumnRenamed("hour", "parsed_hour")
    drawn = ingest.add_hour(parsed.drop("ts"), keys=["flow_id"])
    return drawn.select("flow_id", "parsed_hour", F.col("hour").alias("drawn_hour"))


def _cleaned(raw: DataFrame) -> DataFrame:
    """The whole cleaning on captures without addresses, ports or protocol."""
    bare = raw.drop("source_ip", "destination_ip", "source_port")
    cleaned = ingest.clean_flows(bare, keys=["source_file", "flow_id"])
    return cleaned.select("source_file", *_FLOW_COLUMNS)


def _union_days(raw: DataFrame) -> DataFrame:
    """Three captures, of which one lacks the timestamp and one the SYN count."""
    columns = ["source_file", "flow_id", "ts", "syn_flag_count"]
    narrow = raw.select(*columns)
    name = F.col("source_file")
    return union_captures(
        narrow.filter(name == "capture.csv").drop("ts"),
        narrow.filter(name == "Monday-WorkingHours.csv").drop("syn_flag_count"),
        narrow.filter(~name.isin("capture.csv", "Monday-WorkingHours.csv")),
    ).select(*columns)


def _written_flows(fmt: str) -> Query:
    """The table through disk: every row written, then read back with its types."""

    def written(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _fresh(spark, "flows")
        table = flow_table.conform(source.flows(spark, sf_dir).drop("source_file"))
        flow_table.write_flows(table, path, fmt)
        return flow_table.read_flows(spark, path, fmt).select(*_FLOW_COLUMNS)

    return written


# -- sketches and rollups per date ----------------------------------------------


def _store(spark: SparkSession, sf_dir: str) -> RollupStore:
    """A rollup store filled in two runs, of which the second finds the dates of the first among its flows."""
    store = RollupStore(spark, _fresh(spark, "store"))
    flows = source.flows(spark, sf_dir)
    store.add(flows.filter(F.dayofmonth("date") % 2 == 0))
    store.add(flows)
    return store


def _stored(name: str, columns: list[str]) -> Query:
    return lambda spark, sf_dir: _store(spark, sf_dir).read(name).select(*columns)


def _stored_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the distinct counts over all dates, merged from sketches per date, are within five standard errors."""
    found = _store(spark, sf_dir).distinct().withColumnRenamed("attack_category", "_category")
    exact = source.flows(spark, sf_dir).groupBy("attack_category").agg(*[F.count_distinct(c).alias(c) for c in sketches.DISTINCT])
    error = 5 * 1.04 / 2 ** (sketches.HLL_BITS / 2)
    near = [(F.abs(F.col(f"unique_{c}") - F.col(c)) <= F.greatest(error * F.col(c), F.lit(0.5))).alias(c) for c in sketches.DISTINCT]
    return exact.join(found, F.col("attack_category").eqNullSafe(F.col("_category"))).select("attack_category", *near)


def _stored_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the percentiles over all dates, merged from sketches per date, are within their rank error."""
    flows = source.flows(spark, sf_dir)
    return sketches.within_rank_error(flows, _store(spark, sf_dir).percentiles(), sketches.kll_rank_error())


# -- marts on disk ----------------------------------------------------------------


def _cells(frame: DataFrame, job: str, mart: str) -> DataFrame:
    """A mart as one row per measure of each of its rows: text and int columns are the key, bigint and double measures.

    Each row also has the measure ``row``, so that marts without measures count.
    """
    plain = _texted(frame) if "attack_types" in frame.columns else frame
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c, t in plain.dtypes if t in ("string", "int")]
    measures = [(c, F.col(c).cast("double")) for c, t in plain.dtypes if t in ("bigint", "double")] + [("row", F.lit(1.0))]
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("measure"), v.alias("value")) for c, v in measures))).alias("pair")
    cells = plain.select(F.concat_ws("|", F.lit(""), *keys).alias("key"), pairs)
    return cells.select(F.lit(job).alias("job"), F.lit(mart).alias("mart"), "key", "pair.measure", "pair.value")


def _traffic_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The marts of the traffic job, from the flows instead of rollups."""
    flows = source.flows(spark, sf_dir)
    return {
        "protocol_distribution": traffic.protocol_names(flows),
        "top_ports": traffic.top_ports(flows),
        "dos_ddos": traffic.dos_ddos_counts(flows),
        "flow_bytes_by_attack": traffic.flow_profile(flows),
        "hourly_traffic": traffic.hourly_traffic(flows),
    }


def _written_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The traffic job's marts as JSON, all of them read back with their schema, row by row."""
    out = _fresh(spark, "marts")
    marts = _traffic_marts(spark, sf_dir)
    sinks.write_marts(out, "traffic_analysis", marts)
    read = [_cells(sinks.read_mart(spark, out, "traffic_analysis", m), "traffic_analysis", m) for m in marts]
    return union_captures(*read).drop("job")


def _read_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart with an array column through JSON, and one that was never written."""
    out = _fresh(spark, "marts")
    top = ip.top_suspicious_ips(source.flows(spark, sf_dir))
    sinks.write_marts(out, "suspicious_ip", {"top_suspicious_ips": top})
    written = sinks.read_mart(spark, out, "suspicious_ip", "top_suspicious_ips")
    absent = sinks.read_mart(spark, out, "suspicious_ip", "threat_summary")
    return _texted(written).join(absent, "threat_level", "left").select(
        "source_ip", "total_flows", "attack_flows", "attack_types", "threat_level",
        "attack_rate_pct", "count",
    )


def _document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The traffic job's report through its JSON document: all marts, row by row, with the place in ranked ones."""
    out = _fresh(spark, "marts")
    marts = _traffic_marts(spark, sf_dir)
    sinks.write_document(out, "traffic_analysis", marts)
    read = []
    for mart in marts:
        stored = sinks.document_mart(spark, out, "traffic_analysis", mart)
        ranked = mart == "top_ports"
        # The report's 15 ports at most are one window.
        place = F.row_number().over(Window.orderBy("place")) if ranked else F.lit(None)
        read.append(_cells(stored.withColumn("place", place.cast("bigint")), "traffic_analysis", mart))
    cells = union_captures(*read).drop("job")
    return cells.where("measure <> 'place' or value is not null")


def _job_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every mart of all jobs, written by the runner and read back row by row, with the status of its job."""
    out = _fresh(spark, "marts")
    ran = jobs.run_marts(spark, source.flows(spark, sf_dir), out).select("job", "status")
    read = [
        _cells(sinks.read_mart(spark, out, job, mart), job, mart) for job in jobs.JOBS for mart in MART_SCHEMAS[job]
    ]
    return ran.join(union_captures(*read), "job", "left")


def _captures(spark: SparkSession, sf_dir: str) -> str:
    """Dirty captures as CSV files in one folder.

    Three headers: names padded with blanks and one repeated, another column order, and one without the
    timestamp. A merged file of an earlier run lies beside them.
    """
    folder = _fresh(spark, "captures")
    raw = _raw(spark, sf_dir).withColumn("ts", F.col("ts").cast("string"))
    columns = ["flow_id", "destination_port", "protocol", "ts", "flow_duration", "flow_bytes_s", "flow_packets_s", "syn_flag_count", "label"]
    have = [c for c in columns if c in raw.columns]
    for name in source.FILES:
        order = {"TUESDAY-WorkingHours.csv": have[::-1], "capture.csv": [c for c in have if c != "ts"]}.get(name, have)
        headers = [NAME_TO_HEADER[c] for c in order]
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]
        if name == "Monday-WorkingHours.csv":
            headers = [f" {h} " for h in headers] + ["Fwd Header Length", "Fwd Header Length"]
            cells += [F.lit("20"), F.lit("21.5")]
        rows = raw.where(F.col("source_file") == name).select(F.concat_ws(",", *cells).alias("line"))
        _csv_file(spark, ",".join(headers), rows, f"{folder}/all/{name}")
    _csv_file(spark, ",".join(headers), rows, f"{folder}/all/combined_2017.csv")
    return f"{folder}/all"


def _raw_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty captures through ``run_ingest``, and the table read back."""
    table = _fresh(spark, "table")
    jobs.run_ingest(spark, _captures(spark, sf_dir), table)
    return flow_table.read_flows(spark, table).select(
        "flow_id", "destination_port", "flow_duration", "flow_bytes_s", "flow_packets_s", "syn_flag_count", "label", "attack_category", "date",
        F.when(F.col("ts").isNotNull(), F.col("hour")).alias("parsed_hour"),
    )


def _ingest_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns beyond the listed ones, with the types that their values have given them."""
    table = _fresh(spark, "table")
    jobs.run_ingest(spark, _captures(spark, sf_dir), table)
    kinds = [F.typeof(c).alias(f"{c}_type") for c in ("fwd_header_length", "fwd_header_length_1")]
    return flow_table.read_flows(spark, table).select("flow_id", "fwd_header_length", "fwd_header_length_1", *kinds)


def _ingest_reported(part: str) -> Query:
    """What ``run_ingest`` returns beside the table."""

    def reported(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(jobs.run_ingest(spark, _captures(spark, sf_dir), _fresh(spark, "table")), part)

    return reported


def _csv_file(spark: SparkSession, header: str, lines: DataFrame, to: str) -> None:
    """A header and its lines as one file of that name, as a capture tool would leave it."""
    made = f"{to}.parts"
    head = spark.range(1).select(F.lit(header).alias("line"))
    head.union(lines).coalesce(1).write.text(made)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(made).getFileSystem(hadoop)
    part = next(s.getPath() for s in system.listStatus(path(made)) if s.getPath().getName().startswith("part-"))
    if not system.rename(part, path(to)):
        raise OSError(f"{part} can't be called {to}")
    system.delete(path(made), True)


# -- marts ------------------------------------------------------------------------


def _view_with_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow_table.register_flow_view(
        source.flows(spark, sf_dir), "captured_flows", capture_headers=True
    )
    return spark.sql(
        "select `Destination Port` as destination_port, max(`Flow Bytes/s`) as max_bytes,"
        " sum(`SYN Flag Count`) as syn_flags from captured_flows"
        " where Attack_Category <> 'Benign' group by `Destination Port`"
    )


def _attack_profile(flows: DataFrame) -> DataFrame:
    return rollups.attack_profile(
        rollups.traffic_cube(flows),
        ip.ip_category_counts(flows),
        rollups.category_port_counts(flows),
    )


def _severity_rows(user_function: bool) -> Query:
    def rows(flows: DataFrame) -> DataFrame:
        graded = severity.with_severity(flows, user_function)
        return graded.select("flow_id", "attack_category", "severity")

    return _on_flows(rows)


def _scan(flows: DataFrame) -> DataFrame:
    return flows.select(*_FLOW_COLUMNS)


def _ids(flows: DataFrame) -> DataFrame:
    return flows.select("flow_id", "attack_category", "source_ip", "destination_port")


def _protocol_rows(flows: DataFrame) -> DataFrame:
    inferred = ingest.add_protocol(flows.drop("protocol"))
    return inferred.select("flow_id", "destination_port", "protocol")


def _formatted(flows: DataFrame) -> DataFrame:
    counts = traffic.port_activity(flows)
    return counts.select(
        "destination_port",
        numbers.thousands(F.col("total_flows") * 1000).alias("total_flows"),
        numbers.title_words(F.concat(F.lit("port_"), F.col("destination_port"))).alias("title"),
    )


def _comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timings taken from the events: a task per event type, the baseline's seconds
    from even users and the candidate's from odd ones; signups have no baseline and
    views no candidate."""
    events = _events(spark, sf_dir)
    task = F.concat(F.lit("task_"), F.col("event_type"), F.lit("_rows")).alias("task")
    seconds = F.round(F.sum("value"), 3).alias("seconds")
    even = (F.col("user_id") % 2 == 0) & (F.col("event_type") != "signup")
    odd = (F.col("user_id") % 2 == 1) & (F.col("event_type") != "view")
    return timings.compare_timings(
        events.select(task).distinct(),
        events.filter(even).groupBy(task).agg(seconds),
        events.filter(odd).groupBy(task).agg(seconds),
    )


def _overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = timings.overall_speedup(_comparison(spark, sf_dir))
    return totals.select(
        F.round("baseline_total_s", 3).alias("baseline_total_s"),
        F.round("candidate_total_s", 3).alias("candidate_total_s"),
        "overall_speedup",
    )


QUERIES: dict[str, Query] = {
    # scans, sources, sinks
    "scan_flows": _on_flows(_scan),
    "ingest_clean": _on_raw(_cleaned),
    "date_from_file": _on_raw(
        lambda raw: ingest.add_date(raw).groupBy("source_file", "date").agg(F.count("*").alias("n"))
    ),
    "union_days": _on_raw(_union_days),
    "write_flows": _written_flows("parquet"),
    "scan_flows_csv": _written_flows("csv"),
    "write_marts": _written_marts,
    "read_marts": _read_marts,
    "mart_document": _document,
    "view_with_headers": _view_with_headers,
    # row-level cleaning
    "label_normalise": _on_raw(lambda raw: ingest.clean_labels(raw).select("flow_id", "label")),
    "label_category": _on_raw(
        lambda raw: ingest.clean_labels(raw).select("flow_id", "attack_category")
    ),
    "rate_coerce": _on_raw(_repaired_rates),
    "drop_bad_rates": _on_raw(_kept),
    "dedup_flows": _on_raw(_deduplicated),
    "assign_ips": _on_raw(_addresses),
    "assign_ports": _on_raw(_ports),
    "hour_of_flow": _on_raw(_hours),
    "protocol_infer": _on_flows(_protocol_rows),
    "ingest_audit": _on_raw(ingest.ingest_audit),
    # filters
    "filter_category": _on_flows(lambda f: _ids(counting.of_category(f, "DDoS"))),
    "filter_attacks": _on_flows(lambda f: _ids(counting.attacks_only(f))),
    "high_syn": _on_flows(bruteforce.high_syn),
    "high_syn_flows": _on_flows(lambda f: _ids(bruteforce.high_syn_flows(f))),
    "brute_ports": _on_flows(lambda f: _ids(bruteforce.brute_flows(f, login_ports_only=True))),
    # distribution
    "total_flows": _on_flows(distribution.total_flows),
    "attack_distribution": _on_flows(distribution.attack_distribution),
    "attack_distribution_asc": _on_flows(
        lambda f: distribution.attack_distribution(f, ascending=True)
    ),
    "label_distribution": _on_flows(distribution.label_distribution),
    "malicious_split": _on_flows(distribution.malicious_split),
    "distinct_categories": _on_flows(distribution.distinct_categories),
    "attack_hour_pivot": _on_flows(distribution.attack_hour_matrix),
    # addresses
    "ip_category_stats": _on_flows(ip.ip_category_stats),
    "ip_totals": _on_flows(ip.ip_totals),
    "ip_attacks": _on_flows(lambda f: _texted(ip.ip_attacks(f))),
    "ip_threat_profile": _on_flows(lambda f: _texted(ip.ip_threat_profile(f))),
    "ip_threat_profile_joined": _on_flows(lambda f: _texted(ip.ip_threat_profile_joined(f))),
    "top_suspicious_ips": _on_flows(lambda f: _texted(ip.top_suspicious_ips(f))),
    "top_suspicious_15": _on_flows(lambda f: _texted(ip.top_suspicious_ips(f, k=15))),
    "top_suspicious_30": _on_flows(lambda f: _texted(ip.top_suspicious_ips(f, k=30))),
    "ip_class": _on_flows(ip.ip_class),
    "threat_summary": _on_flows(ip.threat_summary),
    "threat_kpis": _on_flows(ip.threat_kpis),
    "high_threat_ip_count": _on_flows(ip.high_threat_ip_count),
    "overview_kpis": _on_flows(ip.overview_kpis),
    "ip_profile": _on_flows(ip.ip_profile),
    "top_port_per_ip": _on_flows(ip.top_port_per_ip),
    "ip_port_correlation": _on_flows(ip.ip_port_correlation),
    "ip_port_correlation_20": _on_flows(lambda f: ip.ip_port_correlation(f, k=20)),
    "ip_port_correlation_joined": _on_flows(ip.ip_port_correlation_joined),
    # password guessing
    "brute_total": _on_flows(bruteforce.brute_total),
    "brute_ports_top": _on_flows(bruteforce.brute_ports_top),
    "brute_ips_top": _on_flows(bruteforce.brute_ips_top),
    "brute_hourly": _on_flows(bruteforce.brute_hourly),
    "top_targeted_port": _on_flows(bruteforce.top_targeted_port),
    # traffic
    "protocol_distribution": _on_flows(traffic.protocol_distribution),
    "protocol_names": _on_flows(traffic.protocol_names),
    "top_ports": _on_flows(traffic.top_ports),
    "hourly_traffic": _on_flows(traffic.hourly_traffic),
    "dos_ddos_counts": _on_flows(traffic.dos_ddos_counts),
    "flow_profile": _on_flows(traffic.flow_profile),
    "format_counts": _on_flows(_formatted),
    # ranking and hourly change
    "top_ips_per_attack": _on_flows(ranking.top_ips_per_attack),
    "top_ips_of_category": _on_flows(
        lambda f: counting.of_category(ranking.top_ips_per_attack(f), "DDoS")
    ),
    "hourly_attack_delta": _on_flows(ranking.hourly_attack_delta),
    "hourly_delta_of_category": _on_flows(
        lambda f: counting.of_category(ranking.hourly_attack_delta(f), "DDoS")
    ),
    "hourly_attack_delta_dense": _on_flows(ranking.hourly_attack_delta_dense),
    "attack_running_total": _on_flows(ranking.attack_running_total),
    # SQL, severity, percentiles
    "sql_attack_profile": _on_flows(sql.sql_attack_profile),
    "attack_profile": _on_flows(_attack_profile),
    "severity_rows": _severity_rows(user_function=False),
    "severity_pandas_udf": _severity_rows(user_function=True),
    "severity_distribution": _on_flows(severity.severity_distribution),
    "severity_totals": _on_flows(severity.severity_totals),
    "flow_percentiles": _on_flows(sql.flow_percentiles),
    "percentile_sketch_errors": _on_flows(sketches.percentile_sketch_errors),
    "stored_percentiles": _stored_percentiles,
    "stored_distinct": _stored_distinct,
    "stored_traffic_cube": _stored("traffic_cube", ["attack_category", "label", "protocol", "hour", "severity", "flow_weight", "high_syn_weight", "flow_bytes_s_max", "flow_duration_n"]),
    "stored_category_port": _stored("category_port", ["attack_category", "destination_port", "flow_weight"]),
    "stored_ip_category": _stored("ip_category", ["source_ip", "attack_category", "flow_weight"]),
    "stored_ip_port": _stored("ip_port", ["source_ip", "destination_port", "flow_weight", "attack_weight"]),
    "percentile_rank_errors": _on_flows(sql.percentile_rank_errors),
    "flow_percentiles_exact": _on_flows(percentiles.flow_percentiles_exact),
    # timings
    "bench_compare": _comparison,
    "bench_overall": _overall,
    "job_timings": _job_timings,
    "ingest_raw_csv": _raw_csv,
    "ingest_report": _ingest_reported("audit"),
    "ingest_categories": _ingest_reported("categories"),
    "ingest_extras": _ingest_extras,
}
