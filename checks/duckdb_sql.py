"""DuckDB SQL giving the expected result of each registered query.

Written from the definitions, not from the Spark code.  ``RAW`` and ``FLOWS`` are the
derived frames as common table expressions.
"""

from __future__ import annotations

from flowmarts.schema import MART_SCHEMAS

_KEYED = """
keyed as (
  select *, cast(json_extract_string(props, '$.k') as bigint) as k,
         (event_id * 31 + user_id) % 100 as r
  from events
)"""

_SHAPED = """
shaped as (
  select
    case event_id % 7 when 0 then 'Monday-WorkingHours.csv' when 1 then 'TUESDAY-WorkingHours.csv'
      when 2 then 'wednesday-workingHours.csv' when 3 then 'Thursday-Morning-WebAttacks.csv'
      when 4 then 'Friday-Afternoon-DDos.csv' when 5 then 'friday-after-monday.csv'
      else 'capture.csv' end as source_file,
    event_id,
    cast(event_id as varchar) as flow_id,
    '192.168.' || (1 + user_id % 50) || '.' || (1 + user_id % 253) as source_ip,
    '10.0.0.' || (1 + k % 19) as destination_ip,
    cast(1024 + (event_id * 17) % 64511 as integer) as source_port,
    cast(case k % 8 when 0 then 80 when 1 then 443 when 2 then 53 when 3 then 22 when 4 then 21
      when 5 then 8080 when 6 then 123 else 1024 + k end as integer) as destination_port,
    ts,
    cast(round(value * 10000) as bigint) as flow_duration,
    case when event_id % 97 = 0 or event_id % 89 = 0 or event_id % 83 = 0 then null
      else value * 1000 end as flow_bytes_s,
    value * 10 as flow_packets_s,
    cast(event_id % 9 as integer) as syn_flag_count,
    case
      when user_id % 3 = 0 then 'BENIGN'
      when user_id % 3 = 1 and event_id % 40 <> 0 then ' BENIGN '
      when user_id % 3 = 2 and event_type not in ('error', 'purchase') then 'BENIGN'
      when r < 30 then 'DoS Hulk' when r < 36 then 'DoS GoldenEye' when r < 40 then 'DoS slowloris'
      when r < 43 then 'DoS Slowhttptest' when r < 63 then 'DDoS' when r < 78 then 'PortScan'
      when r < 84 then 'FTP-Patator' when r < 89 then 'SSH-Patator' when r < 92 then 'Bot'
      when r < 94 then 'Web Attack � Brute Force' when r < 95 then 'Web Attack - XSS'
      when r < 96 then 'Web Attack – Sql Injection' when r < 97 then 'Infiltration'
      when r < 98 then 'Heartbleed' else 'Unlisted' end as raw_label
  from keyed
)"""

_LABELLED = """
labelled as (
  select *,
    regexp_replace(
      replace(
        regexp_replace(
          regexp_replace(raw_label, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'),
          '[^\\x00-\\x7F–—]+', '-', 'g'),
        '—', '–'),
      'Web Attack\\s*[–-]\\s*', 'Web Attack – ', 'g') as label
  from shaped
)"""

_CATEGORISED = """
categorised as (
  select *,
    case
      when label = 'BENIGN' then 'Benign'
      when label in ('DoS Hulk', 'DoS GoldenEye', 'DoS slowloris', 'DoS Slowhttptest') then 'DoS'
      when label = 'DDoS' then 'DDoS'
      when label = 'PortScan' then 'Port Scan'
      when label in ('FTP-Patator', 'SSH-Patator') then 'Brute Force'
      when label = 'Bot' then 'Bot'
      when label in ('Web Attack – Brute Force', 'Web Attack – XSS', 'Web Attack – Sql Injection')
        then 'Web Attack'
      when label = 'Infiltration' then 'Infiltration'
      when label = 'Heartbleed' then 'Heartbleed'
      else 'Other' end as attack_category
  from labelled
)"""

# Every 50th event twice.
_RAW = """
raw as (
  select * from categorised
  union all
  select * from categorised where event_id % 50 = 0
)"""

_FLOWS = """
flows as (
  select *,
    case when destination_port in (53, 67, 68, 123) then 17 else 6 end as protocol,
    cast(hour(ts) as integer) as hour,
    cast(ts as date) as date
  from categorised
  where flow_bytes_s is not null and flow_packets_s is not null
)"""

_BASE = _KEYED + "," + _SHAPED + "," + _LABELLED + "," + _CATEGORISED

COLUMNS = """flow_id, source_ip, destination_ip, source_port, destination_port, protocol, ts,
  flow_duration, flow_bytes_s, flow_packets_s, syn_flag_count, label, attack_category, hour, date"""

_SEVERITY = """case
    when attack_category in ('DDoS', 'DoS')
      then case when flow_bytes_s > 20000 then 'Critical' else 'High' end
    when attack_category = 'Brute Force'
      then case when syn_flag_count > 1 then 'High' else 'Medium' end
    when attack_category in ('Port Scan', 'Bot') then 'Medium'
    else 'Low' end"""

_LEVEL = "case when attack_flows >= 10 then 'HIGH' when attack_flows > 0 then 'MEDIUM' else 'LOW' end"

_IP_ATTACKS = """
ip_attacks as (
  select source_ip, count(*) as attack_flows,
         string_agg(distinct attack_category, ',' order by attack_category) as attack_types
  from flows where attack_category <> 'Benign' group by source_ip
)"""

_IP_PROFILE = (
    _IP_ATTACKS
    + f""",
ip_totals as (select source_ip, count(*) as total_flows from flows group by source_ip),
ip_joined as (
  select source_ip, total_flows, coalesce(attack_flows, 0) as attack_flows, attack_types
  from ip_totals left join ip_attacks using (source_ip)
),
ip_graded as (
  select *, {_LEVEL} as threat_level,
         round(cast(attack_flows as double) / total_flows * 100, 2) as attack_rate_pct
  from ip_joined
)"""
)

_HOURLY = """
hourly as (
  select hour, attack_category, count(*) as flows
  from flows where attack_category <> 'Benign' group by all
)"""

_DELTA = """
select hour, attack_category, cast(flows as bigint) as flows,
       cast(prev as bigint) as prev_hour_flows,
       cast(flows - coalesce(prev, flows) as bigint) as delta,
       round(case when prev > 0 then cast(flows - prev as double) / prev * 100 else 0 end, 1)
         as pct_change
from (select *, lag(flows) over (partition by attack_category order by hour) as prev from {hours})"""

_RANKED = """
select source_ip, attack_category, flow_count, cast(rnk as integer) as rank,
       cast(dense as integer) as dense_rank,
       round(cast(flow_count as double) / in_category * 100, 2) as pct_of_category
from (
  select *, rank() over w as rnk, dense_rank() over w as dense,
         sum(flow_count) over (partition by attack_category) as in_category
  from (
    select source_ip, attack_category, count(*) as flow_count
    from flows where attack_category <> 'Benign' group by all
  )
  window w as (partition by attack_category order by flow_count desc)
)
where rnk <= 5"""

_TOP_PORT = """
select source_ip, destination_port as primary_target_port, port_count
from (
  select *, rank() over (partition by source_ip order by port_count desc) as rnk
  from (
    select source_ip, destination_port, count(*) as port_count from flows group by all
  )
)
where rnk = 1"""

_IP_STATS = """
select source_ip, count(*) as total_flows,
       count(*) filter (where attack_category <> 'Benign') as attack_flows,
       count(distinct destination_port) as unique_ports_targeted,
       round(cast(count(*) filter (where attack_category <> 'Benign') as double)
             / count(*) * 100, 1) as attack_ratio
from flows group by source_ip"""

_CORRELATION = f"""
select source_ip, total_flows, attack_flows, unique_ports_targeted, attack_ratio,
       primary_target_port, port_count
from ({_IP_STATS}) left join ({_TOP_PORT}) using (source_ip)
where attack_ratio > 50
order by attack_flows desc, source_ip, primary_target_port limit {{k}}"""

_PROFILE = """
select attack_category, count(*) as total_flows,
       count(distinct source_ip) as unique_src_ips,
       count(distinct destination_port) as unique_dst_ports,
       round(avg(flow_bytes_s), 2) as avg_bytes_per_sec,
       round(avg(flow_duration), 2) as avg_duration_us,
       round(avg(syn_flag_count), 3) as avg_syn_flags,
       round(max(flow_bytes_s), 2) as max_bytes_per_sec
from flows group by attack_category"""

_PERCENTILES = """
select attack_category,
       round(quantile_disc(flow_bytes_s, 0.5), 2) as p50_bytes,
       round(quantile_disc(flow_bytes_s, 0.9), 2) as p90_bytes,
       round(quantile_disc(flow_bytes_s, 0.99), 2) as p99_bytes,
       quantile_disc(flow_duration, 0.5) as p50_duration_us,
       quantile_disc(flow_duration, 0.9) as p90_duration_us
from flows group by attack_category"""

# Sketches are random; what can be said in SQL is that each value is within the error stated.
_ALL_WITHIN = """
select distinct attack_category, true as p50_bytes, true as p90_bytes, true as p99_bytes,
       true as p50_duration_us, true as p90_duration_us
from flows"""

_DISTRIBUTION = """
select attack_category, count(*) as count,
       round(cast(count(*) as double) / (select count(*) from flows) * 100, 2) as percentage
from flows group by attack_category"""

_PORTS = """
select destination_port, count(*) as total_flows,
       count(*) filter (where attack_category <> 'Benign') as attack_flows,
       round(cast(count(*) filter (where attack_category <> 'Benign') as double)
             / count(*) * 100, 1) as attack_ratio
from flows group by destination_port"""

_PROTOCOLS = "select protocol, count(*) as flow_count from flows group by protocol"

_TIMED = """
with sides as (
  select 'task_' || event_type || '_rows' as task,
    coalesce(round(sum(value) filter (where user_id % 2 = 0 and event_type <> 'signup'), 3), 0)
      as baseline_s,
    coalesce(round(sum(value) filter (where user_id % 2 = 1 and event_type <> 'view'), 3), 0)
      as candidate_s
  from events group by event_type
)"""


def _draw(key: str, slot: int, low: int, high: int) -> str:
    """The value drawn from the five hex digits of ``slot`` of the row's digest."""
    digits = f"('0x' || substr(md5('42|' || {key}), {1 + 5 * slot}, 5))"
    return f"cast({low} + cast({digits} as bigint) % {high - low} as integer)"


def _address(key: str) -> str:
    def last(low: int, high: int) -> str:
        return _draw(key, 1, low, high)

    return f"""case attack_category
      when 'DoS' then '172.16.' || {_draw(key, 0, 0, 5)} || '.' || {last(1, 20)}
      when 'DDoS' then '203.0.113.' || {last(1, 50)}
      when 'Port Scan' then '192.168.100.' || {last(1, 10)}
      when 'Brute Force' then '192.168.10.' || {last(1, 8)}
      when 'Bot' then '10.10.0.' || {last(1, 30)}
      when 'Web Attack' then '203.0.113.' || {last(51, 80)}
      when 'Infiltration' then '198.51.100.' || {last(1, 10)}
      when 'Heartbleed' then '172.16.200.' || {last(1, 5)}
      else '192.168.' || {_draw(key, 0, 1, 50)} || '.' || {last(1, 254)} end"""


_FILE_DATE = """cast(case
    when lower(source_file) like '%monday%' then '2017-07-03'
    when lower(source_file) like '%tuesday%' then '2017-07-04'
    when lower(source_file) like '%wednesday%' then '2017-07-05'
    when lower(source_file) like '%thursday%' then '2017-07-06'
    else '2017-07-07' end as date)"""

_BOTH_KEYS = "source_file || '|' || flow_id"


def _raw(select: str) -> str:
    return f"with {_BASE},{_RAW}\n{select}"


def _flows(select: str, *more: str) -> str:
    return f"with {','.join([_BASE, _FLOWS, *more])}\n{select}"


_BRUTE = "from flows where attack_category = 'Brute Force'"
_IDS = "select flow_id, attack_category, source_ip, destination_port from flows"
_PROFILE_COLUMNS = "source_ip, total_flows, attack_flows, attack_types, threat_level, attack_rate_pct"
_TOP_HIGH = (
    f"select {_PROFILE_COLUMNS} from ip_graded where threat_level = 'HIGH'"
    " order by attack_flows desc, source_ip limit {k}"
)
_THREAT_COUNTS = "count(*) filter (where threat_level = '{0}')"

SQL: dict[str, str] = {
    # scans, sources, sinks
    "scan_flows": _flows(f"select {COLUMNS} from flows"),
    "ingest_clean": _raw(
        f"""select distinct source_file, flow_id, {_address(_BOTH_KEYS)} as source_ip,
  '10.0.0.' || {_draw(_BOTH_KEYS, 2, 1, 20)} as destination_ip,
  {_draw(_BOTH_KEYS, 3, 1024, 65535)} as source_port, destination_port,
  case when destination_port in (53, 67, 68, 123) then 17 else 6 end as protocol, ts,
  flow_duration, flow_bytes_s, flow_packets_s, syn_flag_count, label, attack_category,
  cast(hour(ts) as integer) as hour, {_FILE_DATE} as date
from raw where flow_bytes_s is not null and flow_packets_s is not null"""
    ),
    "date_from_file": _raw(
        f"select source_file, {_FILE_DATE} as date, count(*) as n from raw group by all"
    ),
    "union_days": _raw(
        """select source_file, flow_id,
  case when source_file <> 'capture.csv' then ts end as ts,
  case when source_file <> 'Monday-WorkingHours.csv' then syn_flag_count end as syn_flag_count
from raw"""
    ),
    "write_flows": _flows(f"select {COLUMNS} from flows"),
    "scan_flows_csv": _flows(f"select {COLUMNS} from flows"),
    "read_marts": _flows(
        "select *, cast(null as bigint) as count from (" + _TOP_HIGH.format(k=50) + ")", _IP_PROFILE
    ),
    "view_with_headers": _flows(
        """select destination_port, max(flow_bytes_s) as max_bytes,
  cast(sum(syn_flag_count) as bigint) as syn_flags
from flows where attack_category <> 'Benign' group by destination_port"""
    ),
    # row-level cleaning
    "label_normalise": _raw("select flow_id, label from raw"),
    "label_category": _raw("select flow_id, attack_category from raw"),
    "rate_coerce": _raw("select flow_id, flow_bytes_s, flow_packets_s from raw"),
    "drop_bad_rates": _raw(
        """select source_file, flow_id, flow_bytes_s, flow_packets_s
from raw where flow_bytes_s is not null and flow_packets_s is not null"""
    ),
    "dedup_flows": _raw(
        """select source_file, flow_id, label, attack_category, flow_bytes_s
from (select distinct * from raw where flow_bytes_s is not null and flow_packets_s is not null)"""
    ),
    "assign_ips": _raw(
        f"""select flow_id, attack_category, {_address('flow_id')} as source_ip,
  '10.0.0.' || {_draw('flow_id', 2, 1, 20)} as destination_ip from raw"""
    ),
    "assign_ports": _raw(
        f"""select flow_id, {_draw('flow_id', 3, 1024, 65535)} as source_port,
  {_draw('flow_id', 5, 1, 1024)} as destination_port from raw"""
    ),
    "hour_of_flow": _raw(
        f"""select flow_id,
  case when event_id % 11 <> 0 then cast(hour(ts) as integer) end as parsed_hour,
  {_draw('flow_id', 4, 0, 24)} as drawn_hour from raw"""
    ),
    "protocol_infer": _flows("select flow_id, destination_port, protocol from flows"),
    "ingest_audit": _raw(
        """select source_file, cast(sum(copies) as bigint) as raw_rows,
  cast(sum(case when bad then copies else 0 end) as bigint) as bad_rate_rows,
  cast(sum(case when bad then 0 else copies - 1 end) as bigint) as repeated_rows,
  cast(sum(case when bad then 0 else 1 end) as bigint) as saved_rows
from (select source_file, flow_id, flow_bytes_s is null or flow_packets_s is null as bad,
             count(*) as copies from raw group by all)
group by source_file"""
    ),
    # filters
    "filter_category": _flows(f"{_IDS} where attack_category = 'DDoS'"),
    "filter_attacks": _flows(f"{_IDS} where attack_category <> 'Benign'"),
    "high_syn": _flows("select count(*) as high_syn_flows from flows where syn_flag_count > 5"),
    "high_syn_flows": _flows(f"{_IDS} where syn_flag_count > 5"),
    "brute_ports": _flows(
        f"{_IDS} where attack_category = 'Brute Force' and destination_port in (21, 22, 23, 3389)"
    ),
    # distribution
    "total_flows": _flows("select count(*) as total_flows from flows"),
    "attack_distribution": _flows(_DISTRIBUTION),
    "attack_distribution_asc": _flows(_DISTRIBUTION + " order by count"),
    "label_distribution": _flows("select label, count(*) as count from flows group by label"),
    "malicious_split": _flows(
        """select 'Attack' as traffic, count(*) as flows from flows where attack_category <> 'Benign'
union all select 'Benign', count(*) from flows where attack_category = 'Benign'"""
    ),
    "distinct_categories": _flows("select distinct attack_category from flows"),
    "attack_hour_pivot": _flows(
        "select attack_category, "
        + ", ".join(f"count(*) filter (where hour = {h}) as h{h:02d}" for h in range(24))
        + ", count(*) filter (where hour is null) as no_hour"
        + " from flows where attack_category <> 'Benign' group by attack_category"
    ),
    # addresses
    "ip_category_stats": _flows(
        """select source_ip, attack_category, count(*) as flow_count,
  count(distinct destination_ip) as unique_targets,
  count(distinct destination_port) as unique_ports
from flows group by source_ip, attack_category"""
    ),
    "ip_totals": _flows("select source_ip, count(*) as total_flows from flows group by source_ip"),
    "ip_attacks": _flows("select * from ip_attacks", _IP_ATTACKS),
    "ip_threat_profile": _flows(f"select {_PROFILE_COLUMNS} from ip_graded", _IP_PROFILE),
    "ip_threat_profile_joined": _flows(f"select {_PROFILE_COLUMNS} from ip_graded", _IP_PROFILE),
    "top_suspicious_ips": _flows(_TOP_HIGH.format(k=50), _IP_PROFILE),
    "top_suspicious_15": _flows(_TOP_HIGH.format(k=15), _IP_PROFILE),
    "top_suspicious_30": _flows(_TOP_HIGH.format(k=30), _IP_PROFILE),
    "ip_class": _flows(
        """select *, case when attack_flows >= 10 then 'malicious' when attack_flows = 0 then 'clean'
  when benign_flows > 0 then 'mixed' end as ip_class
from (
  select source_ip, count(*) filter (where attack_category <> 'Benign') as attack_flows,
         count(*) filter (where attack_category = 'Benign') as benign_flows
  from flows group by source_ip)"""
    ),
    "threat_summary": _flows(
        "select threat_level, count(*) as count from ip_graded group by threat_level", _IP_PROFILE
    ),
    "threat_kpis": _flows(
        f"""select {_THREAT_COUNTS.format('HIGH')} as high, {_THREAT_COUNTS.format('MEDIUM')} as medium,
  {_THREAT_COUNTS.format('LOW')} as low, count(*) as total_ips,
  cast({_THREAT_COUNTS.format('HIGH')} as double) / count(*) * 100 as high_pct from ip_graded""",
        _IP_PROFILE,
    ),
    "high_threat_ip_count": _flows(
        """select count(*) as high_threat_ips from (
  select source_ip from flows where attack_category <> 'Benign'
  group by source_ip having count(*) >= 10)"""
    ),
    "overview_kpis": _flows(
        """select count(*) as total_records,
  count(*) filter (where attack_category <> 'Benign') as attack_flows,
  count(*) filter (where attack_category = 'Benign') as benign_flows,
  (select count(*) from ip_graded where threat_level = 'HIGH') as high_threat_ips,
  count(*) filter (where attack_category in ('DoS', 'DDoS')) as dos_ddos_flows
from flows""",
        _IP_PROFILE,
    ),
    "ip_profile": _flows(_IP_STATS),
    "top_port_per_ip": _flows(_TOP_PORT),
    "ip_port_correlation": _flows(_CORRELATION.format(k=100)),
    "ip_port_correlation_20": _flows(_CORRELATION.format(k=20)),
    "ip_port_correlation_joined": _flows(_CORRELATION.format(k=100)),
    # password guessing
    "brute_total": _flows(f"select count(*) as brute_flows {_BRUTE}"),
    "brute_ports_top": _flows(
        f"""select destination_port, count(*) as brute_flows {_BRUTE}
group by destination_port order by brute_flows desc, destination_port limit 10"""
    ),
    "brute_ips_top": _flows(
        f"""select source_ip, count(*) as attack_flows {_BRUTE}
group by source_ip order by attack_flows desc, source_ip limit 10"""
    ),
    "brute_hourly": _flows(f"select hour, count(*) as brute_flows {_BRUTE} group by hour"),
    "top_targeted_port": _flows(
        f"""select coalesce((select cast(destination_port as varchar) {_BRUTE}
  group by destination_port order by count(*) desc, destination_port limit 1), 'N/A') as top_port"""
    ),
    # traffic
    "protocol_distribution": _flows(_PROTOCOLS),
    "protocol_names": _flows(
        f"""select protocol, case protocol when 0 then 'HOPOPT' when 1 then 'ICMP' when 6 then 'TCP'
  when 17 then 'UDP' else cast(protocol as varchar) end as protocol_name, flow_count
from ({_PROTOCOLS})"""
    ),
    "top_ports": _flows(_PORTS + " order by total_flows desc, destination_port limit 15"),
    "hourly_traffic": _flows(
        "select hour, attack_category, count(*) as flows from flows group by hour, attack_category"
    ),
    "dos_ddos_counts": _flows(
        """select count(*) filter (where attack_category = 'DoS') as dos_flows,
  count(*) filter (where attack_category = 'DDoS') as ddos_flows from flows"""
    ),
    "flow_profile": _flows(
        """select attack_category, round(avg(flow_bytes_s), 2) as avg_bytes_per_s,
  round(avg(flow_packets_s), 2) as avg_packets_per_s,
  round(avg(flow_duration), 2) as avg_duration_us
from flows group by attack_category"""
    ),
    "format_counts": _flows(
        f"""select destination_port, format('{{:,}}', total_flows * 1000) as total_flows,
  'Port ' || destination_port as title from ({_PORTS})"""
    ),
    # ranking and hourly change
    "top_ips_per_attack": _flows(_RANKED),
    "top_ips_of_category": _flows(f"select * from ({_RANKED}) where attack_category = 'DDoS'"),
    "hourly_attack_delta": _flows(_DELTA.format(hours="hourly"), _HOURLY),
    "hourly_delta_of_category": _flows(
        f"select * from ({_DELTA.format(hours='hourly')}) where attack_category = 'DDoS'", _HOURLY
    ),
    "hourly_attack_delta_dense": _flows(
        _DELTA.format(hours="dense"),
        _HOURLY,
        """
dense as (
  select g.hour, g.attack_category, coalesce(h.flows, 0) as flows
  from (select distinct attack_category, cast(unnest(range(24)) as integer) as hour from hourly) g
  left join hourly h on h.hour = g.hour and h.attack_category = g.attack_category
)""",
    ),
    "attack_running_total": _flows(
        """select hour, attack_category, flows, cast(sum(flows) over (
  partition by attack_category order by hour rows unbounded preceding) as bigint) as running_total
from hourly""",
        _HOURLY,
    ),
    # SQL, severity, percentiles
    "sql_attack_profile": _flows(_PROFILE),
    "attack_profile": _flows(_PROFILE),
    "severity_rows": _flows(f"select flow_id, attack_category, {_SEVERITY} as severity from flows"),
    "severity_pandas_udf": _flows(
        f"select flow_id, attack_category, {_SEVERITY} as severity from flows"
    ),
    "severity_distribution": _flows(
        f"""select attack_category, severity, count(*) as count
from (select attack_category, {_SEVERITY} as severity from flows) group by all"""
    ),
    "severity_totals": _flows(
        f"select severity, count(*) as count from (select {_SEVERITY} as severity from flows) group by 1"
    ),
    "flow_percentiles": _flows(_PERCENTILES),
    "percentile_sketch_errors": _flows(_ALL_WITHIN),
    "stored_percentiles": _flows(_ALL_WITHIN),
    "stored_distinct": _flows(
        "select distinct attack_category, true as source_ip, true as destination_ip, true as destination_port from flows"
    ),
    "stored_traffic_cube": _flows(
        f"""select attack_category, label, protocol, hour, {_SEVERITY} as severity, count(*) as flow_weight,
  count(*) filter (where syn_flag_count > 5) as high_syn_weight, max(flow_bytes_s) as flow_bytes_s_max, count(flow_duration) as flow_duration_n
from flows group by all"""
    ),
    "stored_category_port": _flows("select attack_category, destination_port, count(*) as flow_weight from flows group by all"),
    "stored_ip_category": _flows("select source_ip, attack_category, count(*) as flow_weight from flows group by all"),
    "stored_ip_port": _flows(
        """select source_ip, destination_port, count(*) as flow_weight,
  count(*) filter (where attack_category <> 'Benign') as attack_weight from flows group by all"""
    ),
    "percentile_rank_errors": _flows(
        """select attack_category, share, true as within from (select distinct attack_category from flows)
cross join (values (0.5::double), (0.9::double), (0.99::double)) p(share)"""
    ),
    "flow_percentiles_exact": _flows(_PERCENTILES),
    "ingest_raw_csv": _raw(
        f"""select * exclude (source_file) from (select distinct source_file, flow_id, destination_port, flow_duration,
  flow_bytes_s, flow_packets_s, syn_flag_count, label, attack_category, {_FILE_DATE} as date,
  case when source_file <> 'capture.csv' then cast(hour(ts) as integer) end as parsed_hour
from raw where flow_bytes_s is not null and flow_packets_s is not null)"""
    ),
    "ingest_report": _raw(
        """select source_file, cast(sum(copies) as bigint) as raw_rows,
  cast(sum(case when bad then copies else 0 end) as bigint) as bad_rate_rows,
  cast(sum(case when bad then 0 else copies - 1 end) as bigint) as repeated_rows,
  cast(sum(case when bad then 0 else 1 end) as bigint) as saved_rows
from (select source_file, flow_id, flow_bytes_s is null or flow_packets_s is null as bad,
             count(*) as copies from raw group by all)
group by source_file"""
    ),
    # filters
    "ingest_categories": _raw(
        """select attack_category, count(*) as flows from (select distinct source_file, flow_id, attack_category
from raw where flow_bytes_s is not null and flow_packets_s is not null) group by 1"""
    ),
    "ingest_extras": _raw(
        """select distinct flow_id, case when source_file = 'Monday-WorkingHours.csv' then 20 end::bigint as fwd_header_length,
  case when source_file = 'Monday-WorkingHours.csv' then 21.5 end::double as fwd_header_length_1, 'bigint' as fwd_header_length_type, 'double' as fwd_header_length_1_type
from raw where flow_bytes_s is not null and flow_packets_s is not null"""
    ),
    # timings
    "bench_compare": _TIMED
    + """
select 'Task ' || upper(substr(event, 1, 1)) || substr(event, 2) || ' Rows' as task,
  baseline_s, candidate_s,
  case when candidate_s > 0 then round(baseline_s / candidate_s, 2) else 0 end as speedup,
  case when candidate_s < baseline_s then 'Candidate' else 'Baseline' end as faster
from (select *, split_part(task, '_', 2) as event from sides)""",
    "bench_overall": _TIMED
    + """
select round(sum(baseline_s), 3) as baseline_total_s, round(sum(candidate_s), 3) as candidate_total_s,
  round(sum(baseline_s) / sum(candidate_s), 2) as overall_speedup from sides""",
}


# The query whose rows each mart of a job holds.
_REPORTS = {
    "attack_distribution": {
        "total_records": "total_flows",
        "attack_categories": "attack_distribution",
        "label_distribution": "label_distribution",
        "attack_hour_matrix": "attack_hour_pivot",
    },
    "suspicious_ip": {
        "threat_summary": "threat_summary",
        "top_suspicious_ips": "top_suspicious_ips",
        "threat_kpis": "threat_kpis",
    },
    "failed_logins": {
        "total_brute_force": "brute_total",
        "top_targeted_ports": "brute_ports_top",
        "top_attacking_ips": "brute_ips_top",
        "hourly_pattern": "brute_hourly",
        "high_syn": "high_syn",
        "top_targeted_port": "top_targeted_port",
    },
    "traffic_analysis": {
        "protocol_distribution": "protocol_names",
        "top_ports": "top_ports",
        "dos_ddos": "dos_ddos_counts",
        "flow_bytes_by_attack": "flow_profile",
        "hourly_traffic": "hourly_traffic",
    },
    "advanced_analytics": {
        "sql_attack_profile": "sql_attack_profile",
        "top_ips_per_attack": "top_ips_per_attack",
        "hourly_attack_delta": "hourly_attack_delta",
        "attack_running_total": "attack_running_total",
        "ip_port_correlation": "ip_port_correlation",
        "severity_distribution": "severity_distribution",
        "flow_percentiles": "flow_percentiles_exact",
    },
}


def _cells(job: str, mart: str) -> str:
    """A mart as one row per measure: text and int columns are the key, bigint and double measures."""
    columns = [c.strip().split(" ", 1) for c in MART_SCHEMAS[job][mart].split(",")]
    keys = [f"coalesce(cast({c} as varchar), '')" for c, t in columns if t in ("string", "int", "array<string>")]
    measures = [(c, f"cast({c} as double)") for c, t in columns if t in ("bigint", "double")] + [("row", "1.0::double")]
    names = ", ".join(f"'{c}'" for c, _ in measures)
    values = ", ".join(v for _, v in measures)
    return f"""select '{job}' as job, '{mart}' as mart, concat_ws('|', {", ".join(["''", *keys])}) as key,
  unnest([{names}]) as measure, unnest([{values}]) as value from ({SQL[_REPORTS[job][mart]]}) m"""


_TRAFFIC_CELLS = "\nunion all\n".join(_cells("traffic_analysis", mart) for mart in _REPORTS["traffic_analysis"])
SQL["write_marts"] = f"select mart, key, measure, value from ({_TRAFFIC_CELLS}) c"
SQL["mart_document"] = f"""select mart, key, measure, value from ({_TRAFFIC_CELLS}) c
union all
select 'top_ports', '|' || destination_port, 'place', cast(row_number() over (order by total_flows desc, destination_port) as double)
from ({SQL["top_ports"]}) p"""
_ALL_CELLS = "\nunion all\n".join(_cells(job, mart) for job, marts in _REPORTS.items() for mart in marts)
SQL["job_timings"] = f"""select job, 'ok' as status, mart, key, measure, value from ({_ALL_CELLS}) c
union all
select 'total', 'ok', null, null, null, null"""
