"""Column names, types and fixed lookup values of the flow table."""

from __future__ import annotations

import re

# Header text in capture files, our column name, Spark type.
FLOW_COLUMNS = [
    ("Flow ID", "flow_id", "string"),
    ("Source IP", "source_ip", "string"),
    ("Destination IP", "destination_ip", "string"),
    ("Source Port", "source_port", "int"),
    ("Destination Port", "destination_port", "int"),
    ("Protocol", "protocol", "int"),
    ("Timestamp", "ts", "timestamp_ntz"),
    ("Flow Duration", "flow_duration", "bigint"),
    ("Total Fwd Packets", "total_fwd_packets", "int"),
    ("Total Backward Packets", "total_bwd_packets", "int"),
    ("Total Length of Fwd Packets", "total_len_fwd", "bigint"),
    ("Total Length of Bwd Packets", "total_len_bwd", "bigint"),
    ("Flow Bytes/s", "flow_bytes_s", "double"),
    ("Flow Packets/s", "flow_packets_s", "double"),
    ("Flow IAT Mean", "flow_iat_mean", "double"),
    ("Fwd PSH Flags", "fwd_psh_flags", "int"),
    ("Bwd PSH Flags", "bwd_psh_flags", "int"),
    ("Fwd URG Flags", "fwd_urg_flags", "int"),
    ("Bwd URG Flags", "bwd_urg_flags", "int"),
    ("FIN Flag Count", "fin_flag_count", "int"),
    ("SYN Flag Count", "syn_flag_count", "int"),
    ("RST Flag Count", "rst_flag_count", "int"),
    ("PSH Flag Count", "psh_flag_count", "int"),
    ("ACK Flag Count", "ack_flag_count", "int"),
    ("URG Flag Count", "urg_flag_count", "int"),
    ("Label", "label", "string"),
    ("Attack_Category", "attack_category", "string"),
    ("Hour", "hour", "int"),
    ("Date", "date", "date"),
]

HEADER_TO_NAME = {header: name for header, name, _ in FLOW_COLUMNS}
NAME_TO_HEADER = {name: header for header, name, _ in FLOW_COLUMNS}
NAME_TO_TYPE = {name: dtype for _, name, dtype in FLOW_COLUMNS}

RATE_COLUMNS = ("flow_bytes_s", "flow_packets_s")

BENIGN = "Benign"
BRUTE_FORCE = "Brute Force"
OTHER = "Other"

# Capture label -> attack category.
LABEL_CATEGORIES = {
    "BENIGN": "Benign",
    "DoS Hulk": "DoS",
    "DoS GoldenEye": "DoS",
    "DoS slowloris": "DoS",
    "DoS Slowhttptest": "DoS",
    "DDoS": "DDoS",
    "PortScan": "Port Scan",
    "FTP-Patator": "Brute Force",
    "SSH-Patator": "Brute Force",
    "Bot": "Bot",
    "Web Attack – Brute Force": "Web Attack",
    "Web Attack – XSS": "Web Attack",
    "Web Attack – Sql Injection": "Web Attack",
    "Infiltration": "Infiltration",
    "Heartbleed": "Heartbleed",
}

# Category -> address prefix, bounds of the third octet (None when
# the prefix already fixes it), bounds of the last octet.  Upper bounds exclusive.
SOURCE_RANGES = {
    "Benign": ("192.168.", (1, 50), (1, 254)),
    "DoS": ("172.16.", (0, 5), (1, 20)),
    "DDoS": ("203.0.113.", None, (1, 50)),
    "Port Scan": ("192.168.100.", None, (1, 10)),
    "Brute Force": ("192.168.10.", None, (1, 8)),
    "Bot": ("10.10.0.", None, (1, 30)),
    "Web Attack": ("203.0.113.", None, (51, 80)),
    "Infiltration": ("198.51.100.", None, (1, 10)),
    "Heartbleed": ("172.16.200.", None, (1, 5)),
}
DESTINATION_RANGE = ("10.0.0.", (1, 20))

# Weekday in a capture's file name -> capture date.
WEEKDAY_DATES = {
    "monday": "2017-07-03",
    "tuesday": "2017-07-04",
    "wednesday": "2017-07-05",
    "thursday": "2017-07-06",
    "friday": "2017-07-07",
}
DEFAULT_DATE = "2017-07-07"

# IP protocol numbers, UDP service ports, remote-login ports.
PROTOCOL_NAMES = {0: "HOPOPT", 1: "ICMP", 6: "TCP", 17: "UDP"}
UDP_PORTS = (53, 67, 68, 123)
LOGIN_PORTS = (21, 22, 23, 3389)

# Thresholds and list lengths of the reports.
ATTACK_THRESHOLD = 10
SYN_THRESHOLD = 5
TOP_SUSPICIOUS = 50
TOP_BRUTE = 10
TOP_PORTS = 15
TOP_CORRELATED = 100
TOP_RANK = 5


def snake_case(header: str) -> str:
    """Our name for a header: listed names as given, others lower_snake."""
    clean = header.strip()
    if clean in HEADER_TO_NAME:
        return HEADER_TO_NAME[clean]
    return re.sub(r"[^0-9a-z]+", "_", clean.lower()).strip("_") or "column"


# Result marts by job: name -> DDL of the rows.
MART_SCHEMAS = {
    "attack_distribution": {
        "total_records": "total_flows bigint",
        "attack_categories": "attack_category string, count bigint, percentage double",
        "label_distribution": "label string, count bigint",
        "attack_hour_matrix": "attack_category string, "
        + ", ".join(f"h{h:02d} bigint" for h in range(24))
        + ", no_hour bigint",
    },
    "suspicious_ip": {
        "threat_summary": "threat_level string, count bigint",
        "top_suspicious_ips": "source_ip string, total_flows bigint, attack_flows bigint, "
        "attack_types array<string>, threat_level string, attack_rate_pct double",
        "threat_kpis": "high bigint, medium bigint, low bigint, total_ips bigint, high_pct double",
    },
    "failed_logins": {
        "total_brute_force": "brute_flows bigint",
        "top_targeted_ports": "destination_port int, brute_flows bigint",
        "top_attacking_ips": "source_ip string, attack_flows bigint",
        "hourly_pattern": "hour int, brute_flows bigint",
        "high_syn": "high_syn_flows bigint",
        "top_targeted_port": "top_port string",
    },
    "traffic_analysis": {
        "protocol_distribution": "protocol int, protocol_name string, flow_count bigint",
        "top_ports": "destination_port int, total_flows bigint, attack_flows bigint, "
        "attack_ratio double",
        "dos_ddos": "dos_flows bigint, ddos_flows bigint",
        "flow_bytes_by_attack": "attack_category string, avg_bytes_per_s double, "
        "avg_packets_per_s double, avg_duration_us double",
        "hourly_traffic": "hour int, attack_category string, flows bigint",
    },
    "advanced_analytics": {
        "sql_attack_profile": "attack_category string, total_flows bigint, "
        "unique_src_ips bigint, unique_dst_ports bigint, avg_bytes_per_sec double, "
        "avg_duration_us double, avg_syn_flags double, max_bytes_per_sec double",
        "top_ips_per_attack": "source_ip string, attack_category string, flow_count bigint, "
        "rank int, dense_rank int, pct_of_category double",
        "hourly_attack_delta": "hour int, attack_category string, flows bigint, "
        "prev_hour_flows bigint, delta bigint, pct_change double",
        "attack_running_total": "hour int, attack_category string, flows bigint, "
        "running_total bigint",
        "ip_port_correlation": "source_ip string, total_flows bigint, attack_flows bigint, "
        "unique_ports_targeted bigint, attack_ratio double, primary_target_port int, "
        "port_count bigint",
        "severity_distribution": "attack_category string, severity string, count bigint",
        "flow_percentiles": "attack_category string, p50_bytes double, p90_bytes double, "
        "p99_bytes double, p50_duration_us bigint, p90_duration_us bigint",
    },
}
