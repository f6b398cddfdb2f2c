"""Reference data: known checks, tracked controls, and which check evidences which control."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftledger.schemas import CONTROL, PLUGIN, PLUGIN_CONTROL
from driftledger.session import local_frame

# Check id, name, default severity.
PLUGINS = [
    (10107, "HTTP Server Type and Version", 0),
    (11219, "Nessus SYN scanner", 0),
    (19506, "Nessus Scan Information", 0),
    (25220, "TCP/IP Timestamps Supported", 1),
    (10863, "SSL Certificate Information", 1),
    (51192, "SSL Certificate Cannot Be Trusted", 2),
    (57582, "SSL Self-Signed Certificate", 2),
    (42873, "SSL Medium Strength Cipher Suites", 2),
    (26928, "SSL Weak Cipher Suites Supported", 3),
    (78479, "SSLv3 Padding Oracle (POODLE)", 3),
    (73412, "OpenSSL Heartbeat Information Disclosure", 4),
    (97833, "SMBv1 Remote Code Execution", 4),
    (35291, "SSL Certificate Signed With Weak Hash", 2),
    (90317, "SSH Weak Algorithms Supported", 2),
    (12085, "Apache Tomcat Default Files", 1),
    (11213, "HTTP TRACE / TRACK Methods Allowed", 2),
    (58751, "SSL/TLS Suboptimal Renegotiation", 1),
    (20007, "SSL Version 2 and 3 Protocol Detection", 3),
    (15901, "SSL Certificate Expiry", 3),
    (45411, "SSL Certificate with Wrong Hostname", 2),
]

# Control id, title, family.
CONTROLS = [
    ("AC-2", "Account Management", "AC"),
    ("AU-6", "Audit Review, Analysis, and Reporting", "AU"),
    ("CM-6", "Configuration Settings", "CM"),
    ("CM-7", "Least Functionality", "CM"),
    ("IA-5", "Authenticator Management", "IA"),
    ("SC-8", "Transmission Confidentiality and Integrity", "SC"),
    ("SC-13", "Cryptographic Protection", "SC"),
    ("SC-17", "Public Key Infrastructure Certificates", "SC"),
    ("SI-2", "Flaw Remediation", "SI"),
    ("SI-4", "Information System Monitoring", "SI"),
]

# A check and a control it is evidence for.
EVIDENCE = [
    (10107, "CM-6"),
    (25220, "CM-6"),
    (12085, "CM-7"),
    (11213, "CM-7"),
    (97833, "CM-7"),
    (10863, "SC-17"),
    (51192, "SC-17"),
    (57582, "SC-17"),
    (35291, "SC-17"),
    (15901, "SC-17"),
    (45411, "SC-17"),
    (42873, "SC-13"),
    (26928, "SC-13"),
    (35291, "SC-13"),
    (90317, "SC-13"),
    (20007, "SC-13"),
    (42873, "SC-8"),
    (26928, "SC-8"),
    (78479, "SC-8"),
    (73412, "SC-8"),
    (58751, "SC-8"),
    (20007, "SC-8"),
    (73412, "SI-2"),
    (97833, "SI-2"),
    (78479, "SI-2"),
]

# Who signs the assessment.
ASSESSOR = "SCA-Team-1"


def plugin_catalog(spark: SparkSession) -> DataFrame:
    return local_frame(spark, PLUGINS, PLUGIN)


def control_catalog(spark: SparkSession) -> DataFrame:
    return local_frame(spark, CONTROLS, CONTROL)


def evidence_map(spark: SparkSession) -> DataFrame:
    return local_frame(spark, EVIDENCE, PLUGIN_CONTROL)


def load_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """A maintained catalogue kept as a headed CSV file instead of the built-in one."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)

