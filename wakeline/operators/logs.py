"""Log parsing, service labels and error-log selection."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed patterns: line layout, and the two relabel rules (anchored, as relabel rules are).
LINE_PATTERN = r"^(\S+ \S+) \[(\w+)\] (\S+) - (.*)$"
LOG_ROOT = "/logs"
# A file source reports URIs (file:///logs/..., hdfs://host/logs/...).
URI_PREFIX = r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?(?=/)"
CONTAINER_SERVICE_PATTERN = r"^/(.*)$"
PARSED_COLUMNS = ["ts_text", "level", "logger", "message", "service_name"]


def service_from_path(path_col: str = "file_path", root: str = LOG_ROOT):
    """The folder right below ``root``, of a path or file URI; '' for files elsewhere."""
    path = F.regexp_replace(F.col(path_col), URI_PREFIX, "")
    return F.regexp_extract(path, "^" + re.escape(root.rstrip("/")) + r"/([^/]+)/.*$", 1)


def service_from_container(name_col: str = "container"):
    return F.regexp_extract(F.col(name_col), CONTAINER_SERVICE_PATTERN, 1)


def parse_lines(df: DataFrame, value: str = "value") -> DataFrame:
    v = F.col(value)
    return df.select("*", *[F.regexp_extract(v, LINE_PATTERN, i).alias(n)
                            for i, n in enumerate(["ts_text", "level", "logger", "message"], start=1)])


def labelled_logs(file_logs: DataFrame | None = None, container_logs: DataFrame | None = None,
                  root: str = LOG_ROOT) -> DataFrame:
    """Union of both sources with ``source``, ``service_name``, ``platform`` labels, lines parsed.

    ``root`` is the folder that holds one folder per service.
    """
    parts = []
    if file_logs is not None:
        parts.append(file_logs.select(F.col("file_path").alias("source"),
                                      service_from_path(root=root).alias("service_name"),
                                      F.lit(None).cast("string").alias("platform"), "value"))
    if container_logs is not None:
        parts.append(container_logs.select(F.col("container").alias("source"),
                                           service_from_container().alias("service_name"),
                                           F.lit("docker").alias("platform"), "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return parse_lines(out)


def error_logs(logs: DataFrame, limit: int | None = None) -> DataFrame:
    """``{service_name=~".+"} | detected_level="error"``, newest first (``limit`` optional).

    A plain text search comes first, so only lines that name the level anywhere are parsed.
    """
    named = F.upper("value").contains("[ERROR]") if "value" in logs.columns else F.lit(True)
    sel = logs.filter(named).filter((F.length("service_name") > 0) & (F.lower(F.col("level")) == "error"))
    sel = sel.orderBy(F.col("ts_text").desc())
    return sel.limit(limit) if limit else sel
