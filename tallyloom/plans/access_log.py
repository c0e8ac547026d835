"""The four reports on a web server log."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyloom.operators.aggregates import (
    content_size_stats,
    frequent_ips,
    response_code_counts,
    top_endpoints,
)
from tallyloom.operators.parsing import parse_access_log
from tallyloom.operators.routing import cache_reused
from tallyloom.sinks.files import document_sink


def access_log_reports(lines: DataFrame, col: str = "value", min_count: int = 30) -> dict[str, DataFrame]:
    """Report name to report.  All share the parsed lines; cache those to run several."""
    return reports(parse_access_log(lines, col), min_count)


def reports(log: DataFrame, min_count: int = 30) -> dict[str, DataFrame]:
    return {
        "content_size": content_size_stats(log),
        "response_codes": response_code_counts(log),
        "frequent_ips": frequent_ips(log, min_count=min_count),
        "top_endpoints": top_endpoints(log),
    }


def write_access_log_reports(lines: DataFrame, uri: str, col: str = "value", min_count: int = 30) -> None:
    """Parse once, write every report as a collection below ``uri``."""
    needed = ["ip_address", "endpoint", "response_code", "content_size"]
    with cache_reused(parse_access_log(lines, col).select(*needed)) as log:
        for name, report in reports(log, min_count).items():
            document_sink(report, uri, name)
