"""Selecting captures from a crawl index, and locating their archives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gleanrank.functions.web import ARCHIVE_HOST, host, host_key, in_domain, wet_name, wet_url


def with_host_key(captures: DataFrame) -> DataFrame:
    """Adds the key by which a capture index is sorted, null where the URL has no host."""
    name = host(F.col("url"))
    return captures.withColumn("host_key", F.when(name != "", host_key(name)))


def index_captures(captures: DataFrame, domain: str, crawls: Sequence[str] | None = None) -> DataFrame:
    """Captures of a domain and its subdomains in the given crawls, or in all of them.

    In a capture index (see `write_capture_index`) a domain is one range of keys, which the reader looks for in the few
    row groups that hold it; elsewhere the URLs are tested.
    """
    if crawls is not None:
        captures = captures.filter(F.col("crawl").isin(list(crawls)))
    if "host_key" not in captures.columns:
        return captures.filter(in_domain(F.col("url"), domain))
    key = ".".join(reversed(domain.lower().split("."))) + "."
    # The character behind the dot ends the range of keys that begin with the domain's.
    upper = key[:-1] + chr(ord(".") + 1)
    return captures.filter((F.col("host_key") >= key) & (F.col("host_key") < upper)).drop("host_key")


def rejected_captures(captures: DataFrame) -> DataFrame:
    """Position, status and filename of the captures whose status is not 200."""
    return captures.filter(F.col("status") != "200").select("pos", "status", "filename")


def wet_locations(captures: DataFrame, prefix: str = ARCHIVE_HOST) -> DataFrame:
    """(wet, name, wet_pos): each archive once, with the position of its first capture."""
    located = captures.select(wet_url(F.col("filename"), prefix).alias("wet"), "pos")
    return (
        located.groupBy("wet")
        .agg(F.min("pos").alias("wet_pos"))
        .select("wet", wet_name(F.col("wet")).alias("name"), "wet_pos")
    )
