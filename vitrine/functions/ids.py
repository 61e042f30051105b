"""Hashes and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.time import format_ts14


def md5_hex(c: Column) -> Column:
    return F.md5(c)


def sha256_hex(c: Column) -> Column:
    return F.sha2(c, 256)


def image_id(first_ts: Column, url: Column) -> Column:
    return F.concat_ws("/", format_ts14(first_ts), F.md5(url))


def url_with_ts(first_ts: Column, url: Column) -> Column:
    return F.concat_ws("/", format_ts14(first_ts), url)


def reference_id(page_ts: Column, page_url: Column, metadata: Column, digest: Column) -> Column:
    return F.concat_ws("/", format_ts14(page_ts), F.md5(page_url), F.md5(metadata), digest)
