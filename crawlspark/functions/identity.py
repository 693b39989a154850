"""Hashes and document identifiers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha_hex(value: Column) -> Column:
    """SHA-256 of a string or binary value, 64 upper-case hex digits."""
    return F.upper(F.sha2(value, 256))


def body_text(content: Column) -> Column:
    """Page bytes as UTF-8 text; malformed bytes become replacement characters."""
    return F.make_valid_utf8(content.cast("string"))


def document_id(url: Column, timestamp: Column) -> Column:
    """Identifier of a dumped document; an unknown time hashes as the text `null`."""
    return sha_hex(F.concat(url, F.lit("-"), F.coalesce(timestamp.cast("string"), F.lit("null"))))


def index_id(url: Column, crawl_id: Column, fetch_time: Column) -> Column:
    """Identifier of a search-index record; an unknown time hashes as the text `null`."""
    time = F.coalesce(fetch_time.cast("string"), F.lit("null"))
    return sha_hex(F.concat(url, F.lit("-"), crawl_id, F.lit("-"), time))


def plain_path(path: Column) -> Column:
    """A file path without scheme and authority, so that two spellings of one file agree."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*(?=/)", "")
