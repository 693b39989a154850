"""Row predicates over fetched content (true = keep, never null)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlspark.fixed_values import MIN_PAGE_BYTES, TEXT_MIME_TYPES


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def is_text_type(content_type: Column) -> Column:
    """Exact membership: parameters such as `; charset=utf-8` make it a different type."""
    return _true(content_type.isin(*TEXT_MIME_TYPES))


def is_usable(content_type: Column, content: Column) -> Column:
    """Has a type, and is not a text page without a body."""
    no_body = content.isNull() | (F.octet_length(content) == 0)
    return content_type.isNotNull() & ~(is_text_type(content_type) & no_body)


def is_page(content_type: Column, content: Column) -> Column:
    """Typed, not an image, and at least 150 bytes long."""
    return _true(
        (content_type != "") & ~content_type.contains("image") & (F.octet_length(content) >= MIN_PAGE_BYTES))


def is_image(content_type: Column) -> Column:
    return _true(content_type.contains("image"))


def is_parsable(content_type: Column) -> Column:
    """Types whose text is extracted: text or any *ml, except vendor types."""
    return _true((content_type.contains("text") | content_type.contains("ml")) & ~content_type.contains("vnd"))
