"""Types of metadata values and the field names built from them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlspark.fixed_values import (
    BOOLEAN_PATTERN, DOUBLE_PATTERN, FIELD_NAME_OVERRIDES, FIELD_TYPE_SUFFIX, LONG_PATTERN, METADATA_SUFFIX,
    MULTI_VALUE_SUFFIX)


def tidy_value(value: Column) -> Column:
    return F.regexp_replace(value, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def value_kind(value: Column) -> Column:
    """`long`, `boolean`, `double` or `text` for a value in text form; null for null."""
    text = tidy_value(value)
    return (
        F.when(text.rlike(LONG_PATTERN), F.lit("long"))
        .when(text.rlike(BOOLEAN_PATTERN), F.lit("boolean"))
        .when(text.rlike(DOUBLE_PATTERN), F.lit("double"))
        .when(text.isNotNull(), F.lit("text"))
    )


def list_kind(values: Column) -> Column:
    """Kind of a list: that of its first value; null for an empty list."""
    return value_kind(F.get(values, F.lit(0)))


def values_of_kind(values: Column, kind: Column) -> Column:
    """The values of a list that are of the given kind; with `list_kind`, those like its first value."""
    return F.transform(F.filter(values, lambda value: value_kind(value) == kind), tidy_value)


def field_name(name: Column, kind: Column, is_multiple: Column) -> Column:
    """Dynamic field name: `Last Modified` with a text value becomes `lastmodified_t`."""
    suffix_of = F.create_map(*[F.lit(part) for pair in FIELD_TYPE_SUFFIX.items() for part in pair])
    suffix = F.concat(F.try_element_at(suffix_of, kind),
                      F.when(is_multiple, F.lit(MULTI_VALUE_SUFFIX)).otherwise(F.lit("")))
    mapped = F.when(F.endswith(name, suffix), name).otherwise(
        F.concat(F.lower(F.regexp_replace(name, r"\s+", "")), suffix))
    for original, fixed in FIELD_NAME_OVERRIDES.items():
        mapped = F.when(name == original, F.lit(fixed)).otherwise(mapped)
    return mapped


def metadata_field_name(name: Column, kind: Column, is_multiple: Column) -> Column:
    """`field_name` with the metadata suffix, once."""
    mapped = field_name(name, kind, is_multiple)
    return F.when(F.endswith(mapped, F.lit(METADATA_SUFFIX)), mapped).otherwise(
        F.concat(mapped, F.lit(METADATA_SUFFIX)))
