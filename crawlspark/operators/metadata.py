"""Typed dynamic fields built from page metadata."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions.filters import is_text_type
from crawlspark.functions.identity import body_text
from crawlspark.functions.text import metadata_map
from crawlspark.functions.values import list_kind, metadata_field_name, values_of_kind


def page_metadata(content: DataFrame) -> DataFrame:
    """One row per metadata name of a text page: `url`, `name`, `values`."""
    return (
        content.where(is_text_type(F.col("content_type")))
        .select("url", F.explode(metadata_map(body_text(F.col("content")), F.col("content_type"))).alias("name", "values"))
    )


def all_fields(metadata: Column) -> Column:
    """Typed fields of a metadata map, by original name; names without values are dropped."""
    entries = F.filter(F.array_sort(F.map_entries(metadata)), lambda entry: F.size(entry["value"]) > 0)

    # Two steps, so that the patterns behind a kind run once per name.
    with_kind = F.transform(entries, lambda entry: F.struct(
        entry["key"].alias("name"),
        list_kind(entry["value"]).alias("kind"),
        (F.size(entry["value"]) > 1).alias("is_multiple"),
        entry["value"].alias("values")))
    return F.transform(with_kind, lambda entry: F.struct(
        entry["name"].alias("name"),
        metadata_field_name(entry["name"], entry["kind"], entry["is_multiple"]).alias("field"),
        entry["kind"].alias("kind"),
        entry["is_multiple"].alias("is_multiple"),
        values_of_kind(entry["values"], entry["kind"]).alias("values")))


def distinct_fields(fields: Column) -> Column:
    """Of names that map to one field, the smallest original name wins."""
    return F.filter(fields, lambda field, place: F.array_position(
        F.transform(fields, lambda other: other["field"]), field["field"]) == place + 1)


def typed_metadata(content: DataFrame) -> DataFrame:
    """One row per dynamic field of a text page: `url`, `name`, `field`, `kind`, `is_multiple`, `values`."""
    metadata = metadata_map(body_text(F.col("content")), F.col("content_type"))
    return (
        content.where(is_text_type(F.col("content_type")))
        .select("url", metadata.alias("metadata"))
        .select("url", all_fields(F.col("metadata")).alias("fields"))
        .select("url", F.inline(distinct_fields(F.col("fields"))))
    )


def field_catalogue(content: DataFrame) -> DataFrame:
    """Every dynamic field with its kind, the number of pages and of typed values it has, and the original names behind it."""
    metadata = metadata_map(body_text(F.col("content")), F.col("content_type"))
    key = ["field", "kind", "is_multiple"]
    found = (
        content.where(is_text_type(F.col("content_type")))
        .select("url", metadata.alias("metadata"))
        .select("url", all_fields(F.col("metadata")).alias("fields"))
        .select("fields", F.transform("fields", lambda field: F.struct(*[field[name] for name in key])).alias("keys"))
        .select(F.posexplode("fields").alias("place", "typed"), "keys")
    )
    # A page with several names of a field counts once, where the first of them stands.
    is_first = F.array_position("keys", F.get("keys", "place")) == F.col("place") + 1
    counted = found.select("typed.*", is_first.alias("is_first")).groupBy(*key, "name").agg(
        F.count_if("is_first").alias("pages"), F.sum(F.size("values")).alias("values"))
    return counted.groupBy(*key).agg(
        F.sum("pages").alias("n_pages"), F.sum("values").alias("n_values"), F.count("*").alias("n_names"),
        F.min("name").alias("first_name"), F.array_sort(F.collect_list("name")).alias("names"))


# Spark type of each kind of metadata value.
KIND_TYPES = {"text": "string", "long": "bigint", "boolean": "boolean", "double": "double"}


def _fields_of_kind(fields: Column, kind: str, multiple: bool) -> Column:
    target = KIND_TYPES[kind]
    chosen = F.filter(fields, lambda field: (field["kind"] == kind) & (field["is_multiple"] == F.lit(multiple)))
    if multiple:
        entries = F.transform(chosen, lambda field: F.struct(
            field["field"], F.transform(field["values"], lambda value: value.cast(target))))
    else:
        entries = F.transform(chosen, lambda field: F.struct(
            field["field"], F.get(field["values"], F.lit(0)).cast(target)))
    return F.map_from_entries(entries)


def field_maps(fields: Column) -> dict[str, Column]:
    """One map per value type and arity: `md_long` for single values, `md_longs` for lists, and so on."""
    return {
        f"md_{kind}{'s' if multiple else ''}": _fields_of_kind(fields, kind, multiple)
        for kind in KIND_TYPES for multiple in (False, True)
    }
