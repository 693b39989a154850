"""URL parts and link resolution."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlspark.functions.identity import sha_hex

# Protocols whose URLs have a stored path.
_PROTOCOL = r"^(?i)(https?|ftp|file|jar|mailto):"
_AUTHORITY_HOST = r"^[A-Za-z]+://(?:[^/?#@]*@)?([^/?#:]*)"


def host(url: Column) -> Column:
    """Host without one leading `www.`; empty where the URL is invalid or has none."""
    return F.regexp_replace(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")), r"^www\.", "")


def stored_path(url: Column) -> Column:
    """`org/example/www/<sha of url>`: host labels from the top, `www` kept; empty for malformed URLs."""
    labels = F.filter(F.split(F.regexp_extract(url, _AUTHORITY_HOST, 1), r"\."), lambda label: label != "")
    path = F.concat(F.array_join(F.reverse(labels), "/"), F.lit("/"), sha_hex(url))
    return F.when(url.rlike(_PROTOCOL), path).otherwise(F.lit(""))


def _without_dot_segments(path: Column) -> Column:
    """Apply `.` and `..` segments of an absolute path."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(part))),
    )
    ends_in_directory = F.element_at(segments, -1).isin(".", "..")
    return F.concat(F.array_join(kept, "/"), F.when(ends_in_directory, "/").otherwise(""))


def base_parts(base: Column) -> Column:
    """The parts of a page's URL that links on it are resolved against."""
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    return F.struct(
        F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1).alias("scheme"),
        site.alias("site"),
        page.alias("page"),
        F.when(page == site, F.concat(site, F.lit("/"))).otherwise(
            F.regexp_extract(page, r"^(.*/)", 1)).alias("directory"),
        F.regexp_extract(base, r"^([^#]*)", 1).alias("address"),
    )


def absolute_link(parts: Column, link: Column) -> Column:
    """`link` as seen from the page whose `base_parts` are given; dot segments stay."""
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(parts["scheme"], link))
        .when(link.startswith("/"), F.concat(parts["site"], link))
        .when(link.startswith("?"), F.concat(parts["page"], link))
        .when(link.startswith("#"), F.concat(parts["address"], link))
        .otherwise(F.concat(parts["directory"], link))
    )


def tidy_link(url: Column) -> Column:
    """An absolute URL with the `.` and `..` segments of its path applied."""
    head = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(url, r"^[^?#]*(.*)$", 1)
    has_dots = url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^?#]*/\.")
    return F.when(has_dots, F.concat(head, _without_dot_segments(path), tail)).otherwise(url)


def resolve_link(base: Column, link: Column) -> Column:
    """Absolute URL of `link` on the page at `base`, for a single pair of columns."""
    return tidy_link(absolute_link(base_parts(base), link))
