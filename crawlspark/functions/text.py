"""Plain text, metadata, links and tokens of a page, as column expressions."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlspark.functions.filters import is_parsable

# Named entities that text extraction decodes, the ampersand last.
ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&nbsp;": " ",
    "&copy;": "©", "&reg;": "®", "&middot;": "·", "&ndash;": "–", "&mdash;": "—",
    "&lsquo;": "‘", "&rsquo;": "’", "&ldquo;": "“", "&rdquo;": "”",
    "&hellip;": "…", "&euro;": "€", "&amp;": "&",
}

MARKUP_START = (r"(?is)^[\s\x{FEFF}]*<(?:!--|(?:!doctype|\?xml|html|head|title|body|meta|link|script|style|h[1-6]|p|div|span|"
                r"section|article|main|nav|header|footer|ul|ol|table|form|a)\b)")
# Every pattern takes time in proportion to the page. An unclosed comment or script runs to the end. Where a tag, head or
# title is not closed, none after it is either: the second alternative takes the rest of the page as it is (group 1), so that
# it is searched once and not again from every later tag. Quantifiers are possessive wherever nothing is given back.
COMMENT = r"(?s)<!--.*?(?:-->|\z)"
HEAD = r"(?is)<head\b[^>]*+>.*?</head\s*+>|(<head\b.*+)"
CODE_BLOCK = r"(?is)<(?:script|style)\b[^>]*+>.*?(?:</(?:script|style)\s*+>|\z)|(<(?:script|style)\b.*+)"
TAG = r"(?s)<[^>]++>|(<[^>]++\z)"
BLANKS = r"[ \t\r\n]++"
LINK = (r"(?is)<(?:a|area|link|img|frame|iframe|script)\s(?:[^<>]*?\s)?(?:href|src)\s*+=\s*+"
        r"(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
BASE_LINK = r"(?is)<base\s(?:[^<>]*?\s)?href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
SCRIPT_BODY = r"(?is)(<script\b[^>]*+>).*?(?:</script\s*+>|\z)|(<script\b.*+)"
# Group 1 with its closing tag, so that an unclosed title (empty group) differs from an empty one.
TITLE = r"(?is)<title\b[^>]*+>(.*?</title\s*+>)|<title\b.*+"
TITLE_END = r"(?is)</title\s*+>\z"
# Fixed value: white space other than the space and the newline.
OTHER_BLANKS = r"\t\x0B\f\r\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
META = r"(?is)(<meta\s[^>]*+>)|<meta\s.*+"
META_NAME = r"(?is)\s(?:name|property|http-equiv)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
META_CONTENT = r"(?is)\scontent\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
META_CHARSET = r"(?is)\scharset\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"


def decode_entities(text: Column) -> Column:
    for entity, character in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def is_markup(body: Column, content_type: Column | None = None) -> Column:
    """Whether a body is HTML or XML: by its type (a null type is neither); for callers without types, by how the body opens."""
    if content_type is None:
        return F.coalesce(body.rlike(MARKUP_START), F.lit(False))
    return F.coalesce(F.lower(content_type).rlike("html|xml"), F.lit(False))


def markup_to_text(markup: Column, decode: Callable[[Column], Column] = decode_entities) -> Column:
    """Visible text: no comments, head, scripts, styles or tags; blanks collapsed, entities decoded."""
    text = F.regexp_replace(markup, COMMENT, " ")
    for pattern in (HEAD, CODE_BLOCK, TAG):
        # What was taken as it is ends the page: the blank after it is trimmed below.
        text = F.regexp_replace(text, pattern, "$1 ")
    return decode(F.trim(F.regexp_replace(text, BLANKS, " ")))


def extract_text(body: Column, decode: Callable[[Column], Column] = decode_entities,
                 content_type: Column | None = None) -> Column:
    """Text of a page body: markup is stripped, plain text stays as it is, null becomes empty."""
    return F.coalesce(F.when(is_markup(body, content_type), markup_to_text(body, decode)).otherwise(body), F.lit(""))


def gated_text(content_type: Column, body: Column,
               decode: Callable[[Column], Column] = decode_entities) -> Column:
    """`extract_text` for parsable types, empty for every other type."""
    return F.when(is_parsable(content_type), extract_text(body, decode, content_type)).otherwise(F.lit(""))


def _unquote(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, r"^[\"']|[\"']$", ""))


def metadata_pairs(body: Column, content_type: Column | None = None) -> Column:
    """Name/value pairs of a page head, in document order per kind: title, named metas, charset."""
    def closed(pattern: str) -> Column:
        return F.filter(F.regexp_extract_all(body, F.lit(pattern), F.lit(1)), lambda found: found != "")

    titles = F.transform(
        closed(TITLE),
        lambda title: F.struct(
            F.lit("title").alias("name"),
            decode_entities(F.trim(F.regexp_replace(F.regexp_replace(title, TITLE_END, ""), BLANKS, " "))).alias("value")))
    tags = closed(META)
    named = F.transform(tags, lambda tag: F.struct(
        _unquote(F.regexp_extract(tag, META_NAME, 1)).alias("name"),
        decode_entities(_unquote(F.regexp_extract(tag, META_CONTENT, 1))).alias("value")))
    charset = F.transform(tags, lambda tag: F.struct(
        F.lit("charset").alias("name"),
        _unquote(F.regexp_extract(tag, META_CHARSET, 1)).alias("value")))
    pairs = F.concat(titles, F.filter(named, lambda pair: pair["name"] != ""),
                     F.filter(charset, lambda pair: pair["value"] != ""))
    return F.when(is_markup(body, content_type), pairs)


def metadata_map(body: Column, content_type: Column | None = None) -> Column:
    """Metadata name to all its values; an empty map where there are none."""
    pairs = F.coalesce(metadata_pairs(body, content_type), F.array().cast("array<struct<name:string,value:string>>"))

    def by_name(entries: Column) -> Column:
        names = F.array_distinct(F.transform(entries, lambda pair: pair["name"]))
        values = F.transform(names, lambda name: F.transform(
            F.filter(entries, lambda pair: pair["name"] == name), lambda pair: pair["value"]))
        return F.map_from_arrays(names, values)

    # Evaluating the pairs once: a one-element transform gives the list a name.
    return F.get(F.transform(F.array(pairs), by_name), F.lit(0))


def raw_links(body: Column) -> Column:
    """Distinct link texts of a page as written, without those in comments and script bodies."""
    visible = F.regexp_replace(F.regexp_replace(body, COMMENT, " "), SCRIPT_BODY, "$1$2")
    links = F.transform(F.regexp_extract_all(visible, F.lit(LINK), F.lit(1)),
                        lambda link: decode_entities(_unquote(link)))
    return F.array_distinct(F.filter(links, lambda link: link != ""))


def base_url(url: Column, body: Column) -> Column:
    """The page's own `<base href>` where it is absolute, else its URL."""
    declared = _unquote(F.regexp_extract(body, BASE_LINK, 1))
    return F.when(declared.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), declared).otherwise(url)


def tokens(text: Column) -> Column:
    """Split at spaces and newlines; tokens lose surrounding blanks, and empty ones go."""
    plain = F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " ")
    # Only texts with other blanks (tabs, no-break spaces, ...) need the trimming patterns.
    trimmed = F.regexp_replace(text, f"^[ \\n{OTHER_BLANKS}]+|[ \\n{OTHER_BLANKS}]+$", "")
    padded = F.split(trimmed, f"[{OTHER_BLANKS}]*[ \\n][ \\n{OTHER_BLANKS}]*")
    return F.array_remove(F.when(text.rlike(f"[{OTHER_BLANKS}]"), padded).otherwise(plain), "")
