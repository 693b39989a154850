"""Decoding of every HTML entity, for callers who need more than the common named ones."""

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

ENTITY = r"(?s)^&(?:#0*([0-9]{1,8})|#[xX]0*([0-9A-Fa-f]{1,7})|([A-Za-z][A-Za-z0-9]*));(.*)$"
#: A number with more digits than those is no character.
TOO_LARGE = r"(?s)^&#(?:[0-9]+|[xX][0-9A-Fa-f]+);(.*)$"
LARGEST = 0x10FFFF
# Fixed value: HTML 5 reads references to C1 controls as windows-1252, where that has a character.
WINDOWS = {code: bytes([code]).decode("cp1252") for code in range(0x80, 0xA0) if code not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def _character(code: Column) -> Column:
    """The character of a code point; other numbers give the replacement character."""
    windows = F.create_map(*[F.lit(item) for pair in WINDOWS.items() for item in pair])
    valid = (code > 0) & (code <= LARGEST) & ~code.between(0xD800, 0xDFFF)
    packed = F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0"))
    return F.coalesce(F.try_element_at(windows, code.cast("int")), F.decode(packed, "UTF-32"))


def decode_all_entities(text: Column) -> Column:
    """All named (HTML 5) and numeric entities that end in a semicolon; pass it as `decode` to the text functions.

    The text is cut where an entity starts, so each piece opens with at most one.
    Unknown names, and references without a semicolon, stay as they are: in
    plain text `&copy=1` or `&lt` may as well be part of an address.
    """
    names = F.create_map(*[F.lit(item) for name, characters in sorted(html5.items()) if name.endswith(";")
                           for item in (name[:-1], characters)])

    def decoded(piece: Column) -> Column:
        decimal, hexadecimal, name, rest = (F.regexp_extract(piece, ENTITY, group) for group in (1, 2, 3, 4))
        known = F.try_element_at(names, name)
        return (F.when(decimal != "", F.concat(_character(decimal.cast("bigint")), rest))
                .when(hexadecimal != "", F.concat(_character(F.conv(hexadecimal, 16, 10).cast("bigint")), rest))
                .when(piece.rlike(TOO_LARGE), F.concat(F.lit("�"), F.regexp_extract(piece, TOO_LARGE, 1)))
                .when((name != "") & known.isNotNull(), F.concat(known, rest))
                .otherwise(piece))

    pieces = F.split(text, r"(?=&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]{0,40});)")
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, decoded), "")).otherwise(text)
