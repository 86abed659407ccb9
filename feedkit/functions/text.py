"""Text cleaning and byte-exact replacement as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BytesLike = bytes | str

# Byte sequences the strict extract cleanup removes, besides tab, LF, CR and NUL.
STRICT_REMOVALS = [
    b"\x7f",
    b"\x1a",
    b"\xef\xbf\xbd",
    b"\xef\xbe\xbf",
    b"\xdc\x8e",
    b"\xdd\x8c",
    b"\xce\x81",
    b"\xce\x82",
    b"\xd6\x8e",
    b"\x2e\xe1",
    b"\xe1\x8a\xb1",
]


def as_bytes(value: BytesLike) -> bytes:
    return value.encode("utf-8") if isinstance(value, str) else value


def decode_escapes(text: str) -> bytes:
    """Bytes of a job parameter, with ``\\t`` and ``\\xNN`` style escapes decoded."""
    return text.encode("utf-8").decode("unicode_escape").encode("latin-1")


def is_utf8(value: bytes) -> bool:
    try:
        value.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def null_to_empty(c: Column, trim: bool = False) -> Column:
    """Text of ``c`` with NULL as the empty string."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.trim(text) if trim else text


def rtrim_spaces(c: Column) -> Column:
    """Drop trailing U+0020 only; a no-break space stays."""
    return F.rtrim(c)


def whitespace_to_space(c: Column) -> Column:
    """Tab, LF and CR become a space, NUL goes away."""
    return F.translate(c, "\t\n\r\0", "   ")


def binary_to_uuid(c: Column) -> Column:
    """16 bytes as a lower-case 8-4-4-4-12 text; NULL gives the empty string."""
    digits = F.lower(F.hex(c))
    pieces = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digits, at, n) for at, n in pieces])


def binary_to_text(c: Column, is_id: bool = False) -> Column:
    """16 bytes as by ``binary_to_uuid``, any other number of bytes as lower-case hex digits, whole; NULL is ``''``.

    ``is_id`` says that every value is an id of 16 bytes.
    """
    if is_id:
        return binary_to_uuid(c)
    return F.when(F.octet_length(c) == 16, binary_to_uuid(c)).otherwise(F.coalesce(F.lower(F.hex(c)), F.lit("")))


def to_latin1(c: Column) -> Column:
    """Every byte of ``c`` as one character, so string functions work byte by byte."""
    return F.decode(c.cast("binary"), "ISO-8859-1")


def from_latin1(c: Column) -> Column:
    return F.encode(c, "ISO-8859-1").cast("string")


def replace_literals(c: Column, pairs: Sequence[tuple[BytesLike, BytesLike]]) -> Column:
    """Apply literal replacements one after the other, in the given order.

    Keys that are whole UTF-8 text replace directly.  Keys that are part of a character
    need the text as ISO-8859-1, where one byte is one character; a value without a certain
    byte of any such key skips that.
    """
    raw = [(as_bytes(old), as_bytes(new)) for old, new in pairs if old]
    partial = [old for old, new in raw if not (is_utf8(old) and is_utf8(new))]
    if not partial:
        return _replace_each(c, raw, "utf-8")
    bytewise = from_latin1(_replace_each(to_latin1(c), raw, "latin-1"))
    signs = sorted({max(old) for old in partial})
    if any(sign in new for _, new in raw for sign in signs):
        return bytewise
    binary = c.cast("binary")
    has_sign = F.lit(False)
    for sign in signs:
        has_sign = has_sign | F.contains(binary, F.lit(bytes([sign])))
    whole = [(old, new) for old, new in raw if old not in partial]
    return F.when(has_sign, bytewise).otherwise(_replace_each(c, whole, "utf-8"))


def _replace_each(c: Column, pairs: Sequence[tuple[bytes, bytes]], charset: str) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old.decode(charset)), F.lit(new.decode(charset)))
    return c


def replace_mapping(c: Column, mapping: Mapping[BytesLike, BytesLike]) -> Column:
    """Literal replacement with the longest key first; ties keep the mapping's order."""
    pairs = sorted(mapping.items(), key=lambda kv: -len(as_bytes(kv[0])))
    return replace_literals(c, pairs)


def strict_text(c: Column) -> Column:
    """Strict cleanup of a text value: whitespace to space, NUL and odd sequences removed."""
    return replace_literals(whitespace_to_space(c), [(seq, b"") for seq in STRICT_REMOVALS])


def decodable(c: Column) -> Column:
    """``c`` without the bytes that are no UTF-8 text."""
    pieces = F.split(to_latin1(c), java_quote(b"\xef\xbf\xbd".decode("latin-1")), -1)
    cleaned = F.transform(
        pieces, lambda p: F.replace(F.make_valid_utf8(from_latin1(p)), F.lit("\ufffd"), F.lit(""))
    )
    return F.when(F.is_valid_utf8(c), c).otherwise(F.array_join(cleaned, "\ufffd"))


def raw_fields(c: Column, delimiter: str) -> Column:
    """Fields of a line with every byte kept, also where the line is no valid UTF-8."""
    latin = delimiter.encode("utf-8").decode("latin-1")
    bytewise = F.transform(F.split(to_latin1(c), java_quote(latin), -1), from_latin1)
    return F.when(F.is_valid_utf8(c), split_literal(c, delimiter)).otherwise(bytewise)


def split_literal(c: Column, delimiter: str) -> Column:
    """Fields of a line: literal delimiter, no quoting, trailing empty fields kept."""
    return F.split(c, java_quote(delimiter), -1)


def java_quote(literal: str) -> str:
    """``literal`` as a Java regular expression that matches just itself.

    Java splits at a single (escaped) character without compiling a pattern for each row.
    """
    if len(literal) == 1 and ord(literal) < 0x10000:
        return literal if literal.isalnum() or literal not in ".$|()[{^?*+\\" else "\\" + literal
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def percent_of(a: Column, b: Column) -> Column:
    """``a`` as a percentage of ``b`` with one decimal; 0 when ``a`` is 0, NULL beyond 17 digits."""
    share = F.try_divide(a.cast("double"), b.cast("double")) * 100
    return F.when(a == 0, F.lit(0).cast("decimal(18,1)")).otherwise(share.try_cast("decimal(18,1)"))


# Names for the delimiters a job may ask for by word.
DELIMITER_WORDS = {
    "comma": ",",
    "tab": "\t",
    "pipe": "|",
    "csv": ",",
    "tsv": "\t",
}

# Fixed value: the delimiter used when a job names none.
DEFAULT_DELIMITER = "&@!&"


def delimiter_of(word: str | None) -> str:
    """A delimiter given by word, by escape or as it is."""
    if not word:
        return DEFAULT_DELIMITER
    if word.lower() in DELIMITER_WORDS:
        return DELIMITER_WORDS[word.lower()]
    return decode_escapes(word).decode("utf-8") if "\\" in word else word


# Fragments of a database message and the plain reason each stands for.
MESSAGE_REASONS = [
    ("RDBMS failure, 3523", "The user does not have SELECT access"),
    ("RDBMS failure, 3707", "Syntax error detected in the statement"),
    ("RDBMS failure, 2507: Out of spool space on disk.", "Out of spool space on disk"),
]

# Export return codes and their plain reason.
CODE_REASONS = [
    (4, "Warning"),
    (8, "User error"),
    (12, "Fatal error"),
    (16, "No Message Destination"),
]


def error_classify(message: Column, code: Column) -> Column:
    """Plain reason for a message, else for its return code, else NULL."""
    reason = F.lit(None).cast("string")
    for number, text in reversed(CODE_REASONS):
        reason = F.when(code == number, F.lit(text)).otherwise(reason)
    for fragment, text in reversed(MESSAGE_REASONS):
        reason = F.when(F.contains(message, F.lit(fragment)), F.lit(text)).otherwise(reason)
    return reason


# Marker, target schema and the prefix to strip for the source schema.
SCHEMA_RULES = [
    ("sample1", "sample", "sample1_"),
    ("sample", "sample", "sample_"),
]


def logical_schema(c: Column, env_prefix: str = "", rules=None) -> Column:
    """Struct (target, source) of schema names for a database key."""
    target, source = c, c
    for marker, schema, strip in reversed(SCHEMA_RULES if rules is None else rules):
        hit = F.contains(c, F.lit(marker))
        target = F.when(hit, F.lit(schema)).otherwise(target)
        source = F.when(hit, F.replace(c, F.lit(strip), F.lit(""))).otherwise(source)
    return F.struct(F.concat(F.lit(env_prefix), target).alias("target"), source.alias("source"))


def parse_list(c: Column, delimiter: str = ",", trim: bool = False) -> Column:
    """Delimited text as an array; empty or NULL text gives an empty array."""
    items = split_literal(c, delimiter)
    if trim:
        items = F.transform(items, lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    empty = F.array().cast("array<string>")
    return F.when(c.isNull() | (c == ""), empty).otherwise(items)


def parse_mapping(c: Column, delimiter: str = ",", trim: bool = False) -> Column:
    """``k1:v1,k2:v2`` as a map.  The last ``:`` of an item splits it, a later equal
    key wins, and an item without ``:`` raises."""
    def entry(item):
        value = F.substring_index(item, ":", -1)
        key = F.left(item, F.length(item) - F.length(value) - 1)
        if trim:
            key = F.regexp_replace(key, r"^\s+|\s+$", "")
            value = F.regexp_replace(value, r"^\s+|\s+$", "")
        bad = F.raise_error(F.concat(F.lit("no ':' in mapping item: "), item)).cast("string")
        key = F.when(F.contains(item, F.lit(":")), key).otherwise(bad)
        return F.struct(key.alias("key"), value.alias("value"))

    entries = F.transform(split_literal(c, delimiter), entry)
    last_wins = F.filter(
        F.transform(entries, lambda e, i: F.struct(e.alias("e"), i.alias("i"))),
        lambda x: ~F.exists(
            F.slice(entries, x["i"] + 2, F.size(entries)),
            lambda later: later["key"] == x["e"]["key"],
        ),
    )
    empty = F.create_map().cast("map<string,string>")
    return F.when(c.isNull() | (c == ""), empty).otherwise(
        F.map_from_entries(F.transform(last_wins, lambda x: x["e"]))
    )
