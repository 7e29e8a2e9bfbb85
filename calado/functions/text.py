"""Column functions on text, labels and numbers in text."""

from __future__ import annotations

import html.entities
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

def _folded_letters() -> dict[str, str]:
    """Characters of the Latin, Greek, Cyrillic, ligature and full-width blocks that change when compatibility forms are decomposed, marks removed
    and case folded, with what becomes of them."""
    found = {}
    for code in [*range(0xA0, 0x530), *range(0x1E00, 0x2000), *range(0x2000, 0x20A0), *range(0x2100, 0x2190), *range(0x2460, 0x2474), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)]:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code).lower()) if not unicodedata.combining(c)).casefold()
        if plain and plain != chr(code):
            found[chr(code)] = plain
    return found


_FOLDED = _folded_letters()
_MARKED, _PLAIN = ("".join(x) for x in zip(*((k, v) for k, v in _FOLDED.items() if len(v) == 1), strict=True))
_LONGER = {k: v for k, v in _FOLDED.items() if len(v) > 1 and not k.isspace()}
# What stands for a missing value in producer tables.
MARKERS = ["", "-", "--", ":", "..", "...", "x", "n/a", "na", "nd", "s", "c", "*"]


def fold(text: Column) -> Column:
    """Case folded without accents (F01): composed and combining marks go, full-width and other compatibility forms become plain, ligatures and
    ß their letters."""
    plain = F.regexp_replace(F.translate(F.lower(text), _MARKED, _PLAIN), r"[\u0300-\u036f]", "")
    longer = F.map_from_arrays(F.lit(list(_LONGER)), F.lit(list(_LONGER.values())))
    found = F.filter(F.array_distinct(F.regexp_extract_all(plain, F.lit(r"([^\x00-\x7f])"), 1)), lambda c: F.map_contains_key(longer, c))
    return F.when(plain.rlike(r"[^\x00-\x7f]"), F.aggregate(found, plain, lambda t, c: F.replace(t, c, F.try_element_at(longer, c)))).otherwise(plain)


def norm_label(text: Column) -> Column:
    """Folded label with dashes of any length, underscores and runs of blanks as one blank."""
    return F.trim(F.regexp_replace(fold(text), r"[-\u2010-\u2015\u2212_\s]+", " "))


def _named_characters() -> Column:
    names = sorted(html.entities.name2codepoint)
    return F.map_from_arrays(F.lit([f"&{name};" for name in names]), F.lit([chr(html.entities.name2codepoint[name]) for name in names]))


def unescape(text: Column) -> Column:
    """Text with HTML's character references decoded, by name or number; unknown ones stay."""
    number = lambda r: F.when(r.rlike("(?i)^&#x"), F.conv(F.regexp_extract(r, "(?i)^&#x([0-9a-f]+)", 1), 16, 10)).otherwise(F.regexp_extract(r, "^&#([0-9]+)", 1)).cast("bigint")
    code = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    valid = lambda n: ((n > 0) & (n < 0xD800)) | ((n > 0xDFFF) & (n < 0x110000))
    named = _named_characters()
    one = lambda r: F.when(r.startswith("&#"), F.when(valid(number(r)), code(number(r)))).otherwise(F.try_element_at(named, r))
    references = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);)"), 1))
    pairs = F.transform(references, lambda r: F.struct(r.alias("r"), F.coalesce(one(r), r).alias("c")))
    # References to & come last, so that what they give is not read again.
    ordered = F.concat(F.filter(pairs, lambda p: p["c"] != "&"), F.filter(pairs, lambda p: p["c"] == "&"))
    return F.when(F.contains(text, F.lit("&")), F.aggregate(ordered, text, lambda t, p: F.replace(t, p["r"], p["c"]))).otherwise(text)


def parse_num(text: Column) -> Column:
    """A number in either locale; markers and anything else give null.

    With both separators the last is the decimal one. Commas alone are for thousands if three digits follow the last, else
    decimal; one dot alone is decimal, several between groups of three digits are for thousands. Any blank may part thousands, and a minus
    sign is as good as a hyphen.
    """
    t = F.regexp_replace(F.translate(F.trim(text), "\u2212\u2013", "--"), r"[\s\u00a0\u2007\u2009\u202f%€]", "")
    sign, groups = r"^[+-]?", r"\d{1,3}(?:[.]\d{3})+"
    no_dots, no_commas = F.regexp_replace(t, r"\.", ""), F.regexp_replace(t, ",", "")
    number = (
        F.when(F.lower(t).isin(MARKERS), None)
        .when(t.rlike(sign + groups + r",\d+$"), F.regexp_replace(no_dots, ",", "."))
        .when(t.rlike(sign + groups.replace("[.]", ",") + r"\.\d+$"), no_commas)
        .when(t.rlike(sign + r"\d+(?:,\d+)*,\d{3}$"), no_commas)
        .when(t.rlike(sign + r"\d+,\d+$"), F.regexp_replace(t, ",", "."))
        .when(t.rlike(sign + r"\d{1,3}(?:\.\d{3}){2,}$"), no_dots)
        .when(t.rlike(sign + r"\d+(\.\d+)?$"), t)
    )
    return number.try_cast("double")


#: A number as written in a text.
NUMBER = r"[+-]?\d+(?:[.,]\d+)*"


def num_tokens(text: Column) -> Column:
    """Numbers in a text, as written."""
    return F.regexp_extract_all(text, F.lit(f"({NUMBER})"), 1)


# Units that are looked for.
UNITS = ["%", "€", "eur", "km", "m", "t", "kg", "mw", "min"]


def unit_tokens(text: Column) -> Column:
    """Units that directly follow a number."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\d\s?(%|€|eur|km|kg|mw|min|m|t)(?![a-z])"), 1)


def _quarter(text: Column) -> Column:
    """The quarter's digit of forms as '3º trimestre', 'Q3', '2021T3', '3T'; null without one. A letter before q or t makes another word."""
    t = fold(text)
    forms = [r"(?<!\d)([1-4])\s*\.?\s*(?:o|a|st|nd|rd|th)?\s*trim(?:estre)?(?![a-z])", r"(?<![a-z])(?:q|t|trim|trimestre)[-_ ]?([1-4])(?!\d)", r"(?<![a-z0-9])([1-4])[tq](?![a-z])"]
    return F.coalesce(*[F.nullif(F.regexp_extract(t, f, 1), F.lit("")) for f in forms])


def parse_period(text: Column) -> Column:
    """'2021', '2021Q3' or '2021-05' of a label or file name; null without a year."""
    year = F.nullif(F.regexp_extract(text, r"((?:19|20)\d{2})", 1), F.lit(""))
    quarter = _quarter(text)
    month = F.nullif(F.regexp_extract(text, r"(?:19|20)\d{2}[-_ ]?(0[1-9]|1[0-2])(?!\d)", 1), F.lit(""))
    return F.when(quarter.isNotNull(), F.concat(year, F.lit("Q"), quarter)).when(month.isNotNull(), F.concat(year, F.lit("-"), month)).otherwise(year)


def edition_scope(text: Column) -> Column:
    """'Q1' to 'Q4', 'ANNUAL' for a year without a word for quarters, else 'UNRESOLVED' (F04)."""
    quarter, year = _quarter(text), text.rlike(r"(?:19|20)\d{2}")
    return F.when(quarter.isNotNull(), F.concat(F.lit("Q"), quarter)).when(year & ~F.contains(fold(text), F.lit("trimestre")), "ANNUAL").otherwise("UNRESOLVED")


def is_road_code(text: Column) -> Column:
    """Whether a label is a road's code, as A4, IC 19, N-103."""
    return F.upper(F.trim(text)).rlike(r"^(A|IP|IC|EN|N|E|ER|M)[ -]?\d{1,3}([- ]\d{1,2})?$")


def safe_name(text: Column) -> Column:
    """A file name: other characters become one underscore."""
    return F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_"), r"^[._]+|[._]+$", "")


def json_pointer(*steps: Column) -> Column:
    """A pointer of steps, with ~ and / escaped."""
    return F.concat(*[F.concat(F.lit("/"), F.replace(F.replace(s, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))) for s in steps])


def typed_cell(raw: Column, code: Column) -> Column:
    """(type, value) of a workbook cell by its code: 0 blank, 1 text, 2 number, 3 date serial, 4 boolean, 5 error."""
    kind = F.when(code == 0, "blank").when(code == 1, "text").when(code == 2, "number").when(code == 3, "date").when(code == 4, "boolean").otherwise("error")
    date = F.date_format(F.date_add(F.lit("1899-12-30").cast("date"), F.floor(raw.try_cast("double")).cast("int")), "yyyy-MM-dd")
    value = F.when(code == 0, None).when(code == 3, date).when(code == 4, F.when(raw == "1", "true").otherwise("false")).otherwise(raw)
    return F.struct(kind.alias("type"), value.alias("value"))


def canon_hash(*columns: Column) -> Column:
    """SHA-256 of columns as text, apart by U+001F; a null is U+2400."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("␀")) for c in columns]), 256)


def blob_digest(text: Column) -> Column:
    """SHA-1 of 'blob', length and content, as version control names a file."""
    return F.sha1(F.concat(F.encode(F.concat(F.lit("blob "), F.octet_length(text).cast("string")), "UTF-8"), F.unhex(F.lit("00")), F.encode(text, "UTF-8")))


def first_label(values: Column, names: list[str], codes: list[str]) -> Column:
    """The first filled name-like key of a map, else the first code-like key, else '(unknown)' (F19)."""
    filled = [F.nullif(F.trim(F.try_element_at(values, F.lit(k))), F.lit("")) for k in [*names, *codes]]
    return F.coalesce(*filled, F.lit("(unknown)"))


def scalarish(value: Column) -> Column:
    """Numbers, texts and booleans as text; objects and arrays as compact JSON."""
    return value.cast("string")


def compact(value: Column) -> Column:
    """(type, bytes, sha256, keys) of a nested value as JSON text, in place of the value: array, object, text, number, boolean or null; keys of an
    object joined by a bar; null stays null (F06)."""
    head = F.substring(F.ltrim(value), 1, 1)
    kind = F.when(head == "{", "object").when(head == "[", "array").when(head == '"', "text").when(F.trim(value).isin("true", "false"), "boolean").when(F.trim(value) == "null", "null").otherwise("number")
    keys = F.array_join(F.json_object_keys(value), "|")
    return F.when(value.isNotNull(), F.struct(kind.alias("type"), F.octet_length(value).cast("long").alias("bytes"), F.sha2(value, 256).alias("sha256"), keys.alias("keys")))


def match_member(code: Column, allowed: Column, part: Column, strict: bool = False) -> Column:
    """A returned code that is among the array ``allowed``; else the only allowed label that holds the label ``part`` or is held by it; else
    ``filter_ignored``, or with ``strict`` an error, as the producer then gave what was not asked for (F08)."""
    near = F.filter(allowed, lambda x: F.contains(x, part) | ((x != "") & F.contains(part, x)))
    ignored = F.raise_error(F.concat(F.lit("the filter was ignored: "), F.coalesce(code.cast("string"), F.lit("null")))).cast("string") if strict else F.lit("filter_ignored")
    return F.when(F.array_contains(allowed, code), code).when(F.size(near) == 1, F.get(near, F.lit(0))).otherwise(ignored)
