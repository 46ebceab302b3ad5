"""Text projections: keys, padded codes, comparable text, formatting."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _plain_letters() -> tuple[str, str]:
    """Letters whose compatibility decomposition is one plain letter, by rule."""
    marked, plain = [], []
    for start, end in ((0x00A0, 0x0250), (0x1E00, 0x1F00)):
        for point in range(start, end):
            base = "".join(c for c in unicodedata.normalize("NFKD", chr(point))
                           if not unicodedata.combining(c))
            if len(base) == 1 and base != chr(point):
                marked.append(chr(point))
                plain.append(base)
    return "".join(marked), "".join(plain)


_MARKED, _PLAIN = _plain_letters()


def unaccented(c: Column) -> Column:
    """Upper case, trimmed, without accents: the stored comparison key."""
    stripped = F.btrim(c, F.lit(" \t\n\r\f\v"))
    return F.regexp_replace(F.translate(F.upper(stripped), _MARKED, _PLAIN), r"\p{M}", "")


def comparable(c: Column) -> Column:
    """`unaccented`, with everything but letters and digits turned into single spaces."""
    spaced = F.regexp_replace(unaccented(F.coalesce(c, F.lit(""))), "[^A-Z0-9 ]", " ")
    return F.trim(F.regexp_replace(spaced, " +", " "))


def pad_code(c: Column, width: int = 5) -> Column:
    """Zero-padded code; longer codes are kept whole (lpad alone would cut them)."""
    code = F.trim(c)
    return F.when(F.length(code) < width, F.lpad(code, width, "0")).otherwise(code)


def place_key(state: Column, municipality: Column, zone: Column, place: Column) -> Column:
    """`UF_MUNICIPALITY_ZONE_PLACE`; null when any part is null."""
    return F.concat(F.trim(state), F.lit("_"), pad_code(municipality), F.lit("_"),
                    F.trim(zone).cast("int").cast("string"), F.lit("_"),
                    F.trim(place).cast("int").cast("string"))


def key_part(c: Column, i: int) -> Column:
    return F.split(c, "_")[i]


def round_text(c: Column) -> Column:
    """Election round as trimmed text, whatever type the source gave it."""
    return F.trim(c.cast("string"))


def title_case(c: Column) -> Column:
    """Capital after any non-letter, so apostrophes and hyphens start a word too."""
    pieces = F.split(F.lower(c), r"(?<=[^\p{L}])")
    return F.array_join(F.transform(
        pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))), "")


def street_name(kind: Column, title: Column, name: Column) -> Column:
    """One spaced upper-case name from the three parts of the address file."""
    parts = [F.trim(F.coalesce(p, F.lit(""))) for p in (kind, title, name)]
    return F.upper(F.trim(F.regexp_replace(F.concat_ws(" ", *parts), r"\s+", " ")))


def locality(c: Column) -> Column:
    return F.upper(F.trim(F.coalesce(c, F.lit(""))))


def office_slug(c: Column) -> Column:
    return F.lower(F.replace(c, F.lit(" "), F.lit("_")))


def contains_text(c: Column, term: str) -> Column:
    """Accent and case blind substring test; terms under two characters match nothing."""
    needle = "".join(ch for ch in unicodedata.normalize("NFKD", term.strip().upper())
                     if not unicodedata.combining(ch))
    if len(needle) < 2:
        return F.lit(False)
    return F.coalesce(unaccented(c).contains(needle), F.lit(False))


def number_br(c: Column, decimals: int = 0) -> Column:
    """1234567.8 -> 1.234.567,8"""
    return F.translate(F.format_number(c, decimals), ",.", ".,")


def percent_br(c: Column) -> Column:
    return F.concat(number_br(c, 1), F.lit("%"))
