"""Text clean-up, hashing and pattern checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as whitespace, for patterns that begin with (?U): with that flag \s covers
# no-break and other Unicode spaces, and \x1c-\x1f are separators it leaves out.
WHITESPACE = r"[\s\x1c-\x1f]"
_WS_RUN = rf"(?U){WHITESPACE}+"
# The look-behind lets a trailing run match only from its first character, which keeps
# the scan linear on texts with long inner runs.
_WS_ENDS = rf"(?U)^{WHITESPACE}+|(?<!{WHITESPACE}){WHITESPACE}+$"
_INK = r"(?U)[^\s\x1c-\x1f]"
_WORD = r"[\p{L}\p{N}_]"

# Sponsor name spellings, replaced in this order.
SPONSOR_SPELLINGS = {
    "inc": "Inc.",
    "corp": "Corp.",
    "llc": "LLC",
    "ltd": "Ltd.",
    "co": "Co.",
    "university": "University",
    "univ": "University",
    "medical center": "Medical Center",
    "med center": "Medical Center",
    "hospital": "Hospital",
    "hosp": "Hospital",
}

# Fixed value: accepted e-mail form.
EMAIL_FORM = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def clean_string(c: Column) -> Column:
    """Collapse whitespace runs to one space, trim, and turn empty text into NULL."""
    return F.nullif(F.trim(F.regexp_replace(c, _WS_RUN, " ")), F.lit(""))


def strip_text(c: Column) -> Column:
    """Trim all whitespace at both ends; empty text becomes NULL."""
    return F.nullif(F.regexp_replace(c, _WS_ENDS, ""), F.lit(""))


def has_text(c: Column) -> Column:
    """Whether strip_text leaves anything, found at the first character that it would keep; NULL for NULL."""
    return c.rlike(_INK)


def split_location(c: Column) -> Column:
    """Struct (city, state, country) from 'City, State, Country' or a shorter form.

    Text with a zero-length part, or with more than three parts, is kept whole as the city.
    """

    def read(place: Column) -> Column:
        return _bind(F.split(place, ",", -1), lambda parts: _place_fields(place, parts))

    return _bind(clean_string(c), read)


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` applied to a value that is computed once, however often it is named in there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _place_fields(place: Column, parts: Column) -> Column:
    well_formed = ~F.exists(parts, lambda p: p == "")
    listed = well_formed & F.size(parts).isin(2, 3)
    return F.struct(
        F.when(listed, clean_string(F.get(parts, F.lit(0)))).otherwise(place).alias("city"),
        F.when(listed, clean_string(F.get(parts, F.lit(1)))).alias("state"),
        F.when(well_formed & (F.size(parts) == 3), clean_string(F.get(parts, F.lit(2)))).alias("country"),
    )


def normalize_sponsor_name(c: Column) -> Column:
    """Clean the name, then apply the spelling table as whole-word replacements.

    The word comes before the checks of its neighbours in the pattern, so the scan moves on
    at the first letter that differs.
    """
    name = clean_string(c)
    for old, new in SPONSOR_SPELLINGS.items():
        name = F.regexp_replace(name, rf"(?iu){old}(?<!{_WORD}{old})(?!{_WORD})", new)
    return name


def hash_key(*cols: Column) -> Column:
    """md5 of the non-null values joined with a pipe."""
    return F.md5(F.concat_ws("|", *cols))


def valid_email(c: Column) -> Column:
    return F.coalesce(c.rlike(EMAIL_FORM), F.lit(False))


def contains_any(c: Column, words: list[str]) -> Column:
    """True when the lower-cased text holds one of the words; NULL text stays NULL."""
    lowered = F.lower(c)
    found = lowered.contains(words[0])
    for word in words[1:]:
        found = found | lowered.contains(word)
    return found


def or_unknown(c: Column, label: str = "Unknown") -> Column:
    """NULL or empty text becomes the label, any other text is trimmed of spaces."""
    return F.when(c.isNull() | (c == ""), F.lit(label)).otherwise(F.trim(c))


def trim_or_null(c: Column) -> Column:
    """NULL or empty text becomes NULL, any other text is trimmed of spaces."""
    return F.when(c != "", F.trim(c))
