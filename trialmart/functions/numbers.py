"""Counts, ratios and number labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trialmart.functions.text import WHITESPACE, strip_text


def parse_count(text: Column) -> Column:
    """Whole number from text with optional thousands commas; anything else is NULL."""
    digits = F.regexp_replace(strip_text(F.replace(text, F.lit(","), F.lit(""))), r"(?<=\d)_(?=\d)", "")
    return F.when(digits.rlike(r"^[+-]?\d+$"), digits.try_cast("int"))


def variant_count(v: Column) -> Column:
    """Whole number from a JSON value: text as in parse_count, numbers cut at the point."""
    kind = F.schema_of_variant(v)
    number = F.try_variant_get(v, "$", "double")
    return (
        F.when(kind == "STRING", parse_count(F.try_variant_get(v, "$", "string")))
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("int"))
        .otherwise(F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).try_cast("int"))
    )


def phase_number(c: Column) -> Column:
    """First number that follows the word 'phase'."""
    found = F.regexp_extract(c, rf"(?iU)phase{WHITESPACE}*([0-9]+)", 1)
    return F.nullif(found, F.lit("")).try_cast("int")


# Fixed values in it: the size bands.
def categorize_enrollment(n: Column) -> Column:
    return (
        F.when(n.isNull() | (n <= 0), "Unknown")
        .when(n <= 50, "Small (≤50)")
        .when(n <= 200, "Medium (51-200)")
        .when(n <= 1000, "Large (201-1000)")
        .otherwise("Very Large (>1000)")
    )


def safe_divide(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """Quotient, or the default when it is undefined."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(float(default))
    )


def share(part: Column, whole: Column) -> Column:
    """Percentage with two decimals, NULL for an empty whole."""
    return F.round(F.try_divide(part * F.lit(100.0), whole.cast("double")), 2)


def round_even(c: Column, digits: int) -> Column:
    return F.bround(c.cast("double"), digits)


def number_label(c: Column, kind: str = "comma", missing: str = "N/A", whole: bool = False) -> Column:
    """Display text for a number: 'comma', 'percent' or 'currency'; other kinds print it plainly.

    A comma label shows all digits of a fractional number; `whole` says the column is integral.
    """
    if kind == "comma" and whole:
        shown = F.format_number(c, 0)
    elif kind == "comma":
        exact = F.abs(c).try_cast("decimal(38,18)").cast("string")
        fraction = F.regexp_replace(F.substring_index(exact, ".", -1), r"(?<=\d)0+$", "")
        thousands = F.format_number(F.substring_index(exact, ".", 1).try_cast("decimal(20,0)"), 0)
        split = F.concat(F.when(c < 0, "-").otherwise(""), thousands, F.lit("."), fraction)
        shown = F.coalesce(split, c.cast("string"))  # beyond 20 digits a number is shown plainly
    elif kind == "percent":
        # format_string prints a NULL argument as text, hence the guard.
        shown = F.when(c.isNotNull(), F.format_string("%.1f%%", F.bround(c.cast("double"), 1)))
    elif kind == "currency":
        shown = F.concat(F.lit("$"), F.format_number(F.bround(c.cast("double"), 2), 2))
    else:
        shown = c.cast("string")
    return F.coalesce(shown, F.lit(missing))
