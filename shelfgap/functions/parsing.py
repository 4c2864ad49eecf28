"""Text to typed columns. Bad text becomes NULL; nothing raises, with ANSI mode on or off."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# A failed try_cast raises and catches an exception inside Spark, some 20 microseconds a row, so
# text that cannot be a number is told apart by its shape and never reaches the cast.
_BLANK = r"[\x00-\x20]*"  # what a cast to a number ignores at both ends
# More than 18 digits after leading zeros are no 32-bit integer, and might be none of 64 bits.
_WHOLE = rf"^{_BLANK}[+-]?0*[0-9]{{1,18}}{_BLANK}$"
_FRACTION = rf"^{_BLANK}([+-]?)(0*[0-9]{{0,18}})\.[0-9]*{_BLANK}$"
_FLOATING = (
    rf"^{_BLANK}[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]?{_BLANK}$"
    rf"|^{_BLANK}[+-]?(?i:nan|inf|infinity){_BLANK}$"
    rf"|^{_BLANK}[+-]?0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+[dDfF]?{_BLANK}$"
)
# A date at the start of the text; what follows the day is ignored.
_LEADING_DATE = r"(?s)^\s*0*([1-9]\d{0,3})-0*(\d{1,2})-0*(\d{1,2})(?!\d).*$"
_FAR_DATE = r"(?s)^\s*0*([1-9]\d{4,6})-0*(\d{1,2})-0*(\d{1,2})(?!\d).*$"
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def trimmed(text: Column) -> Column:
    """Without leading and trailing spaces; tabs stay, an all-space value becomes ''."""
    return F.trim(text)


def title_case(text: Column) -> Column:
    """Lower case with a capital after each space."""
    return F.initcap(text)


def canonical_label(text: Column, labels: Mapping[str, str]) -> Column:
    """The label whose upper-case key equals the text, else the text in title case."""
    if not labels:
        return title_case(text)
    known = F.create_map(*[F.lit(part) for entry in labels.items() for part in entry])
    return F.coalesce(F.try_element_at(known, F.upper(text)), title_case(text))


def to_int(text: Column) -> Column:
    """32-bit integer; a fraction is cut off (``12.7`` is 12), exponents and overflow are NULL."""
    cut = F.regexp_replace(text, _FRACTION, "$1" + "0$2")
    value = F.when(text.rlike(_WHOLE), text.try_cast("bigint")).when(
        text.rlike(_FRACTION), cut.try_cast("bigint")
    )
    return F.when(value.between(-(2**31), 2**31 - 1), value.cast("int"))


def to_double(text: Column) -> Column:
    return F.when(text.rlike(_FLOATING), text.try_cast("double"))


def to_day(text: Column, mode: str = "lenient") -> Column:
    """Year-month-day text as a date.

    ``lenient`` also takes unpadded parts, leading blanks and anything after the day;
    ``strict`` takes ``yyyy-MM-dd`` only.
    """
    if mode == "strict":
        return F.when(text.rlike(_ISO_DATE), text.try_cast("date"))
    if mode != "lenient":
        raise ValueError(f"date mode must be 'lenient' or 'strict', not {mode!r}")
    # A cast alone would also take a year or a year and month, and a sign.
    two_dashes = F.length(F.replace(text, F.lit("-"))) == F.length(text) - 2
    direct = F.when(two_dashes & ~text.contains("+"), text.try_cast("date"))
    # The regular expressions run only where the direct cast finds no date.
    leading = F.regexp_replace(text, _LEADING_DATE, "000$1-$2-$3").try_cast("date")
    far = F.regexp_replace(text, _FAR_DATE, "$1-$2-$3").try_cast("date")
    found = F.when(text.rlike(_LEADING_DATE), leading).when(text.rlike(_FAR_DATE), far)
    return F.coalesce(direct, found)


def filled(value: Column, default: int | float) -> Column:
    """NULL, and NaN in a double column, replaced by the default."""
    if isinstance(default, float):
        value = F.nanvl(value, F.lit(None).cast("double"))
    return F.coalesce(value, F.lit(default))
