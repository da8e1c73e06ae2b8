"""Column functions that normalise single values. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from callweave.specs import TIME_FORMAT, UNKNOWN

# Spellings of true and false, and the characters that count as blank.
TRUE_WORDS = ("true", "t", "yes", "y", "1")
FALSE_WORDS = ("false", "f", "no", "n", "0")
PUBLISHED_TRUE_WORDS = ("true", "t", "1", "yes")
BLANKS = " \t\n\r\x0b\x0c"

_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_FIRST_SECOND, _LAST_SECOND = -62135596800, 253402300799  # years 1 to 9999


def strip(c: Column) -> Column:
    """Cut blanks of every kind from both ends (``trim`` alone cuts spaces only)."""
    return F.trim(c, F.lit(BLANKS))


def blank_to_null(c: Column, none_word: str | None = None) -> Column:
    """Empty text is null; so is ``none_word`` (XML files write ``None``)."""
    empty = c == ""
    return F.when(~(empty | (c == none_word)) if none_word else ~empty, c)


def parsed_time(c: Column) -> Column:
    """Text in any accepted form as a timestamp, other text null.

    Day-first wins over month-first, an ISO ``Z`` does not shift, numbers are
    epoch seconds. The shape of the text picks the one format that can match:
    a failed parse throws inside the JVM and costs several times a good one.
    """
    v = strip(c)
    one_space = F.when(v.rlike(r"\s\s|[\t\n\r]"), F.regexp_replace(v, r"\s+", " ")).otherwise(v)
    middle = F.substring_index(F.substring_index(v, "/", 2), "/", -1)
    seconds = v.try_cast("double")
    return (
        F.when(
            v.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s"),
            F.try_to_timestamp(one_space, F.lit("yyyy-M-d H:m:s")),
        )
        .when(
            v.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\s"),
            F.when(
                middle.cast("int") <= 12, F.try_to_timestamp(one_space, F.lit("d/M/yyyy H:m:s"))
            ).otherwise(F.try_to_timestamp(one_space, F.lit("M/d/yyyy H:m:s"))),
        )
        .when(
            v.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[Tt]"),
            F.try_to_timestamp(v, F.lit("yyyy-M-d'T'H:m:s.SSSSSS'Z'")),
        )
        .when(
            v.rlike(_NUMBER),
            F.when(seconds.between(_FIRST_SECOND, _LAST_SECOND), seconds.try_cast("timestamp")),
        )
    )


def canonical_time(c: Column) -> Column:
    """Text in any accepted form as ``yyyy-MM-dd HH:mm:ss``; other text stays (stripped)."""
    return F.coalesce(F.date_format(parsed_time(c), TIME_FORMAT), strip(c))


def table_time(c: Column) -> Column:
    """What ``strict_time`` reads from ``canonical_time``, without the text between."""
    return F.date_trunc("second", parsed_time(c))


def canonical_flag(c: Column) -> Column:
    """Words and whole numbers as a boolean (any number but zero is true), else null."""
    v = F.lower(strip(c))
    return (
        F.when(v.isin(*TRUE_WORDS), True)
        .when(v.isin(*FALSE_WORDS), False)
        .when(v.rlike(r"^[+-]?[0-9]+$"), v.rlike("[1-9]"))
    )


def strict_time(c: Column) -> Column:
    """Text in the one canonical form as a timestamp, anything else null."""
    shaped = c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$")
    return F.when(shaped, F.try_to_timestamp(c, F.lit(TIME_FORMAT)))


def flag_or_false(c: Column) -> Column:
    """True for a true word as it stands (blanks not cut); null and all else false."""
    return F.coalesce(F.lower(c).isin(*TRUE_WORDS), F.lit(False))


def whole_number(c: Column, default: int | None = 0, cut_fraction: bool = True, kind: str = "int") -> Column:
    """Text as an integer of ``kind`` (``int`` or ``bigint``), ``default`` where it is none.

    ``cut_fraction`` reads ``443.9`` as 443, as Spark's non-ANSI cast does;
    otherwise only plain digits count.
    """
    number = c.try_cast(kind)
    if cut_fraction:
        digits = F.regexp_extract(c, r"^\s*([+-]?[0-9]*)[.][0-9]*\s*$", 1)
        bare = F.regexp_replace(digits, "^([+-]?)$", "0")
        number = F.coalesce(number, F.when(c.rlike(r"^\s*[+-]?([0-9]+[.][0-9]*|[.][0-9]+)\s*$"), bare.try_cast(kind)))
    return number if default is None else F.coalesce(number, F.lit(default))


def scrub_text(c: Column, default: str = UNKNOWN, fold_default: bool = False) -> Column:
    """Null, blank and ``nan`` text as ``default``; else lower case, outer quotes cut."""
    low = F.lower(c)
    missing = c.isNull() | (F.trim(c) == "") | low.isin("nan", '"nan"')
    bare = F.when(c.contains('"'), F.regexp_replace(low, '^"|"$', "")).otherwise(low)
    return F.when(missing, F.lit(default.lower() if fold_default else default)).otherwise(F.trim(bare))


def category(c: Column, valid: Sequence[str], fallback: str, match: str = "casefold") -> Column:
    """Lower-cased value if listed, else ``fallback`` (also for null).

    ``casefold`` compares without case. ``reference`` looks the lower-cased
    value up in the list as spelled, so entries with capitals never match.
    ``exact`` takes the value as it is.
    """
    if match == "casefold":
        value, listed = F.lower(c), [v.lower() for v in valid]
    elif match == "reference":
        value, listed = F.lower(c), list(valid)
    elif match == "exact":
        value, listed = c, list(valid)
    else:
        raise ValueError(f"unknown match mode {match!r}")
    return F.when(value.isin(*listed), value).otherwise(F.lit(fallback))


def published_text(c: Column) -> Column:
    """Lower case without outer blanks."""
    return strip(F.lower(c))


def published_flag(c: Column) -> Column:
    """True for the publisher's true words (``y`` is not one), null stays null."""
    return published_text(c).isin(*PUBLISHED_TRUE_WORDS)
