"""Text of the market-data provider: digits, symbols, dates of the Jalali calendar, times, codes and keys."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Persian and Arabic-Indic digits, and the letters that are written as one.
PERSIAN_DIGITS, ARABIC_DIGITS, DIGITS = "۰۱۲۳۴۵۶۷۸۹", "٠١٢٣٤٥٦٧٨٩", "0123456789"
LETTERS, LETTERS_AS = "يىك", "ییک"
# Years of a 33-year cycle that have 366 days.
LEAP_OF_33 = (1, 5, 9, 13, 17, 22, 26, 30)
#: The first day of the Jalali year 1.
FIRST_DAY = "0622-03-21"


@lru_cache
def composed_to(wanted: str) -> tuple[str, str]:
    """All single characters whose compatibility composition is one other character of wanted, and those characters."""
    pairs = [(chr(c), unicodedata.normalize("NFKC", chr(c))) for c in range(0x80, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    kept = [(c, to) for c, to in pairs if len(to) == 1 and to in wanted and c != to]
    return "".join(c for c, _ in kept), "".join(to for _, to in kept)


def compatible(c: Column, wanted: str) -> Column:
    """c with every character that composes to one of wanted written as that one; the rest stays."""
    return F.translate(c, *composed_to(wanted))


def normalize_digits(c: Column) -> Column:
    return F.translate(c, PERSIAN_DIGITS + ARABIC_DIGITS, DIGITS + DIGITS)


def clean_number(c: Column, more: str) -> Column:
    """Digits of any width or script, and the characters more, as ASCII; trimmed."""
    return F.trim(normalize_digits(compatible(c, PERSIAN_DIGITS + ARABIC_DIGITS + DIGITS + more + " ")))


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility composition; Spark has no built-in for it."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x), na_action="ignore")


def normalize_symbol(c: Column) -> Column:
    """Composition, Persian letters and Western digits, single blanks, trimmed; leading zeros stay."""
    s = normalize_digits(F.translate(nfkc(c), LETTERS, LETTERS_AS))
    return F.regexp_replace(F.regexp_replace(s, r"(?U)\s+", " "), "^ | $", "")


def normalize_symbol_text(value: str) -> str:
    """normalize_symbol for one value, on the driver."""
    western = {**dict(zip(LETTERS, LETTERS_AS)), **{c: str(i) for digits in (PERSIAN_DIGITS, ARABIC_DIGITS) for i, c in enumerate(digits)}}
    return " ".join("".join(western.get(c, c) for c in unicodedata.normalize("NFKC", value)).split())


def days_before(year: Column) -> Column:
    """Days from the first day of the Jalali year 1 to that of another: 12053 in each 33 years, 365 and its leap day in each of a cycle."""
    cycle, rest = F.floor((year - 1) / 33), F.pmod(year - 1, F.lit(33))
    leaps = F.size(F.filter(F.array(*map(F.lit, LEAP_OF_33)), lambda leap: leap <= rest))
    return 12053 * cycle + 365 * rest + leaps


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def jalali_date(c: Column) -> Column:
    """YYYY-MM-DD or YYYY/MM/DD of the Jalali calendar as a date; null where it is none."""

    def day(s: Column) -> Column:
        fits = s.rlike(r"^\d{4}([-/])\d{2}\1\d{2}$")
        return let(F.when(fits, F.transform(F.split(s, "[-/]"), lambda x: x.try_cast("int"))), lambda p: of(p[0], p[1], p[2]))

    def of(y: Column, m: Column, d: Column) -> Column:
        longest = F.when(m <= 6, 31).when((m <= 11) | F.pmod(y, F.lit(33)).isin(*LEAP_OF_33), 30).otherwise(29)
        days = days_before(y) + 30 * (m - 1) + F.least(m - 1, F.lit(6)) + d - 1
        return F.when((y >= 1) & m.between(1, 12) & d.between(1, longest), F.date_add(F.lit(FIRST_DAY).cast("date"), days.cast("int")))

    return let(clean_number(c, "-/"), day)


def source_time(c: Column) -> Column:
    """HH:MM or HH:MM:SS as seconds of the day; null where it is neither."""

    def seconds(s: Column) -> Column:
        fits = s.rlike(r"^\d{2}:\d{2}(:\d{2})?$")
        return let(F.when(fits, F.transform(F.split(s, ":"), lambda x: x.try_cast("int"))), lambda p: of(p[0], p[1], F.coalesce(F.get(p, 2), F.lit(0))))

    def of(h: Column, m: Column, sec: Column) -> Column:
        return F.when((h <= 23) & (m <= 59) & (sec <= 59), h * 3600 + m * 60 + sec)

    return let(clean_number(c, ":"), seconds)


def normalize_isin(c: Column) -> Column:
    """Upper case, by structure only (no check digit); null where it does not fit."""
    s = F.upper(F.trim(normalize_digits(c)))
    return F.when(s.rlike(r"^[A-Z]{2}[A-Z0-9]{9}[0-9]$"), s)


def record_key(symbol: Column, day: Column) -> Column:
    return F.concat_ws("|", F.lit("brsapi"), F.lit("candlestick"), F.lit("type=2"), symbol, F.coalesce(day, F.lit("unknown-date")))


_KEY_PARAMETER = r"(?i)([?&]key=)[^&\s]*"


def redacted(c: Column, most: int = 512) -> Column:
    """The values of key parameters hidden, and cut to a bounded length."""
    return F.substring(F.regexp_replace(c, _KEY_PARAMETER, "$1***"), 1, most)


def redacted_text(value: str, most: int = 512) -> str:
    """redacted() of one text."""
    return re.sub(_KEY_PARAMETER, r"\1***", value)[:most]


def is_safe_identifier(value: str) -> bool:
    """Usable as a file name: no leading dot, no parent."""
    return bool(re.fullmatch(r"[A-Za-z0-9_][A-Za-z0-9._-]{0,127}", value)) and ".." not in value
