"""Text predicates and numbers written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_fields(line: Column, n: int, sep: str = ",") -> Column:
    """True for a line that is not blank and has exactly ``n`` fields."""
    return (F.length(F.trim(line)) > 0) & (F.size(split_on(line, sep)) == n)


def split_on(line: Column, sep: str) -> Column:
    """Fields between plain separators, trailing empty ones included."""
    return F.split(line, f"\\Q{sep}\\E", -1)


def grouped_number(text: Column) -> Column:
    """``"1,170"``, with or without quotes, as 1170; null when it is no whole number."""
    return F.regexp_replace(text, '[",]', "").try_cast("bigint")


def is_number(text: Column) -> Column:
    """Whether the text reads as a number; Java's own suffixes and hex forms do not count."""
    java_only = text.rlike(r"(?i)[0-9.][df]\s*$|^\s*[+-]?0x")
    return text.try_cast("double").isNotNull() & ~java_only


def without_trailing_dot(text: Column) -> Column:
    return F.regexp_replace(text, r"\.$", "")


#: What would end a line or a tab-separated field, and its code; the backslash comes first.
_CODES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"), ("\0", "\\0"))
#: Stands for null. No coded text is equal to it, since codes double every backslash.
NULL_MARK = "\\N"


def coded(text: Column) -> Column:
    """The text on one line without tabs; ``decoded`` gives it back."""
    for plain, code in _CODES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def decoded(text: Column) -> Column:
    """The text behind ``coded``. A coded text holds no NUL, so one marks the real backslashes."""
    text = F.replace(text, F.lit("\\\\"), F.lit("\0"))
    parts = F.split(text, "\0", -1)
    back = _CODES[1:]

    def one(part: Column) -> Column:
        for plain, code in back:
            part = F.replace(part, F.lit(code), F.lit(plain))
        return part

    return F.array_join(F.transform(parts, one), "\\")
