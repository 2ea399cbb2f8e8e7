"""Column expressions that turn published text into typed values. Bad input gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wattfold.config import DATE_FORMAT, SENTINELS, TIMESTAMP_FORMAT

_STRICT_TIMESTAMP = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?$"


def is_sentinel(text: Column, sentinels=SENTINELS) -> Column:
    """True for a no-value text. A lookup in one constant array keeps the generated code of wide tables small."""
    return F.array_contains(F.array(*[F.lit(s) for s in sentinels]), text)


def clean_text(c, sentinels=SENTINELS, trimmed=False) -> Column:
    """Trimmed text, NULL where the trimmed text is one of the no-value texts."""
    text = _as_col(c) if trimmed else F.trim(_as_col(c))
    return F.when(~is_sentinel(text, sentinels), text)


def clean_decimal(c, sentinels=SENTINELS, decimal=".", trimmed=False) -> Column:
    """Double from text. Commas are thousands separators unless ``decimal=","``.

    Only digits with an optional sign, point and exponent are read: NaN, infinities and type suffixes count as unreadable.
    """
    text = clean_text(c, sentinels, trimmed)
    if decimal == ",":
        text = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    else:
        text = F.replace(text, F.lit(","), F.lit(""))
    return F.when(text.rlike(_NUMBER), text).try_cast("double")


def clean_int(c, sentinels=SENTINELS, decimal=".", trimmed=False) -> Column:
    """Integer part of a cleaned decimal."""
    return clean_decimal(c, sentinels, decimal, trimmed).try_cast("int")


def clean_timestamp(c, fmt=TIMESTAMP_FORMAT, sentinels=SENTINELS, trimmed=False) -> Column:
    """Wall-clock timestamp (TIMESTAMP_NTZ), so the session time zone never moves or drops a local hour."""
    text = clean_text(c, sentinels, trimmed)
    if fmt == TIMESTAMP_FORMAT:
        return F.when(text.rlike(_STRICT_TIMESTAMP), text).try_cast("timestamp_ntz")
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


def clean_date(c, fmt=DATE_FORMAT, sentinels=SENTINELS, trimmed=False) -> Column:
    return F.try_to_date(clean_text(c, sentinels, trimmed), fmt)


def visible_null(c, label="<nulo>", trim=True) -> Column:
    """A label in place of NULL, so that missing values form a visible group."""
    return F.coalesce(F.trim(_as_col(c)) if trim else _as_col(c), F.lit(label))


def has_newline(c) -> Column:
    return _as_col(c).contains("\n")


def collapse_whitespace(c, width=None) -> Column:
    """Every run of white space as one space; optionally only the first ``width`` characters."""
    text = F.regexp_replace(_as_col(c), r"\s+", " ")
    return text if width is None else F.substring(text, 1, width)


CLEANERS = {
    "text": clean_text,
    "decimal": clean_decimal,
    "int": clean_int,
    "timestamp": clean_timestamp,
    "date": clean_date,
}
