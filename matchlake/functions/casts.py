"""Null-on-failure casts and the surrogate key.

Each function takes a column name and returns SQL expression text, so the same
definition serves the DataFrame plan (``F.expr``) and the published silver view.
"""

from __future__ import annotations

from collections.abc import Sequence

from matchlake.schemas import KEY_NULL_TEXT

# Four-digit year, one- or two-digit month and day, nothing around them.
DATE_SHAPE = r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\\z"


def safe_date(column: str) -> str:
    """DATE or NULL. A bare try_cast would also take '2024', times and blanks."""
    return f"CASE WHEN {column} RLIKE '{DATE_SHAPE}' THEN try_cast({column} AS DATE) END"


# The largest double below one half. Adding it and cutting off the fraction rounds half away
# from zero exactly, where adding 0.5 would carry 0.49999999999999994 up to 1.
ALMOST_HALF = "0.49999999999999994D"


def safe_int(column: str) -> str:
    """BIGINT rounded half away from zero; NaN, infinities and overflow give NULL.

    ``round`` on a double goes through BigDecimal for every row; this stays arithmetic.
    """
    half = f"CASE WHEN {column} < 0 THEN -{ALMOST_HALF} ELSE {ALMOST_HALF} END"
    return f"try_cast({column} + {half} AS BIGINT)"


def safe_double(column: str) -> str:
    return f"try_cast({column} AS DOUBLE)"


def text(column: str) -> str:
    return column


CAST_BY_KIND = {"text": text, "date": safe_date, "int": safe_int, "double": safe_double}


def canonical_text(column: str) -> str:
    """Text of a double inside the key: whole numbers without a fraction."""
    whole = f"try_cast({column} AS BIGINT)"
    return f"CASE WHEN {whole} = {column} THEN cast({whole} AS STRING) ELSE cast({column} AS STRING) END"


def surrogate_key(columns: Sequence[str], doubles: Sequence[str] = ()) -> str:
    """MD5 over the dash-joined column texts; NULLs take part as a fixed text."""
    parts = [
        f"coalesce({canonical_text(c) if c in doubles else f'cast({c} AS STRING)'}, '{KEY_NULL_TEXT}')"
        for c in columns
    ]
    return "md5(concat(" + ", '-', ".join(parts) + "))"


def match_year(column: str) -> str:
    return f"cast(year({column}) AS BIGINT)"
