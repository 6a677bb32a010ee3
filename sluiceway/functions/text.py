"""Text expressions for control rows and request paths."""

from __future__ import annotations

import secrets
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of an enabled control row, compared after trimming and lower-casing.
TRUE_WORDS = ("true", "t", "1", "yes", "y")

# Characters of an error response kept in the landing row.
ERROR_TEXT_CHARS = 500

BLANKS = " \t\n\r\x0b\x0c"


def stripped(col: Column) -> Column:
    """Text without surrounding white space; NULL becomes empty."""
    return F.btrim(F.coalesce(col.cast("string"), F.lit("")), F.lit(BLANKS))


def is_truthy(col: Column) -> Column:
    return F.lower(stripped(col)).isin(*TRUE_WORDS)


def none_if_empty(col: Column) -> Column:
    return F.when(col != "", col)


def json_string(col: Column) -> Column:
    """The text as a quoted JSON string; NULL stays NULL."""
    quoted = F.to_json(F.array(col))
    return F.when(col.isNotNull(), F.substring(quoted, F.lit(2), F.length(quoted) - 2))


def is_json_sql(column: str) -> str:
    """SQL condition: the whole text is one JSON value.

    A parser may read the first value and let anything follow it, as in ``42 apples``. The text is
    therefore parsed inside an array, before its own hash: there are two values and the hash is the
    second only if the text is exactly one value. Elements are taken as text, so that an object
    that repeats a key is fine.
    """
    wrapped = f"from_json(concat('[', {column}, ',\"', md5({column}), '\"]'), 'array<string>')"
    return f"coalesce(size({wrapped}) = 2 AND {wrapped}[1] = md5({column}), false)"


def json_value(column: str) -> Column:
    """The text itself where it is JSON, else the text as a JSON string."""
    return F.when(F.expr(is_json_sql(column)), F.col(column)).otherwise(json_string(F.col(column)))


def new_run_id(now: datetime | None = None) -> str:
    """``yyyyMMdd'T'HHmmss'Z'-<8 hex>``; made once per run."""
    moment = now or datetime.now(timezone.utc)
    return f"{moment:%Y%m%dT%H%M%SZ}-{secrets.token_hex(4)}"
