"""Scalar cleaning expressions used by the curation rules.

Semantics kept from the source system:
- ``trim`` strips ASCII spaces only (tabs and newlines stay).
- a flag is true when the trimmed, upper-cased text equals the true value;
  NULL input stays NULL, any other text (including '') is false.
- typed values are cast with ``try_cast`` after blank-to-NULL, so bad text
  becomes NULL instead of failing the job (the row is reported as a reject).
- paths join the non-NULL levels with " > ".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PATH_SEPARATOR = " > "


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: str | Column) -> Column:
    return F.trim(_c(c))


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(F.trim(_c(c)), F.lit(""))


def flag(c: str | Column, true_value: str = "Y") -> Column:
    return F.upper(F.trim(_c(c))) == F.lit(true_value.upper())


def typed(c: str | Column, data_type: str) -> Column:
    """Blank-to-NULL then ``try_cast`` to ``data_type`` (a DDL type string)."""
    return blank_to_null(c).try_cast(data_type)


def cast_failed(raw: str | Column, value: Column) -> Column:
    """True when there was text to convert and the conversion gave NULL."""
    return blank_to_null(raw).isNotNull() & value.isNull()


def hierarchy_path(*levels: str | Column, sep: str = PATH_SEPARATOR) -> Column:
    """NULL levels are skipped with their separator; all NULL gives ''."""
    return F.concat_ws(sep, *[_c(x) for x in levels])


def parent_path(parent: str | Column, name: str | Column, sep: str = PATH_SEPARATOR) -> Column:
    """``parent > name``; a NULL parent keeps the leading separator."""
    return F.concat_ws(sep, F.coalesce(_c(parent), F.lit("")), _c(name))
