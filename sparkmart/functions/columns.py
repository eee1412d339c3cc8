"""Scalar column expressions; all of them are built-in, code-generated functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmart.schema import DATE_ID_PATTERN, WHOLE_NUMBER


def model_category(model_id: str = "Model_ID") -> Column:
    """The part before the first dash; the whole text when there is none."""
    return F.substring_index(F.col(model_id), "-", 1)


def revenue_per_unit(revenue: str = "Revenue", units: str = "Units_Sold") -> Column:
    """DOUBLE ratio; NULL when nothing was sold, also under ANSI mode."""
    return F.try_divide(F.col(revenue), F.col(units)).cast("double")


def typed(column: str, data_type: str) -> Column:
    """Strict conversion of a text column: NULL where the text is no such value.

    Whole numbers only, with optional sign and surrounding blanks. The pattern comes
    first because a failing ``try_cast`` costs an exception per value; only numbers out
    of range still pay it.
    """
    if data_type == "string":
        return F.col(column)
    return F.when(F.col(column).rlike(WHOLE_NUMBER), F.col(column).try_cast(data_type))


def blank_to_null(column: str) -> Column:
    """Trimmed text, with blank text turned into NULL."""
    trimmed = F.trim(F.col(column))
    return F.when(trimmed != "", trimmed)


def date_ordinal(date_id: str = "Date_ID") -> Column:
    """The day number inside a well-formed Date_ID, else NULL.

    For well-formed values the numeric order equals the text order. An INT keeps
    ``max`` over it a hash aggregate, where ``max`` over text would sort every
    input partition first.
    """
    digits = F.substring(F.col(date_id), 3, 5).try_cast("int")
    return F.when(F.col(date_id).rlike(DATE_ID_PATTERN), digits)
