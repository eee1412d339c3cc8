"""Landing conversion: twelve text columns in, eleven typed columns out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import typed
from sparkmart.schema import CORRUPT, DATE_ID_PATTERN, LIMITS, MAPPING, RAW_COLUMNS

MALFORMED = "malformed row"


class ConversionError(ValueError):
    """Raised in strict mode when a row holds a text that does not convert."""


def _value(raw: str, data_type: str) -> Column:
    if raw == "Date_ID":
        # The extract trusts the order of these codes, so only well-formed ones pass.
        code = F.trim(F.col(raw))
        return F.when(code.rlike(DATE_ID_PATTERN), code)
    value = typed(raw, data_type)
    return F.when(value.between(*LIMITS[raw]), value) if raw in LIMITS else value


def _bad(raw: str, data_type: str) -> Column:
    # A missing value (NULL) is no failed conversion; a text that yields NULL is.
    # Without its code a row would be in no window, so there a missing value fails too.
    bad = _value(raw, data_type).isNull()
    return bad if raw == "Date_ID" else F.col(raw).isNotNull() & bad


_CHECKED = [(raw, t) for raw, _, t in MAPPING if t != "string" or raw == "Date_ID"]


def reject_reason() -> Column:
    """Comma-separated raw columns that do not convert, NULL when all do."""
    reasons = F.concat_ws(",", *[F.when(_bad(raw, t), F.lit(raw)) for raw, t in _CHECKED])
    return F.when(reasons != "", reasons)


def _is_reject() -> Column:
    hits = [_bad(raw, t) for raw, t in _CHECKED]
    condition = hits[0]
    for hit in hits[1:]:
        condition = condition | hit
    return condition


def conform(raw: DataFrame, *keep: str) -> DataFrame:
    """Rows whose every value converts, renamed and typed; DealerName is dropped.

    Row-local: one projection and one filter fused into the scan, no shuffle.
    Columns named in ``keep`` pass through unchanged.
    """
    typed_columns = [_value(source, t).alias(name) for source, name, t in MAPPING]
    return raw.filter(~_is_reject()).select(*typed_columns, *keep)


def rejects(raw: DataFrame, *keep: str) -> DataFrame:
    """The other rows, as received, with the columns that failed."""
    return raw.filter(_is_reject()).select(
        *RAW_COLUMNS, *keep, reject_reason().alias("reject_reason")
    )


def land_columns(raw: DataFrame, *keep: str) -> DataFrame:
    """Every row once: typed columns, and for rejects the reason and the row as received.

    Lets landing parse the text a single time; ``reject_reason`` tells the two apart.
    Rows whose fields do not fit the layout come with their text (``CORRUPT``, where the
    reader gives it) as ``raw_text``.
    """
    typed_columns = [_value(source, t).alias(name) for source, name, t in MAPPING]
    text = F.col(CORRUPT) if CORRUPT in raw.columns else F.lit(None).cast("string")
    received = F.when(_is_reject() | text.isNotNull(), F.struct(*RAW_COLUMNS))
    reason = F.when(text.isNotNull(), F.lit(MALFORMED)).otherwise(reject_reason())
    return raw.select(
        *typed_columns, reason.alias("reject_reason"), received.alias("received"),
        text.alias("raw_text"), *keep,
    )


def _typed_ok() -> Column:
    good = F.trim("Date_ID").rlike(DATE_ID_PATTERN)
    for column, limits in LIMITS.items():
        good = good & (F.col(column).isNull() | F.col(column).between(*limits))
    return F.coalesce(good, F.lit(False))


def conform_typed(source: DataFrame) -> DataFrame:
    """Rows of a typed source that landing would accept, with the date code trimmed."""
    return source.filter(_typed_ok()).withColumn("Date_ID", F.trim("Date_ID"))


def typed_rejects(source: DataFrame) -> DataFrame:
    """The other rows of a typed source, as they are."""
    return source.filter(~_typed_ok())


def require_clean(raw: DataFrame) -> DataFrame:
    """Strict mode: the conformed rows, or an error if any row is rejected."""
    example = land_columns(raw).filter("reject_reason is not null").select("reject_reason").first()
    if example is not None:
        raise ConversionError(f"rows do not convert, e.g. in {example[0]}")
    return conform(raw)
