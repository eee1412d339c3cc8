from sparkmart.functions.columns import (
    blank_to_null,
    date_ordinal,
    model_category,
    revenue_per_unit,
    typed,
)

__all__ = ["blank_to_null", "date_ordinal", "model_category", "revenue_per_unit", "typed"]
