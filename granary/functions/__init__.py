from granary.functions.casts import (
    lenient_double,
    lenient_long,
    null_if_empty,
    strict_date,
    strict_double,
    strict_long,
    text_or_empty,
)
from granary.functions.rules import (
    column_type,
    infer_schema,
    nutrient_key,
    nutrient_unit,
    primary_key,
)
from granary.functions.text import (
    digits_key,
    digits_struct,
    drop_nul,
    escape_text,
    normalize_identifier,
    normalize_layout_name,
    strip,
)

__all__ = [
    "column_type", "digits_key", "digits_struct", "drop_nul", "escape_text", "infer_schema",
    "lenient_double", "lenient_long", "normalize_identifier", "normalize_layout_name",
    "null_if_empty", "nutrient_key", "nutrient_unit", "primary_key", "strict_date",
    "strict_double", "strict_long", "strip", "text_or_empty",
]
