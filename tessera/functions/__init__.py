"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""

from tessera.functions.columns import (  # noqa: F401
    is_float_text, is_numeric, to_double, tokenize_letters,
    markup_is_valid, markup_id, markup_text, prefix_label, label_map, safe_div,
)
