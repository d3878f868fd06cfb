from tablewright.functions.text import (
    comma_join,
    drop_prefix,
    is_filled,
    lower_strip,
    percentage,
    strip_underscores,
    strip_whitespace,
)
from tablewright.functions.values import (
    canonical_text,
    clean_value,
    family_of,
    own_hash,
    same_value,
    value_hash,
)

__all__ = [
    "canonical_text",
    "clean_value",
    "comma_join",
    "drop_prefix",
    "family_of",
    "is_filled",
    "lower_strip",
    "own_hash",
    "percentage",
    "same_value",
    "strip_underscores",
    "strip_whitespace",
    "value_hash",
]
