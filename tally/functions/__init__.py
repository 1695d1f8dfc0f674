"""Column -> Column helpers (scalar functions of SURVEY §2.9 and V1)."""

from .dates import date_text, quarter_from_text, quarter_start, year_from_text
from .numbers import MONEY, comma_decimal, parse_number, safe_ratio
from .taxid import cnpj_is_valid
from .text import (
    NA_TOKENS,
    ci_contains,
    clean_key,
    digits_key,
    digits_only,
    fold_accents,
    normalise_header,
    normalise_header_col,
    null_tokens,
    state_code,
    unknown_operator_label,
)
