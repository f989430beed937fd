from .arrays import array_to_text, parse_array_repr, text_to_array
from .numbers import one_decimal, percent, round1, round1_exact, text_bar, thousands
from .script import script_counts, script_label, with_script
from .text import (
    ascii_preview,
    clean_pairs,
    clean_text,
    clean_token_count,
    clean_tokens,
    collapse_ws,
    is_blank,
    is_digits,
    strip_mentions,
    strip_urls,
    strip_ws,
    text_of,
    text_preview,
    token_preview,
    tokens_of,
)
