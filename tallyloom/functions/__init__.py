from .bands import SCHEMES, cut
from .nulls import any_of, filter_out, join_null_safe, row_sum
from .recode import recode, recode_strict, replace_everywhere, replace_values
from .text import sentence_case, squish, title_case

__all__ = [
    "SCHEMES", "any_of", "cut", "filter_out", "join_null_safe", "recode", "recode_strict",
    "replace_everywhere", "replace_values", "row_sum", "sentence_case", "squish", "title_case",
]
