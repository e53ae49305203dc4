"""Value functions, literals and value text."""

from .dates import date_math, instant_column
from .registry import call_function, register_function
from .scalars import as_type, exists, field, geodist, hash_rand_int, log10, mul, rand_int
from .values import RangeText, ValueTextError, parse_list, parse_mask, parse_mask_number, parse_range

__all__ = [
    "RangeText", "ValueTextError", "as_type", "call_function", "date_math", "exists", "field",
    "geodist", "hash_rand_int", "instant_column", "log10", "mul", "parse_list", "parse_mask",
    "parse_mask_number", "parse_range", "rand_int", "register_function",
]
