"""Filters, rule matching, lookups, writes, terms and log jobs."""

from .filters import (
    ValueFilter, apply_filters, bit_all_filter, bit_any_filter, build_filter, filter_in, in_filter,
    range_filter, register_filter, with_constant_score,
)
from .logs import (
    classify_requests, is_update_request, log_history, name_tree, normalize_code, parse_request_log, request_params,
    unknown_code,
)
from .lookup import first_per_key, lookup, lookup_ref
from .rules import match_rules, parse_rules
from .skew import find_hot_keys
from .terms import copy_field, get_by_ids, terms_doc_freq
from .writes import delete_by_ids, delete_by_query, export_sorted, upsert_latest, with_defaults

__all__ = [
    "ValueFilter", "apply_filters", "bit_all_filter", "bit_any_filter", "build_filter",
    "classify_requests", "copy_field", "delete_by_ids", "delete_by_query", "export_sorted",
    "filter_in", "find_hot_keys", "first_per_key", "get_by_ids", "in_filter", "is_update_request", "log_history",
    "lookup", "lookup_ref", "match_rules", "name_tree", "normalize_code", "parse_request_log",
    "parse_rules", "range_filter", "register_filter", "request_params", "terms_doc_freq",
    "unknown_code", "upsert_latest", "with_constant_score", "with_defaults",
]
