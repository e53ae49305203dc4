"""Requests on collections."""

from .request import asc, desc, num_found, select, sort_columns

__all__ = ["asc", "desc", "num_found", "select", "sort_columns"]
