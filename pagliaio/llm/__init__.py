"""Operators that prepare large corpora: grouping, matching, cleaning and encoding.

Nothing outside this subpackage imports it.
"""

from __future__ import annotations

import importlib

_QUERY_MODULES = ["grouping_queries", "percentile_queries", "text_queries", "matching_queries"]


def query_modules() -> list:
    return [importlib.import_module(f"pagliaio.llm.{name}") for name in _QUERY_MODULES]
