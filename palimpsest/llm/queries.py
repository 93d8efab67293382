"""Imports every module that registers queries."""

from palimpsest.llm import alignment, centroids, class_lm, decontaminate, html_text, language, multi_index, near_dedup, packing, pieces, preferences, sharding, substrings  # noqa: F401
from palimpsest.llm.registry import ORACLES, QUERIES  # noqa: F401
