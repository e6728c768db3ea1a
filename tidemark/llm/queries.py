"""All queries of this subpackage."""

from tidemark.llm import decontaminate, filter_audit, html_text, licenses, near_dedup, packing, pii, quality, shards, spelling, token_files, toxicity, url_filter  # noqa: F401  (they register queries)
from tidemark.llm.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
