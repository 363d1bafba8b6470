"""Imports every module that registers queries of this subpackage."""

from snapledger.llm import (  # noqa: F401
    conversation_queries,
    dup_queries,
    leak_queries,
    license_queries,
    line_queries,
    page_queries,
    pii_queries,
    quality_queries,
    run_queries,
    token_queries,
    url_queries,
)
from snapledger.llm.registry import ORACLES, QUERIES  # noqa: F401
