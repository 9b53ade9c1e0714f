"""All registered queries of this subpackage."""

from citypulse.llm import (  # noqa: F401  (register)
    centroids,
    contamination,
    html,
    jaccard,
    language,
    passages,
    periods,
    pieces,
    quality,
    scoring,
    secrets,
    tokencount,
    vectors,
)
from citypulse.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
