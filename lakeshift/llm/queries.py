"""The registered queries of the corpus operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from lakeshift.llm import (  # noqa: F401  (each module registers its query)
    clustering,
    decontaminate,
    divergence,
    exact,
    language,
    mixing,
    ngram_join,
    quality,
    sharding,
    substring,
    suffixes,
    surrogates,
    warc,
)
from lakeshift.llm.common import REGISTRY

QUERIES = REGISTRY.queries
ORACLES = REGISTRY.oracles
