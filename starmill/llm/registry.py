"""The queries of all operators in this subpackage, by name, and their SQL where there is any."""

from starmill.llm import (  # noqa: F401  importing a module registers its query
    context_mixing,
    conversations,
    language,
    lexical_search,
    licenses,
    mixing,
    multi_index_hashing,
    near_duplicates,
    packing,
    pii,
    quality,
    simhash,
    weighted_sampling,
)
from starmill.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
