"""All queries of the library but those of its optional subpackage."""

from lexquarry.plans import audit_queries, build_queries, citation_queries, date_queries, detail_queries, extension_queries, gate_queries, index_queries, nested_queries, path_queries, pattern_queries, record_queries, relational_queries, search_queries, store_queries, summary_queries, text_queries, unit_queries  # noqa: F401  (they register themselves)
from lexquarry.plans.registry import MODULE, ORACLES, QUERIES

__all__ = ["MODULE", "ORACLES", "QUERIES"]
