"""Training-data operators: WARC bundles, packing, toxicity, language ID,
near- and substring dedup, decontamination, quality, top-k search, HTML text.

Nothing outside this package imports it.  ``queries()`` / ``oracle_sql()``
list its registered queries.
"""

from sessionlab.llm.queries import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
