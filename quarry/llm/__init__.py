"""Training-data operators: quality rules, deduplication, scans, classifiers and mixing.

Nothing else in the library imports this subpackage.  `quarry.llm.queries` holds the thin
queries and their SQL.
"""
