"""All registered queries of the library but those of the training-data operators."""

from termtide.plans import catalog_queries, crossterm_queries, page_queries, series_queries, snapshot_queries, source_queries

PARTS = (series_queries, catalog_queries, snapshot_queries, crossterm_queries, page_queries, source_queries)
QUERIES = {name: query for part in PARTS for name, query in part.QUERIES.items()}
ORACLE_SQL = {name: sql for part in PARTS for name, sql in part.ORACLE_SQL.items()}
