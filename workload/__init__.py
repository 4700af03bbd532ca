"""The engine's queries on the test tables."""

from workload import apply_queries, convert_queries, source_queries, stream_queries

ALL = {
    **source_queries.QUERIES,
    **convert_queries.QUERIES,
    **apply_queries.QUERIES,
    **stream_queries.QUERIES,
}
