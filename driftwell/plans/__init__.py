"""Named queries and the SQL that their results are held against."""

from __future__ import annotations


def _modules():
    from driftwell.plans import cohort_more_queries, cohort_queries, feature_queries, group_queries, ml_queries, prep_queries, relation_queries, sequence_queries, text_queries

    return feature_queries, cohort_queries, relation_queries, text_queries, prep_queries, sequence_queries, group_queries, ml_queries, cohort_more_queries


def queries() -> dict:
    return {k: v for m in _modules() for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _modules() for k, v in m.SQL.items()}
