"""All registered queries and the subset with oracle SQL."""

from __future__ import annotations

from . import catalog, catalog_knn, catalog_models, oracle, oracle_knn, oracle_models


def all_queries() -> dict:
    q = dict(catalog.SQL_CHECKED)
    q.update(catalog_knn.QUERIES)
    q.update(catalog_models.QUERIES)
    return q


def all_oracles() -> dict:
    s = oracle.build()
    s.update(oracle_knn.build())
    s.update(oracle_models.build())
    names = all_queries()
    return {k: v for k, v in s.items() if k in names}
