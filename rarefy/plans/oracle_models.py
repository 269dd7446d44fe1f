"""DuckDB SQL of queries on fitted models whose rows are verdicts: does what was saved, restored or streamed
agree with what was fitted. The keys come from the tables, the verdicts are constants."""

from __future__ import annotations

import json

from ..operators.tune import PARAM_GRIDS, grid_points
from .oracle import TX_EVENTS, _split_sql, with_


def build() -> dict:
    test = with_(TX_EVENTS, _split_sql(0.0), body="SELECT row_id, true AS agrees FROM sp WHERE split = 'test'")
    points = ", ".join(f"({i}, '{json.dumps(p)}')" for i, p in enumerate(grid_points(PARAM_GRIDS["LogisticRegression"])))
    return {
        "save_model": "SELECT * FROM (VALUES (0, 'SQLTransformer'), (1, 'VectorAssembler'), (2, 'LogisticRegressionModel')) t(position, stage)",
        "load_model": test, "save_scaler": test, "save_weighted": test,
        "save_search": f"SELECT point, params, true AS whole, true AS ranked, true AS best_restored FROM (VALUES {points}) t(point, params)",
        "write_comparison": f"SELECT * FROM (VALUES ('models', 3, true), ('ensembles', 2, true), ('tuning', {len(grid_points(PARAM_GRIDS['LogisticRegression']))}, true)) t(comparison, n, same)",
        "raw_score": with_(TX_EVENTS, body='SELECT count(*) AS n, 1 AS all_agree FROM (SELECT DISTINCT "Time", "Amount" FROM tx_events)'),
        "stream_score": with_(TX_EVENTS, body="SELECT row_id, true AS agrees FROM tx_events"),
    }
