"""Standard and robust scaling, fitted on the training rows only.

The fitted model is a handful of literals per column; ``transform`` is one
projection. ``as_sql_transformer`` turns it into an MLlib stage so scaler
and classifier are saved as one ``PipelineModel``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles


@dataclass
class ScalerModel:
    method: str
    center: dict
    scale: dict

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c).cast("double") - F.lit(self.center[c]))
                               / F.lit(self.scale[c]) for c in self.center})

    def as_sql_transformer(self, input_columns):
        from pyspark.ml.feature import SQLTransformer
        parts = []
        for c in input_columns:
            if c in self.center:
                parts.append(f"(CAST(`{c}` AS DOUBLE) - ({float(self.center[c])!r})) / ({float(self.scale[c])!r}) AS `{c}`")
            else:
                parts.append(f"`{c}`")
        return SQLTransformer(statement=f"SELECT {', '.join(parts)} FROM __THIS__")


def _safe(s):
    return 1.0 if s is None or s == 0.0 else s


def fit_scaler(df: DataFrame, cols, method: str = "standard", approx: bool = False) -> ScalerModel:
    cols = list(cols)
    if method == "standard":
        # population std, zero variance scales by 1
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"{c}__m") for c in cols],
                     *[F.stddev_pop(F.col(c).cast("double")).alias(f"{c}__s") for c in cols]).first()
        return ScalerModel("standard", {c: row[f"{c}__m"] for c in cols},
                           {c: _safe(row[f"{c}__s"]) for c in cols})
    if method == "robust":
        q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], approx=approx)
        return ScalerModel("robust", {c: q[(c,)][1] for c in cols},
                           {c: _safe(None if q[(c,)][0] is None else q[(c,)][2] - q[(c,)][0])
                            for c in cols})
    raise ValueError(f"Unknown scaling method: {method}")


def scale_features(train: DataFrame, test: DataFrame, cols, val: DataFrame | None = None,
                   method: str = "standard"):
    """Fit on train, apply to train, test and (when given) val."""
    m = fit_scaler(train, cols, method)
    return m.transform(train), (m.transform(val) if val is not None else None), m.transform(test), m
