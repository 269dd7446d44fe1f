"""Feature engineering and scaling as one fitted, saved stage.

``fit_stage`` learns everything that the projections need from the training rows:
amount quantiles and moments, the PCA basis, the selected features, the scaler.
The stage maps raw transactions (as scanned from a file) to model inputs: it
aligns them to the row contract, so missing columns are 0 and extra ones go,
adds the features, scales and keeps the inputs. It is plain numbers, so it is
saved as JSON with the model, and applying it is a projection: the same for a
table, a file and a stream.

A null amount or time stays null, and so do the features made from it, but for
the flags (0) and what ``fill`` names.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import CONTRACT, LABEL, align_schema, v_columns
from .features import AMOUNT_FEATURES, TIME_FEATURES, AmountStats, add_amount_features, add_time_features, fit_amount_stats, interaction_pairs
from .scale import ScalerModel, fit_scaler
from .select import PCAModel, fit_pca, select_features


@dataclass
class FeatureStage:
    contract: list
    time: bool = True
    amount: AmountStats | None = None
    interactions: list = field(default_factory=list)
    pca: PCAModel | None = None
    inputs: list = field(default_factory=list)
    scaler: ScalerModel | None = None

    def engineered(self, df: DataFrame, keep=("row_id", LABEL)) -> DataFrame:
        """Aligned rows with all features, not scaled."""
        d = align_schema(df, self.contract, keep)
        if self.time:
            d = add_time_features(d)
        if self.amount is not None:
            d = add_amount_features(d, self.amount)
            # amounts outside the fitted decile range go to the end bins, and one amount only has no spread
            low = self.amount.edges[0] if self.amount.edges else 0.0
            d = d.withColumn("Amount_Bin", F.coalesce("Amount_Bin", F.when(F.col("Amount") < F.lit(low), F.lit(0)).otherwise(F.lit(max(len(self.amount.edges) - 2, 0)))))
            d = d.withColumn("Amount_ZScore", F.coalesce("Amount_ZScore", F.lit(0.0)))
        for a, b in self.interactions:
            d = d.withColumn(f"{a}_x_{b}", F.col(a) * F.col(b))
        return d if self.pca is None else self.pca.transform(d)

    def transform(self, df: DataFrame, keep=("row_id", LABEL)) -> DataFrame:
        """Model inputs of raw rows: the key and label columns that are there, and the inputs."""
        d = self.engineered(df, keep)
        d = d.select(*[c for c in keep if c in df.columns], *self.inputs)
        return d if self.scaler is None else self.scaler.transform(d)

    def to_dict(self) -> dict:
        out = asdict(self)
        if self.pca is not None:
            out["pca"] = {"columns": self.pca.columns, "mean": [float(m) for m in self.pca.mean], "components": np.asarray(self.pca.components).tolist(),
                          "explained_variance_ratio": [float(r) for r in self.pca.explained_variance_ratio]}
        return out

    @staticmethod
    def from_dict(d: dict) -> "FeatureStage":
        pca, amount, scaler = d.get("pca"), d.get("amount"), d.get("scaler")
        return FeatureStage(d["contract"], d["time"], AmountStats(**amount) if amount else None, [tuple(p) for p in d["interactions"]],
                            PCAModel(pca["columns"], pca["mean"], np.array(pca["components"]), pca["explained_variance_ratio"]) if pca else None,
                            d["inputs"], ScalerModel(**scaler) if scaler else None)


def fit_stage(train: DataFrame, time: bool = True, amount: bool = True, interactions: bool = False, pca: float | int | None = None,
              select_k: int | None = None, select_method: str = "mutual_info", exclude_original_v: bool = False,
              scale: str | None = "standard", label: str = LABEL, contract=None) -> FeatureStage:
    """Fits the stage on raw training rows. ``contract``: columns of a raw row (default: those of the row
    contract that ``train`` has)."""
    contract = list(contract or [c for c in CONTRACT if c in train.columns])
    stage = FeatureStage(contract, time and "Time" in contract)
    base = align_schema(train, contract)
    components = v_columns(base)
    if amount and "Amount" in contract:
        stage.amount = fit_amount_stats(base)
    if interactions:
        stage.interactions = [tuple(p) for p in interaction_pairs(base)]
    if pca is not None:
        stage.pca = fit_pca(base, components, pca)
    d = stage.engineered(train)
    inputs = [c for c in contract if not (exclude_original_v and c in components)]
    inputs += [*(TIME_FEATURES if stage.time else []), *(AMOUNT_FEATURES if stage.amount else []), *[f"{a}_x_{b}" for a, b in stage.interactions]]
    inputs += [f"PCA_{i + 1}" for i in range(len(stage.pca.components))] if stage.pca else []
    if select_k is not None:
        inputs = select_features(d, inputs, label, select_method, select_k)[0]
    stage.inputs = inputs
    if scale is not None:
        stage.scaler = fit_scaler(d, inputs, scale)
    return stage
