"""Split, scale (fit on train only) and resample the training rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .resample import handle_imbalance
from .scale import ScalerModel, fit_scaler
from .split import split_data


@dataclass
class Preprocessed:
    train: DataFrame
    val: DataFrame | None
    test: DataFrame
    scaler: ScalerModel
    before: dict
    after: dict


def preprocess(df: DataFrame, features, label: str = "Class", test_size: float = 0.2,
               val_size: float = 0.0, scale_method: str = "standard",
               resampling_method: str | None = "smote", seed: int = 42,
               id_col: str = "row_id", **kw) -> Preprocessed:
    d = split_data(df, label, test_size, val_size, seed, id_col=id_col)
    cols = [id_col, *features, label]
    train = d.where(F.col("split") == "train").select(*cols)
    test = d.where(F.col("split") == "test").select(*cols)
    val = d.where(F.col("split") == "val").select(*cols) if val_size > 0 else None
    scaler = fit_scaler(train, features, scale_method)
    tr, te = scaler.transform(train), scaler.transform(test)
    va = scaler.transform(val) if val is not None else None
    res = handle_imbalance(tr, features, label, resampling_method, seed, id_col=id_col, **kw)
    return Preprocessed(res.data, va, te, scaler, res.before, res.after)
