"""Column expressions (JVM-side, whole-stage codegen; no Python UDFs)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60  # 15 hex digits of md5


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def uniform_hash(id_col, seed: int, salt: str = "") -> Column:
    """Repeatable 60-bit hash of a row key and a seed.

    Randomness in this library never uses ``rand()`` (it depends on the
    partition layout); it is a hash of the row key, so re-executed tasks
    and other engines produce the same draw. md5 is used because other SQL
    engines have it too.
    """
    key = F.concat_ws(":", _c(id_col).cast("string"), F.lit(f"{seed}{salt}"))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def unit_uniform(id_col, seed: int, salt: str = "") -> Column:
    """Hash mapped to [0, 1)."""
    return uniform_hash(id_col, seed, salt).cast("double") / F.lit(float(2 ** HASH_BITS))


# --- time features -------------------------------------------------------

def time_hours(time_col="Time") -> Column:
    """Hour of day from seconds: (Time / 3600) mod 24, never negative."""
    return F.pmod(_c(time_col) / F.lit(3600.0), F.lit(24.0))


# Period labels and their hour edges.
PERIOD_LABELS = ["Night", "Morning", "Afternoon", "Evening"]
PERIOD_EDGES = [0, 6, 12, 18, 24]


def time_period(h) -> Column:
    """Right-closed bins (0,6], (6,12], (12,18], (18,24]; hour 0 gives null."""
    h = _c(h)
    e = PERIOD_EDGES
    out = None
    for i, lab in enumerate(PERIOD_LABELS):
        cond = (h > F.lit(float(e[i]))) & (h <= F.lit(float(e[i + 1])))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def time_flags(h) -> dict[str, Column]:
    """Left-closed 0/1 flags [0,6), [6,12), [12,18), [18,24)."""
    h = _c(h)
    e = PERIOD_EDGES
    return {f"Is_{lab}": ((h >= F.lit(float(e[i]))) & (h < F.lit(float(e[i + 1])))).cast("int")
            for i, lab in enumerate(PERIOD_LABELS)}


def time_cyclic(h) -> dict[str, Column]:
    h = _c(h)
    ang = F.lit(2.0 * math.pi) * h / F.lit(24.0)
    return {"Time_Hours_Sin": F.sin(ang), "Time_Hours_Cos": F.cos(ang)}


def amount_log(amount_col="Amount") -> Column:
    return F.log1p(_c(amount_col))


# --- decisions -----------------------------------------------------------

def decision(score_col="score", threshold: float = 0.5) -> Column:
    """Positive when the score reaches the threshold (inclusive)."""
    return (_c(score_col) >= F.lit(threshold)).cast("int")


# Risk bands of a predicted fraud (strict lower edges).
RISK_BANDS = [(0.9, "Very High"), (0.7, "High"), (0.5, "Medium")]


def risk_band(prob_col="score", pred_col="prediction") -> Column:
    """Band of a predicted fraud by probability; legitimate rows get 'Legitimate'."""
    p = _c(prob_col)
    band = None
    for edge, lab in RISK_BANDS:
        band = F.when(p > F.lit(edge), F.lit(lab)) if band is None else band.when(p > F.lit(edge), F.lit(lab))
    band = band.otherwise(F.lit("Low"))
    return F.when(_c(pred_col) == 1, band).otherwise(F.lit("Legitimate"))
