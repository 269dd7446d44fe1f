from .exprs import (  # noqa: F401
    time_hours, time_period, time_flags, time_cyclic, amount_log,
    uniform_hash, unit_uniform, decision, risk_band, HASH_BITS,
)
