"""rarefy: rare-event (fraud) classification analytics expressed as Spark jobs.

Every operator takes and returns lazy DataFrames. Fitted statistics (means,
quantiles, class counts) are small aggregates brought back to the driver and
re-applied as literals, the same fit/transform split MLlib uses.
"""

__version__ = "0.1.0"
