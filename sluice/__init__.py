"""Lead-funnel analytics on Spark: clean, join, encode, train, evaluate, score.

Every operator takes and returns a DataFrame or a Spark ML stage.  Nothing
that grows with the data is collected: the driver only ever sees bounded
things (heavy hitters, search trials, one-row aggregates).
"""

__version__ = "0.1.0"
