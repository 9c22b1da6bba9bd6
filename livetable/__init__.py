"""livetable: Spark-first operators for live and batch analytics on event data.

Every operator is a DataFrame -> DataFrame function built from Spark's own
expressions, so the same code runs on ``spark.read`` and ``spark.readStream``
and leaves planning (pushdown, pruning, join strategy, partial aggregation)
to Catalyst and AQE.
"""

from livetable.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
