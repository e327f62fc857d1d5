"""setlist — playlist analytics on Spark.

Every operator is plain DataFrame code: joins, hash aggregates, windows and,
where matrix work is needed, Arrow-batched pandas functions that Spark
partitions and shuffles.  Functions take and return DataFrames and stay lazy
unless their docstring says otherwise.
"""

from setlist.session import build_session, checkpoint_dir, materialize

__all__ = ["build_session", "checkpoint_dir", "materialize"]
