"""ranklight: Spark-native recommendation analytics.

Every operator is a function from DataFrames (plus plain parameters) to a
DataFrame.  Nothing is collected to the driver; ranking, similarity and
metrics are joins, grouped aggregates and partitioned windows.
"""

from ranklight.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
