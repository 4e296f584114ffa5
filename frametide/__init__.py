"""frametide: Spark-native analytics for keyed, frame-by-frame tracking data.

Every operator takes and returns a ``pyspark.sql.DataFrame`` (or a Column
expression) so plans stay lazy and Catalyst sees the whole query.
"""

from frametide.session import build_session, checkpoint_dir, tune_session

__all__ = ["build_session", "checkpoint_dir", "tune_session"]
