"""panelkit: keyed panel / time-series analytics expressed as Spark DataFrame plans.

Every operator is a function ``f(df, ..., keys=()) -> DataFrame`` that only
builds a lazy plan; nothing is collected except where a contract check needs
a scalar verdict.
"""

from panelkit.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
