"""sessionlab: clickstream session analytics on Spark.

Reads click logs, sessionises and turns every session's ordered events into a
wide feature table, selects features, trains and blends Spark ML regressors,
and scores / evaluates predictions. Every data step is a DataFrame plan.
"""

from sessionlab.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
