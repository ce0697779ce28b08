"""Scoring a stream of session feature rows with a fitted model.

The reference has no streaming operators (no watermarks, windows or state).
The one flow that maps onto Structured Streaming is scoring (3.2): feature
rows of finished sessions arrive as files, every micro-batch is scored by
the fitted ensemble and appended to the submission sink.  The operation is
stateless, so each micro-batch is an ordinary batch DataFrame.  A batch that
is replayed after a failure is written again: output is at least once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sessionlab.operators.models import EnsembleModel
from sessionlab.operators.validate import require_features
from sessionlab.sources.sinks import submission_frame


def score_stream(spark: SparkSession, features_dir: str, model_dir: str, out_dir: str,
                 checkpoint: str, schema, available_now: bool = True):
    """Start a streaming query: parquet feature rows -> predictions (floored
    at 0) appended as parquet.  Returns the ``StreamingQuery``."""
    model = EnsembleModel.load(spark, f"{model_dir}/model")
    stream = spark.readStream.schema(schema).parquet(features_dir)

    def score_batch(batch: DataFrame, epoch_id: int) -> None:
        require_features(batch, model.features)
        submission_frame(model.transform(batch)).write.mode("append").parquet(out_dir)

    w = stream.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
