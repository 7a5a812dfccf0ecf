"""CSV export sinks in the reference's text formats (SNK-01..03, SNK-06).

Tables stay typed Parquet; these writers render canonical text only on export.
Each batch keeps its input order via ``pos``; output goes to one folder per
batch (``batch=<key>``), never overwriting an existing export.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import features_for_export


def export_csv(df: DataFrame, path: str, order: tuple = ("batch", "pos"), mode: str = "errorifexists") -> None:
    """Header + rows, CRLF line ends like Python's csv module, minimal quoting, rows in ``order``.

    Range partitioning on the order keys keeps each batch's rows contiguous and in
    order while a large batch still spreads over several tasks.
    """
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode(mode).option("header", True).option("lineSep", "\r\n").option("quoteAll", False)
     .option("emptyValue", "").option("nullValue", "").partitionBy("batch").csv(path))


def export_features(features: DataFrame, path: str) -> None:
    export_csv(features_for_export(features), path)


def export_rejects(rejects: DataFrame, path: str) -> None:
    export_csv(rejects.drop("batch_time"), path)


def export_predictions(predictions: DataFrame, path: str) -> None:
    p = predictions.select("order_id", F.format_string("%.3f", "late_probability").alias("late_probability"),
                           F.col("predicted_late").cast("string").alias("predicted_late"), "checkpoint_id",
                           "batch", "pos")
    export_csv(p, path)
