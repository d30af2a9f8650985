"""How many rows with whole texts travel to a Python worker at once."""

from pyspark.sql import SparkSession

TEXT_ROWS = 2_000
_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``TEXT_ROWS`` rows, if they are larger; results don't depend on it."""
    rows = int(spark.conf.get(_SETTING))
    if rows <= 0 or rows > TEXT_ROWS:
        spark.conf.set(_SETTING, str(TEXT_ROWS))
