"""Check the numbers a document states against measurements registered by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgauge.operators import resolve
from corpusgauge.operators.prepare import literal_rows

# A measurement returns a DataFrame of one row and one numeric column.
Measurement = Callable[[SparkSession], DataFrame]


def _taken(spark: SparkSession, measurement: Measurement) -> tuple[float | None, bool]:
    """(value, reachable). Only a source that is not there counts as unreachable; any other failure
    is a failed measurement, which no cache may answer for."""
    try:
        return float(measurement(spark).collect()[0][0]), True
    except FileNotFoundError:
        return None, False
    except AnalysisException as error:
        return None, error.getCondition() != "PATH_NOT_FOUND"
    except (PySparkException, IndexError, TypeError, ValueError):
        return None, True


def measure(spark: SparkSession, registry: Mapping[str, Measurement]) -> DataFrame:
    """(name, value, reachable) of every registered measurement."""
    rows = [(name, *_taken(spark, m)) for name, m in registry.items()]
    if not rows:
        return spark.createDataFrame([], "name string, value double, reachable boolean")
    return literal_rows(spark, rows, "name value reachable").withColumn("value", F.col("value").cast("double"))


def check_document(
    spark: SparkSession, documents: DataFrame, text: str, registry: Mapping[str, Measurement], cache: DataFrame
) -> DataFrame:
    """Every claim in ``documents`` with its state; only registered names that are claimed are measured."""
    found = resolve.claims(documents, text)
    known = found.where(F.col("name").isin(*registry)) if registry else found.limit(0)
    claimed = {r.name for r in known.select("name").distinct().collect()}  # bounded by the registry
    measured = measure(spark, {n: m for n, m in registry.items() if n in claimed})
    return resolve.check_claims(found, measured, cache)
