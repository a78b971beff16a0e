"""Structured Streaming jobs over event files; each has a batch twin in the catalogue."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def source(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(SCHEMA).parquet(path)


def windowed(events: DataFrame, size: str = "1 day", late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def confirms(events: DataFrame) -> DataFrame:
    """user_id, confirms, last_value: a counter of equal values in a row, kept per user between batches."""

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, last = state.get if state.exists else (-1, None)
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        for v in rows["event_type"]:
            n, last = (n + 1, last) if v == last else (0, v)
        state.update((n, last))
        yield pd.DataFrame({"user_id": [key[0]], "confirms": [n], "last_value": [last]})

    return events.groupBy("user_id").applyInPandasWithState(fold, "user_id long, confirms long, last_value string", "n long, last string", "update", "NoTimeout")


def run_once(df: DataFrame, folder: str, mode: str) -> DataFrame:
    """Drains what is there into Parquet files below folder, and returns their rows: those of the last batch in complete mode, else those of
    all batches, with the batch they came in. The checkpoint is kept there too, so a run that was stopped goes on where it was."""
    path = f"{folder}/rows"

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/part={number}")

    q = df.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.parquet(path)
