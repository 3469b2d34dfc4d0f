"""Lap times of a run, as rows."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "lap int, message string, seconds double, total double, is_error boolean"


class Laps:
    """Each call ends a lap. clock: seconds."""

    def __init__(self, clock: Callable[[], float] = time.perf_counter):
        self.clock, self.rows = clock, []
        self.began = self.last = clock()

    def __call__(self, message: str, is_error: bool = False) -> float:
        now = self.clock()
        self.rows.append((len(self.rows), message, now - self.last, now - self.began, is_error))
        self.last = now
        return self.rows[-1][2]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, SCHEMA)
