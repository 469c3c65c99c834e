"""Jobs that record a layer's failure and go on with the layers that can still be built."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from strata import schemas
from strata.sinks.lake import Lake
from strata.sinks.tables import append_evolving
from strata.sources import files

JOB = "job"


class Recorded:
    """One run of a job over a lake. A layer that cannot be built or stored leaves a row in the
    error table and an empty dataset of its type; the run then counts as failed.

    Errors are appended to gold/pipeline_errors, the run to gold/pipeline_run_metrics."""

    def __init__(self, lake: Lake, run_id: str, job_id: str, client_id: str = JOB) -> None:
        self.lake, self.run_id, self.job_id, self.client_id = lake, run_id, job_id, client_id
        self.started, self.rows, self.failed = datetime.now(), {}, []

    def layer(self, layer: str, name: str, schema: StructType,
              build: Callable[[], DataFrame]) -> DataFrame:
        """The dataset as stored, or no rows of `schema` if anything on the way to it fails."""
        try:
            stored, self.rows[name] = self.lake.store_counted(build(), layer, name)
            return stored
        except Exception as error:  # whatever it is, it is recorded, and the run fails
            self.failed.append(name)
            self.rows[name] = 0
            self._record(name, error)
            return self.lake.store(files.empty(self.lake.spark, schema), layer, name)

    def _record(self, name: str, error: Exception) -> None:
        kind = getattr(error, "getCondition", lambda: None)() or type(error).__name__
        row = (self.client_id, name, f"{kind}: {str(error).splitlines()[0][:1000]}", datetime.now())
        append_evolving(files.local_rows(self.lake.spark, [row], schemas.PIPELINE_ERROR),
                        self.lake.path("gold", "pipeline_errors"))

    def errors(self) -> DataFrame:
        """The rows of the error table, none if there is no table yet."""
        spark, path = self.lake.spark, self.lake.path("gold", "pipeline_errors")
        append_evolving(files.empty(spark, schemas.PIPELINE_ERROR), path)
        return spark.read.schema(schemas.PIPELINE_ERROR).parquet(path)

    def finish(self) -> DataFrame:
        """Append the run, with its status and the rows of each dataset, and return all runs."""
        status = "failed" if self.failed else "success"
        columns = ", ".join(f"{name}_rows BIGINT" for name in self.rows)
        row = (self.run_id, self.job_id, self.started, status, *self.rows.values())
        frame = self.lake.spark.createDataFrame(
            [row], f"run_id STRING, job_id STRING, run_ts TIMESTAMP, status STRING, {columns}")
        return append_evolving(frame, self.lake.path("gold", "pipeline_run_metrics"))
