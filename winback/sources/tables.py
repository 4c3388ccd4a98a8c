"""Layered tables: reads, writes and per-date replacement."""

from __future__ import annotations

import json
import os
import re
import time
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winback.contract import MONTH, TABLES, TRANSACTION_COLUMNS
from winback.functions.lines import month
from winback.session import new_folder
from winback.sources.bronze import union_parts


def _rebalanced(df: DataFrame, by: str) -> DataFrame:
    """Rows of one partition meet in few tasks, a large partition being split by size.

    Without it every task writes a small file into every partition.
    """
    return df.hint("rebalance", by)


class Tables:
    """Tables addressed by layer and key, as Parquet folders below one root.

    A table exists once its definition is there: a small file beside the layers that is
    written after the first rows and holds the schema. Any session that knows the root sees
    the same tables; no catalog has to survive. Replacing works on whole partitions.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @classmethod
    def scratch(cls, spark: SparkSession) -> Tables:
        """A store of its own under the shared folder."""
        return cls(spark, new_folder(spark, "tables"))

    def name(self, layer: str, key: str) -> str:
        if key not in TABLES.get(layer, ()):
            known = {known_layer: list(keys) for known_layer, keys in TABLES.items()}
            raise KeyError(f"no table {layer}.{key}; known: {known}")
        return f"{layer}.{key}"

    def path(self, layer: str, key: str) -> str:
        self.name(layer, key)
        return f"{self.root}/{layer}/{key}"

    def _definition(self, layer: str, key: str) -> str:
        return self.path(layer, key).replace(self.root, f"{self.root}/_definitions", 1)

    def _at(self, path: str):
        """A path and its file system, through Hadoop, so any store Spark reaches will do."""
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def claim(self, name: str) -> bool:
        """Whether this caller is the first of all to claim a name.

        The claim is a small file that is created only if it is not there, in one step.
        """
        path, files = self._at(f"{self.root}/_claims/{name}")
        files.mkdirs(path.getParent())
        if files.getUri().getScheme() == "file":
            # Hadoop looks before it creates here, which two callers can do at once.
            try:
                os.close(os.open(path.toUri().getPath(), os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                return False
            return True
        try:
            files.create(path, False).close()
        except Py4JJavaError as failed:
            if "FileAlreadyExists" not in failed.java_exception.getClass().getName():
                raise
            return False
        return True

    def claim_number(self, name: str, first: int) -> int:
        """The least number from `first` on that nobody has claimed; it is the caller's now."""
        while not self.claim(f"{name}-{first}"):
            first += 1
        return first

    def create_layer(self, layer: str) -> str:
        if layer not in TABLES:
            raise KeyError(f"no layer {layer}; known: {list(TABLES)}")
        folder, files = self._at(f"{self.root}/{layer}")
        files.mkdirs(folder)
        return folder.toString()

    def exists(self, layer: str, key: str) -> bool:
        path, files = self._at(f"{self._definition(layer, key)}/_SUCCESS")
        return files.exists(path)

    def schema(self, layer: str, key: str) -> T.StructType:
        if not self.exists(layer, key):
            raise ValueError(f"missing tables: ['{self.name(layer, key)}']")
        stored = self.spark.read.text(self._definition(layer, key)).first()
        return T.StructType.fromJson(json.loads(stored["value"]))

    def read(self, layer: str, key: str) -> DataFrame:
        return self.spark.read.schema(self.schema(layer, key)).parquet(self.path(layer, key))

    def _define(self, df: DataFrame, layer: str, key: str, by: str | None) -> None:
        # A reader finds partition columns last.
        fields = sorted(df.schema.fields, key=lambda f: f.name == by)
        text = T.StructType([T.StructField(f.name, f.dataType) for f in fields]).json()
        folder, files = self._at(self.path(layer, key))
        files.mkdirs(folder)
        row = self.spark.createDataFrame([(text,)], "value string").coalesce(1)
        row.write.mode("overwrite").text(self._definition(layer, key))

    def _write(
        self,
        df: DataFrame,
        layer: str,
        key: str,
        by: str | None,
        mode: str,
        overwrite: str,
        one: bool = False,
        file_rows: int | None = None,
    ) -> None:
        """`one`: all rows are of one partition, so each task writes one file as it is."""
        writer: DataFrameWriter = (df if one or not by else _rebalanced(df, by)).write
        if by:
            writer = writer.partitionBy(by)
        if file_rows:
            writer = writer.option("maxRecordsPerFile", file_rows)
        writer.mode(mode).option("partitionOverwriteMode", overwrite).parquet(self.path(layer, key))

    def write_full(
        self,
        df: DataFrame,
        layer: str,
        key: str,
        by: str | None = None,
        one: bool = False,
        file_rows: int | None = None,
    ) -> None:
        """Replace the whole table. `file_rows` bounds the rows of a file, as in `materialise`."""
        self._write(df, layer, key, by, "overwrite", "static", one, file_rows)
        self._define(df, layer, key, by)

    def write_append(
        self, df: DataFrame, layer: str, key: str, by: str | None = None
    ) -> None:
        """Add rows, creating the table at first."""
        if self.exists(layer, key):
            self._write(df.select(*self.schema(layer, key).names), layer, key, by, "append", "static")
        else:
            # What an interrupted first write left is no table yet.
            self.write_full(df, layer, key, by)

    def write_replace(
        self, df: DataFrame, layer: str, key: str, by: str, value: object | None = None
    ) -> None:
        """Replace the partitions of `by` that `df` holds; all others stay.

        With `value`, `df` may hold that one value only. Running it twice leaves the
        same table as running it once. The new rows are committed in one step, so a
        failure leaves the old ones.
        """
        if value is not None:
            # Checked row by row while writing, so the frame is computed once; a foreign
            # row fails the job before anything is committed.
            foreign = F.raise_error(F.lit(f"rows outside {by} = {value}"))
            own = F.col(by).eqNullSafe(F.lit(value))
            df = df.withColumn(by, F.when(own, F.col(by)).otherwise(foreign))
        one = value is not None
        if not self.exists(layer, key):
            self.write_full(df, layer, key, by=by, one=one)
            return
        rows = df.select(*self.schema(layer, key).names)
        self._write(rows, layer, key, by, "overwrite", "dynamic", one)

    def write_entry(self, df: DataFrame, layer: str, key: str, **at: object) -> None:
        """Add rows as a partition of their own, named by values that the caller has claimed.

        Nothing is shared with other writers, so entries can be written at the same time.
        """
        for value in at.values():
            if not re.fullmatch(r"[\w.-]+", str(value)):
                raise ValueError(f"not a partition value: {value!r}")
        if not self.exists(layer, key):
            if self.claim(f"definition-{layer}-{key}"):
                self._define(df, layer, key, None)
            for _ in range(100):
                if self.exists(layer, key):
                    break
                time.sleep(0.1)
            else:
                # Who claimed it has stopped.
                self._define(df, layer, key, None)
        folder = "/".join([self.path(layer, key), *[f"{k}={v}" for k, v in at.items()]])
        df.drop(*at).coalesce(1).write.mode("overwrite").parquet(folder)

    def drop_partition(self, layer: str, key: str, by: str, value: object) -> None:
        """Delete one partition; a date or a batch id."""
        text = str(value)
        if not isinstance(value, date) and not re.fullmatch(r"[\w.-]+", text):
            raise ValueError(f"not a partition value: {text!r}")
        folder, files = self._at(f"{self.path(layer, key)}/{by}={text}")
        files.delete(folder, True)

    def partitions(self, layer: str, key: str, by: str) -> list:
        """The values of `by` that a table has partitions of, in order."""
        if not self.exists(layer, key):
            return []
        return sorted(row[0] for row in self.read(layer, key).select(by).distinct().collect())

    def forget_state(self, first: date | None = None) -> None:
        """Drop the customer states that lines from `first` on (all, if None) are part of."""
        for key, by in (("customer_state", "state_date"), ("customer_seen", "since")):
            for day in self.partitions("gold", key, by):
                if first is None or day >= first:
                    self.drop_partition("gold", key, by, day)

    def forget_state_of_batch(self, batch_id: str) -> None:
        """Drop the customer states that a stored batch is part of."""
        if self.exists("synthetic", "generation_runs"):
            runs = self.read("synthetic", "generation_runs").filter(F.col("batch_id") == batch_id)
            for row in runs.select("batch_start_date").collect():
                self.forget_state(row[0])

    def delete_batch(self, batch_id: str) -> None:
        """Remove one recurring batch, its manifest row and the customer states it is part of."""
        self.forget_state_of_batch(batch_id)
        for key in ("transactions", "generation_runs"):
            if self.exists("synthetic", key):
                self.drop_partition("synthetic", key, "batch_id", batch_id)

    def create_full_history(self, silver: DataFrame | None = None) -> DataFrame:
        """View of all transactions, first-party and recurring batches, with their month.

        Where silver is stored by month, a condition on the month reads those folders only.
        """
        parts = [silver if silver is not None else self.read("silver", "transactions")]
        if self.exists("synthetic", "transactions"):
            parts.append(self.read("synthetic", "transactions"))
        history = union_parts(
            *[
                part.select(
                    *TRANSACTION_COLUMNS, MONTH if MONTH in part.columns else month().alias(MONTH)
                )
                for part in parts
            ]
        )
        history.createOrReplaceTempView("full_history")
        return history
