"""CSV ingest, layered table store, generated and literal relations, schema listing, reports."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleanstar.operators.checks import Checks, ChecksFailed, Results, observed, plain
from gleanstar.operators.joins import as_list
from gleanstar.sources.csv_split import read_multiline_csv
from gleanstar.sources.schemas import LAYERS, MULTILINE, RAW_SCHEMAS


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType | None = None,
    infer: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """CSV with one header row. A given schema saves the extra pass that inference costs.

    Quoted line breaks need `multiline`: with a schema, files are then split among tasks all
    the same (`csv_split`); inferring one reads a file in one task.
    """
    if multiline and schema is not None:
        return read_multiline_csv(spark, path, schema)
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_raw_csv(spark: SparkSession, table: str, path: str, infer: bool = False) -> DataFrame:
    """One of the nine raw tables, strictly typed, or with an inferred schema."""
    return read_csv(
        spark, path, None if infer else RAW_SCHEMAS[table], infer=infer, multiline=table in MULTILINE
    )


def read_parquet(spark: SparkSession, base: str, table: str) -> DataFrame:
    return spark.read.parquet(os.path.join(base, f"{table}.parquet"))


# Properties of the view that stands for a table in a database.
_VERSION, _CHECKS, _ORDER = "gleanstar.version", "gleanstar.checks", "gleanstar.order"


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


class Warehouse:
    """Tables in the layers raw, clean and serving: folders below `base`, or databases.

    Saving replaces the whole table and returns it as read back, so whatever builds on it
    starts from stored data. A new version is written beside the old one and made current by
    one step of the file system or catalogue, so a failed write, or one whose required checks
    fail, leaves the old table, and a table may be built from itself; `vacuum` deletes
    old versions. In a database a table is a view over its current version; `location` is
    the folder of the databases, by default that of the catalogue.
    """

    def __init__(self, spark: SparkSession, base: str | None = None, prefix: str = "", location: str | None = None):
        self.spark, self.base, self.prefix, self.location = spark, base, prefix, location

    def create_namespaces(self) -> None:
        if self.base is None:
            for layer in LAYERS:
                where = f" LOCATION '{os.path.join(self.location, layer)}'" if self.location else ""
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer}{where}")

    def name(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return os.path.join(self.base, layer, table) if self.base else f"{self.prefix}{layer}.{table}"

    def save(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        checks: Checks | None = None,
        require: Sequence[str] = (),
        order_by: str | Sequence[str] = (),
        bucket_by: str | None = None,
        buckets: int | None = None,
    ) -> DataFrame:
        """Replace the table.

        checks: named aggregates (see `operators.checks`) that the write computes as it goes;
        `checks()` returns them for the current version. If one of those named in `require`
        is neither 0 nor NULL, the new version is not made current and ChecksFailed is raised.
        order_by: the files hold consecutive ranges of these columns and are sorted, so a filter
        on the first of them skips row groups, and `read_range` whole files.
        bucket_by: (databases only) the rows are stored in `buckets` files by the hash of this
        column, by default as many as the session has shuffle partitions, so tables with the
        same buckets join on it, and group by it, without an exchange.
        """
        order = as_list(order_by)
        target = self.name(layer, table)
        missing = [c for c in require if c not in (checks or {})]
        if missing:
            raise ValueError(f"required but not checked: {missing}")
        if order:
            df = df.repartitionByRange(*order).sortWithinPartitions(*order)
        if bucket_by and (self.base or order):
            raise ValueError("buckets need a table of a database without another order")
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if bucket_by:
            # a task a bucket, so a file a bucket
            df = df.repartition(buckets, bucket_by)
        watch = None
        if checks:
            df, watch = observed(df, checks)
        version = f"v{time.time_ns()}_{uuid.uuid4().hex[:8]}"
        if self.base:
            df.write.parquet(os.path.join(target, version))
        else:
            writer = df.write.format("parquet")
            if bucket_by:
                writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
            writer.saveAsTable(f"{target}__{version}")
        results = {name: plain(v) for name, v in watch.get.items()} if watch else {}
        failed = {c: results[c] for c in require if results[c]}
        if failed:
            raise ChecksFailed(target, failed, results)
        if self.base:
            if order:
                self._write_ranges(os.path.join(target, version), order[0])
            self._write_text(os.path.join(target, f"_{version}.json"), json.dumps(results))
            self._point(target, version)
        else:
            self._show(target, version, results, order[0] if order else None)
        return self.read(layer, table)

    def read(self, layer: str, table: str) -> DataFrame:
        target = self.name(layer, table)
        if not self.base:
            return self.spark.table(target)
        return self.spark.read.parquet(os.path.join(target, self._version(target)))

    def read_range(self, layer: str, table: str, lo, hi) -> DataFrame:
        """Rows of an ordered table whose first order column lies between lo and hi. In folders
        only the files that can hold such rows are opened."""
        target = self.name(layer, table)
        if not self.base:
            (column,) = (r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {target}").collect() if r["key"] == _ORDER)
            return self.spark.table(target).filter(F.col(column).between(lo, hi))
        path = os.path.join(target, self._version(target))
        ranges = self.spark.read.parquet(f"{path}.ranges")
        # a row per file of the version
        files = [r["file"] for r in ranges.filter((F.col("hi") >= lo) & (F.col("lo") <= hi)).collect()]
        column = ranges.schema["lo"].metadata["column"]
        schema = self.read(layer, table).schema
        stored = [os.path.join(path, f) for f in files]
        found = self.spark.read.schema(schema).parquet(*stored) if stored else self.spark.createDataFrame([], schema)
        return found.filter(F.col(column).between(lo, hi))

    def checks(self, layer: str, table: str) -> Results:
        """The results of the checks the current version was saved with."""
        target = self.name(layer, table)
        if self.base:
            return json.loads(self._read_text(os.path.join(target, f"_{self._version(target)}.json")))
        properties = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {target}").collect()}
        return json.loads(properties[_CHECKS])

    def vacuum(self, layer: str, table: str) -> int:
        """Delete the versions of a table that are not current; returns how many."""
        target = self.name(layer, table)
        if not self.base:
            properties = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {target}").collect()}
            database, name = target.split(".")
            stored = self.spark.sql(f"SHOW TABLES IN {database} LIKE '{name}__v*'").collect()
            old = [r["tableName"] for r in stored if r["tableName"] != f"{name}__{properties[_VERSION]}"]
            for table_name in old:
                self.spark.sql(f"DROP TABLE {database}.{table_name} PURGE")
            return len(old)
        current, fs = self._version(target), self._filesystem(target)
        stored = [s.getPath() for s in fs.listStatus(self._path(target))]
        old = [p for p in stored if not p.getName().lstrip("_").startswith(current) and p.getName() != "_CURRENT"]
        for path in old:
            fs.delete(path, True)
        return sum(1 for p in old if "." not in p.getName())

    def _show(self, target: str, version: str, results: Results, order: str | None) -> None:
        """Make a version current: the view is replaced in one step of the catalogue."""
        database, name = target.split(".")
        if self.spark.catalog.tableExists(target):
            kinds = self.spark.sql(f"DESCRIBE TABLE EXTENDED {target}").filter("col_name = 'Type'").collect()
            if kinds and kinds[0]["data_type"] != "VIEW":
                # a table stored before there were versions becomes one of them
                self.spark.sql(f"ALTER TABLE {target} RENAME TO {database}.{name}__v0")
        said = {_VERSION: version, _CHECKS: json.dumps(results)} | ({_ORDER: order} if order else {})
        properties = ", ".join(f"'{k}' = '{_escaped(v)}'" for k, v in said.items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {target} TBLPROPERTIES ({properties}) AS SELECT * FROM {target}__{version}")

    def _write_ranges(self, path: str, column: str) -> None:
        """The smallest and largest value of each file, one row a file; NULLs are in the first file."""
        stored = self.spark.read.parquet(path).select(F.col(column), F.col("_metadata.file_name").alias("file"))
        ranges = stored.groupBy("file").agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
        tagged = ranges.withColumn("lo", F.col("lo").alias("lo", metadata={"column": column}))
        tagged.coalesce(1).write.parquet(f"{path}.ranges")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _filesystem(self, name: str):
        return self._path(name).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _read_text(self, name: str) -> str:
        stream = self._filesystem(name).open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _write_text(self, name: str, text: str) -> None:
        stream = self._filesystem(name).create(self._path(name))
        stream.write(bytearray(text.encode()))
        stream.close()

    def _version(self, target: str) -> str:
        return self._read_text(os.path.join(target, "_CURRENT"))

    def _point(self, target: str, version: str) -> None:
        name = os.path.join(target, f"_{version}")
        self._write_text(name, version)
        new = self._path(name)
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        qualified = self._filesystem(target).makeQualified(new)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(qualified, self._filesystem(target).makeQualified(self._path(os.path.join(target, "_CURRENT"))), options)

    def layer(self, layer: str, tables: Sequence[str]) -> dict[str, DataFrame]:
        return {t: self.read(layer, t) for t in tables}

    def ingest(self, folder: str, infer: bool = False) -> dict[str, DataFrame]:
        """Load <folder>/<table>.csv for the nine raw tables."""
        return {
            t: self.save("raw", t, read_raw_csv(self.spark, t, os.path.join(folder, f"{t}.csv"), infer))
            for t in RAW_SCHEMAS
        }


def columns_like(df: DataFrame, pattern: str) -> DataFrame:
    """Columns of a table whose name is LIKE the pattern: column_name, data_type."""
    listed = df.sparkSession.createDataFrame(df.dtypes, "column_name string, data_type string")
    return listed.filter(F.lower("column_name").like(pattern))


def literal_relation(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def write_report(df: DataFrame, path: str) -> None:
    """A report (one row per metric) as CSV with header."""
    df.write.mode("overwrite").option("header", True).csv(path)
