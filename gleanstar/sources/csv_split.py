"""CSV with quoted line breaks, read by many tasks a file.

Spark cuts a text file into blocks at line ends, whether a line end is quoted or not. A
first scan counts the quotes of each block; their running parity tells whether a block
begins within quotes. In a second scan each task starts at the first record that begins
in its block and joins lines while the number of quotes is odd. A record that goes over the
end of a block is put together from its parts, at most two a block. Quotes within quotes are
doubled, so they do not change a parity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StructType

_DDL = "file string, start long, kind int, first boolean, record string"
# Whole records, and parts that close or open one.
_WHOLE, _HEAD, _TAIL = 0, 1, 2


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines of the files, in order within each block."""
    source = spark.read.option("lineSep", "\n").text(path)
    return source.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def block_parities(lines: DataFrame) -> DataFrame:
    """file, start, before and after (whether the block begins and ends within quotes): a row a block."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    blocks = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    after = F.sum("quotes").over(W.partitionBy("file").orderBy("start"))
    return blocks.select("file", "start", ((after - F.col("quotes")) % 2 == 1).alias("before"), (after % 2 == 1).alias("after"))


def _cut(parts: bool):
    """Whole records of each block, or the parts of records at its ends."""
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("record", pa.string())])
    whole_kind, head_kind, tail_kind = _WHOLE, _HEAD, _TAIL

    def run(batches):
        block, inside, held, head, top, out = None, 0, [], False, False, []

        def closed(kind):
            """The record held so far."""
            nonlocal held, top
            record, first = "\n".join(held), top
            held, top = [], False
            if (kind != whole_kind) == parts:
                out.append((*block, kind, first, record))

        def finish():
            if block is not None and held:
                closed(tail_kind if inside and not head else head_kind if head else whole_kind)

        for batch in batches:
            files, starts, line, before = batch.columns
            quotes = pc.count_substring(line, '"').to_numpy()
            at = starts.to_numpy()
            names = files.dictionary_encode()
            where = names.indices.to_numpy()
            change = np.flatnonzero((np.diff(at) != 0) | (np.diff(where) != 0)) + 1
            for a, b in zip([0, *change.tolist()], [*change.tolist(), len(at)], strict=True):
                key = (files[a].as_py(), int(at[a])) if b > a else None
                if key is None:
                    continue
                if key != block:
                    finish()
                    block, inside = key, int(before[a].as_py())
                    held, head, top = [], bool(inside), key[1] == 0
                count = quotes[a:b]
                total = inside + np.cumsum(count)
                begins = np.flatnonzero((total - count) % 2 == 0)
                inside = int(total[-1] % 2)
                values = line.slice(a, b - a)
                if not len(begins):
                    held += values.to_pylist()
                    continue
                held += values.slice(0, int(begins[0])).to_pylist()
                if held:
                    closed(head_kind if head else whole_kind)
                head = False
                if not parts and len(begins) > 1:
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                        out = []
                    lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), values)
                    n = len(lists)
                    first = np.zeros(n, bool)
                    first[0], top = top, False
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key[0]] * n), pa.array([key[1]] * n, pa.int64()), pa.array([whole_kind] * n, pa.int32()), pa.array(first), pc.binary_join(lists, "\n")],
                        schema=schema,
                    )
                elif len(begins) > 1:
                    top = False
                held = values.slice(int(begins[-1])).to_pylist()
        finish()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, first (whether the record begins its file) and record, as text with its line breaks."""
    lines = _lines(spark, path)
    # a row a block, that is, the size of the files by that of a task's share
    parities = F.broadcast(block_parities(lines))
    placed = lines.join(parities, ["file", "start"])
    columns = ["file", "start", "line", "before"]
    whole = placed.select(*columns).mapInArrow(_cut(False), _DDL)
    parts = placed.filter("before or after").select(*columns).mapInArrow(_cut(True), _DDL)
    # a part that opens a record, with those that follow up to the one that closes it
    opened = F.sum((F.col("kind") == _TAIL).cast("int")).over(W.partitionBy("file").orderBy("start", "kind"))
    joined = parts.withColumn("number", opened).groupBy("file", "number").agg(
        F.bool_or("first").alias("first"), F.array_sort(F.collect_list(F.struct("start", "kind", "record"))).alias("parts")
    )
    joined = joined.select("file", "first", F.array_join(F.col("parts.record"), "\n").alias("record"))
    return whole.select("file", "first", "record").union(joined)


def read_multiline_csv(spark: SparkSession, path: str | list[str], schema: str | StructType, header: bool = True) -> DataFrame:
    """CSV of a known schema whose quoted values may hold line breaks; `"` is doubled within
    quotes. Empty lines are no records. The order of records is not kept."""
    found = records(spark, path)
    text = F.regexp_replace("record", "\r$", "")
    kept = found.filter(F.length(text) > 0)
    if header:
        kept = kept.filter(~F.col("first"))
    kind = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
    # as read from files: no column is required
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind)
    return kept.select(F.from_csv(text, ddl, {"escape": '"'}).alias("r")).select("r.*")
