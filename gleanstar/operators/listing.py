"""Lists of values per key, in pages of consecutive values, so no key builds one huge row.

Rows are range-partitioned by key and value and sorted, once. A task cuts the runs of equal
keys in its range into pages as it reads them. A run inside a range is a key's whole list; only
the first and the last run of a range may go on in others, and their pages are put together
from the runs' lengths: two numbers a range.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gleanstar.session import stage

# Values per page, at every size of the table.
PAGE_SIZE = 1000
# Values a task lays out at once.
_LAID_OUT = 1 << 18


def _cut_runs(keys: int, page_size: int, laid_out: int):
    """(key columns, part, run, page, n, values) of each page of each run of equal keys, from sorted
    rows (key columns, value, copies); pages count within the run. Runs in Python workers,
    which need no more of this package than this function."""

    def rows(columns, part, runs, pages, edges, values):
        n = np.diff(edges)
        lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values)
        count = len(n)
        whole = [*columns, pa.array(np.full(count, part), pa.int64()), pa.array(runs, pa.int64()), pa.array(pages, pa.int64()), pa.array(n, pa.int64()), lists]
        return pa.RecordBatch.from_arrays(whole, [*(f"k{i}" for i in range(keys)), "part", "run", "page", "n", "values"])

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held = last = None
        runs, at = -1, 0
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            columns, value, copies = batch.columns[:keys], batch.column(keys), batch.column(keys + 1).to_numpy()
            # rows whose key is not that of the row before
            new = np.zeros(size, bool)
            new[0] = last is None
            for i, c in enumerate(columns):
                both = pa.concat_arrays([c.slice(0, 1) if last is None else last[i], c]).dictionary_encode()
                codes = both.indices.fill_null(-1).to_numpy()
                new |= codes[1:] != codes[:-1]
            run_of = runs + np.cumsum(new)
            ends = np.cumsum(copies)
            # where the run of each row begins, counted from this batch's first value
            begun = np.maximum.accumulate(np.where(new, np.arange(size), -1))
            origin = np.where(begun >= 0, (ends - copies)[begun], -at)
            total = int(ends[-1])
            for low in range(0, total, laid_out):
                place = np.arange(low, min(low + laid_out, total))
                row = np.searchsorted(ends, place, "right")
                page, number, values, source = (place - origin[row]) // page_size, run_of[row], value.take(pa.array(row)), columns
                if held is not None:
                    # the page that the values before these have begun
                    kept, was_run, was_page, begun_values = held
                    n = len(begun_values)
                    values = pa.concat_arrays([begun_values, values])
                    number, page = np.append(np.full(n, was_run), number), np.append(np.full(n, was_page), page)
                    row = np.append(np.zeros(n, np.int64), row + 1)
                    source = [pa.concat_arrays([k, c]) for k, c in zip(kept, columns, strict=True)]
                cuts = np.flatnonzero((np.diff(number) != 0) | (np.diff(page) != 0)) + 1
                edges = np.concatenate([[0], cuts])
                if len(edges) > 1:
                    first = edges[:-1]
                    yield rows([c.take(pa.array(row[first])) for c in source], part, number[first], page[first], edges, values)
                end = int(edges[-1])
                held = [c.take(pa.array(row[end : end + 1])) for c in source], int(number[end]), int(page[end]), values.slice(end)
            runs, at, last = int(run_of[-1]), total - int(origin[-1]), [c.slice(size - 1, 1) for c in columns]
        if held is not None:
            kept, was_run, was_page, values = held
            yield rows(kept, part, [was_run], [was_page], np.array([0, len(values)]), values)

    return run


def paged_values(
    pairs: DataFrame, keys: Sequence[str], value: str, name: str, copies: str | None = None, page_size: int = PAGE_SIZE
) -> DataFrame:
    """keys + page + array `name`: the key's sorted list, cut into pages of `page_size` values.

    `pairs` holds one row per (keys, value) without NULLs; with `copies` a value is repeated
    that many times. Pages count from 0 and follow each other, so the pages of a key, one
    after another, are its whole sorted list. Neither a key nor its list is ever sorted in
    one task. The runs are stored when this is called.
    """
    keys = list(keys)
    weight = F.lit(1) if copies is None else F.col(copies)
    rows = pairs.select(*keys, value, weight.cast("bigint").alias("_copies")).filter(F.col("_copies") > 0)
    ranged = rows.repartitionByRange(*keys, value).sortWithinPartitions(*keys, value)
    kinds = [f.dataType.simpleString() for f in rows.schema]
    names = [f"k{i}" for i in range(len(keys))]
    ddl = ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=False))
    ddl += f", part long, run long, page long, n long, values array<{kinds[len(keys)]}>"
    runs = stage(ranged.mapInArrow(_cut_runs(len(keys), page_size, _LAID_OUT), ddl), "list_runs")
    # one row a range
    last = runs.groupBy("part").agg(F.max("run").alias("last"))
    marked = runs.join(F.broadcast(last), "part").withColumn("outer", (F.col("run") == 0) | (F.col("run") == F.col("last")))
    inner = marked.filter(~F.col("outer")).select(*names, "page", "values")
    outer = marked.filter("outer")
    # at most two rows a range
    lengths = outer.groupBy(*names, "part", "run").agg(F.sum("n").alias("length"))
    before = F.sum("length").over(W.partitionBy(*names).orderBy("part", "run")) - F.col("length")
    starts = lengths.select("part", "run", before.alias("before"))
    size = F.lit(page_size).cast("bigint")
    placed = outer.join(F.broadcast(starts), ["part", "run"]).withColumn("low", F.col("before") + F.col("page") * size)
    pages = F.sequence(F.floor(F.col("low") / size), F.floor((F.col("low") + F.col("n") - 1) / size))
    cut = placed.withColumn("to", F.explode(pages))
    start = F.greatest(F.col("to") * size - F.col("low"), F.lit(0))
    stop = F.least((F.col("to") + 1) * size - F.col("low"), F.col("n"))
    piece = F.struct("low", F.slice("values", (start + 1).cast("int"), (stop - start).cast("int")).alias("v"))
    joined = cut.groupBy(*names, F.col("to").alias("page")).agg(F.array_sort(F.collect_list(piece)).alias("parts"))
    joined = joined.select(*names, "page", F.flatten(F.col("parts.v")).alias("values"))
    return inner.unionByName(joined).select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], "page", F.col("values").alias(name))
