"""Shared helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shelfspark.operators.skew import landed

__all__ = ["add_columns", "crc_mod", "fresh", "landed", "spread_rows"]

# Rows whose texts are Python strings at the same time; an Arrow batch may hold more.
ROWS_AT_ONCE = 256


def fresh(columns: Iterable[str], *names: str) -> list[str]:
    """The wanted names, with underscores added where a column already has the name."""
    taken = {c.lower() for c in columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def crc_mod(key: str, by: int) -> Column:
    """crc32 of an id written as text, modulo `by`; null ids count as 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(by)), F.lit(0))


def spread_rows(df: DataFrame) -> DataFrame:
    """The rows over all cores where the input is a file or two, as in a small test table."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) == 1 else df


def add_columns(
    rows: DataFrame, text: str, fields: list[tuple[str, T.DataType]],
    start: Callable[[], Callable[..., dict[str, list[Any]]]], also: tuple[str, ...] = (),
    at_once: int = ROWS_AT_ONCE,
) -> DataFrame:
    """The same rows with more columns, which Python computes from whole texts.

    `start()` runs once per task and returns the function that maps a list of texts (and one
    list for each column in `also`) to a list per new column, `at_once` rows a call.  Rows stay where they are:
    nothing is shuffled, and a lost task repeats its own input only.
    """
    made = [T.StructField(name, kind, True) for name, kind in fields]
    kinds = [to_arrow_type(kind) for _, kind in fields]
    wanted = [rows.columns.index(c) for c in (text, *also)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for low in range(0, batch.num_rows, at_once):
                part = batch.slice(low, at_once)
                out = work(*(part.column(i).to_pylist() for i in wanted))
                new = [pa.array(out[name], kind) for (name, _), kind in zip(fields, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *new], names=[*part.schema.names, *(name for name, _ in fields)])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *made]))
