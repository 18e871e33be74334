"""Tables in the shared folder that cut lineage, and Arrow plumbing for row-wise operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from receiptflow.session import ship_package
from receiptflow.workspace import fresh_folder as fresh_path
from receiptflow.workspace import written

__all__ = ["add_columns", "blocks", "drop_folder", "drop_written", "fresh_path", "inner_names", "quoted", "without", "written"]


def inner_names(*names: str) -> list[str]:
    """Names for columns that an operator needs on the way, which no table has: made up anew for each call."""
    tag = uuid.uuid4().hex[:12]
    return [f"__{n}_{tag}" for n in names]


def quoted(name: str) -> str:
    """A column's name for ``F.col``, whatever characters it has."""
    return f"`{name.replace('`', '``')}`"


def drop_written(df: DataFrame) -> None:
    """Deletes the files behind a table of ``written`` that no later plan reads."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        drop_folder(df.sparkSession, folder)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder with all that is in it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns whose names (in any case) clash with those an operator adds."""
    taken = {n.lower() for n in names}
    return df.select(*[df[quoted(c)] for c in df.columns if c.lower() not in taken])


def add_columns(
    df: DataFrame,
    fields: list[T.StructField],
    make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
    weigh: str,
    block_bytes: int = 1 << 20,
) -> DataFrame:
    """Each row of ``df`` with further columns computed in Arrow batches; input columns of the same names go.

    ``make`` runs once in each task and returns the function from a batch to its new columns. Batches hold
    rows whose column ``weigh`` is about ``block_bytes`` long together, and one row at least, so memory is
    bounded by the block or the longest single value.
    """
    ship_package(df.sparkSession)
    kept = without(df, [f.name for f in fields])
    names = kept.columns
    # mapInArrow does not take names with dots, so columns go through under plain ones
    plain = [T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate([*kept.schema.fields, *fields])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for block in blocks(batch.rename_columns(names), weigh, block_bytes):
                new = compute(block)
                yield pa.RecordBatch.from_arrays([*block.columns, *new], names=[f.name for f in plain])

    moved = kept.toDF(*[f.name for f in plain[: len(names)]]).mapInArrow(run, T.StructType(plain))
    return moved.toDF(*names, *[f.name for f in fields])


def blocks(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of about ``most`` bytes of ``column``, of list elements if it has lists, one row at least each."""
    values = batch.column(column)
    size = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
    lengths = pc.fill_null(size(values), 0).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > most:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += int(n)
    if first < batch.num_rows:
        yield batch.slice(first)
