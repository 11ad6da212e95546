"""Moving text between Spark and Python tasks in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE_BYTES = 2 << 20
SLICE_ROWS = 2048


_held: list[tuple[str, object, object]] = []


def held(kind: str, source: object, build: Callable[[], object]) -> object:
    """What ``build`` makes of ``source`` (a broadcast value), kept by a Python worker until it makes something else.

    Workers are used again by the tasks of other operators: one slot for all of them, so that
    no task starts on top of the tables of those before it.
    """
    if not (_held and _held[0][0] == kind and _held[0][1] is source):
        del _held[:]
        _held.append((kind, source, build()))
    return _held[0][2]


def text_bytes(name: str) -> Column:
    """The UTF-8 bytes of a text column; null is empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b"").cast("binary"))


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``most`` bytes in a binary column, or one row."""
    lengths = [len(v.as_buffer()) if v.is_valid else 0 for v in batch.column(column)]
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and (total + n > most or i - start >= SLICE_ROWS):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield batch.slice(start)


def map_rows(df: DataFrame, schema: T.StructType, convert: Callable[[pa.RecordBatch], list[Iterable]], heavy: str, most: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` over slices of the batches: ``convert`` returns the columns of ``schema``."""
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for part in slices(batch, heavy, most):
                columns = [
                    c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                    for c, f in zip(convert(part), arrow, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, schema)


def field(df: DataFrame, name: str, alias: str | None = None) -> T.StructField:
    """The type of an input column, nullable, for an output schema."""
    return T.StructField(alias or name, df.schema[name].dataType, True)
