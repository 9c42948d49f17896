"""Add columns that are computed from Arrow batches in a narrow stage."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType


def with_results(
    df: DataFrame,
    inputs: Sequence[str],
    results: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
    added: pa.Schema,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """`df` with the columns that `results` makes of `inputs`, row by row and in order.

    `results` gets batches with the input columns only and yields batches that add up to
    as many rows. Only `keep` (by default all columns) passes through besides; columns
    named like an added one give way to it.
    """
    names = set(added.names)
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    # A column that is kept and an input is sent to Python once.
    sent = [*kept, *[c for c in dict.fromkeys(inputs) if c not in kept]]
    packed = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(sent)])
    schema = StructType([*packed.schema.fields[: len(kept)], *from_arrow_schema(added).fields])
    n, places = len(kept), [sent.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            given = pa.RecordBatch.from_arrays(
                [batch.column(i) for i in places], names=[f"i{i}" for i in range(len(places))]
            )
            for made in results(given):
                rest = batch.slice(at, made.num_rows)
                columns = [rest.column(i) for i in range(n)] + made.columns
                yield pa.RecordBatch.from_arrays(
                    columns, names=[*[f"k{i}" for i in range(n)], *made.schema.names]
                )
                at += made.num_rows

    return packed.mapInArrow(run, schema).withColumnsRenamed(
        {f"k{i}": c for i, c in enumerate(kept)}
    )


def aside(
    df: DataFrame, names: Sequence[str], job: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """`job(df)` with the columns of `df`, where the job adds columns called `names`: those of
    `df` that are called so are renamed meanwhile and keep their values."""
    hidden = {c: f"_aside_{c}" for c in df.columns if c in names}
    done = job(df.withColumnsRenamed(hidden))
    return done.select(*[F.col(f"`{hidden.get(c, c)}`").alias(c) for c in df.columns])
