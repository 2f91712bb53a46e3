"""Small helpers of the operators: tables, stored intermediate results, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from crawlframe.session import run_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until ``df`` has no such column, in whatever case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: short lineage, one evaluation, no local state."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable[[dict], dict | None], schema: str, columns: dict[str, pa.DataType], rows: int = 2048) -> DataFrame:
    """``fn`` over column lists of at most ``rows`` rows; it returns columns in the order of ``columns``."""
    names = list(columns)
    out = pa.schema([pa.field(n, t) for n, t in columns.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                got = fn({n: c.to_pylist() for n, c in zip(part.schema.names, part.columns, strict=True)})
                if got is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(got[n], type=out.field(n).type) for n in names], schema=out)

    return df.mapInArrow(run, schema)
