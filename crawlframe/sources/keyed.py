"""Tables of keys that grow batch by batch.

A table is kept as a few runs, each bucketed and sorted by its key, so that new rows are shuffled to the
runs and the runs to nothing. Every batch adds a run; as soon as ``FAN`` runs of a level have come together
they are written as one of the next level, so a row is written as often as the number of batches has digits
in base ``FAN``, and a batch reads no more than ``FAN - 1`` runs of each level. A batch without new keys
adds none.

A version of a table lists its runs. Batch ``N`` reads the last version before ``N`` and writes version
``N``: a batch that runs twice gives the same version. Runs that neither of the last two versions lists are
deleted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Runs of a level that are merged into one of the next.
FAN = 4


class Run(NamedTuple):
    run: str
    level: int
    rows: int
    buckets: int


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write rows to ``path``, bucketed and sorted by ``keys``. The catalog is left as it was."""
    name = f"crawlframe_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    writer.mode("overwrite").option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows that :func:`write_bucketed` wrote; joins and groups by ``keys`` need no shuffle of them."""
    name, by = f"crawlframe_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in keys)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    # The location is a text in SQL.
    where = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{where}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def buckets_of(spark: SparkSession) -> int:
    """Buckets that match the session's shuffles, so that a shuffled side meets the buckets as they are."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class KeyedView:
    """The rows of a keyed table as one batch sees them."""

    def __init__(self, table: KeyedTable, runs: Sequence[Run]) -> None:
        self.table, self.runs = table, runs

    @property
    def rows(self) -> int:
        """Rows written to the runs; the number of keys if no key was written twice."""
        return sum(r.rows for r in self.runs)

    def frames(self) -> list[DataFrame]:
        return [self.table.frame(r) for r in self.runs]

    def plain(self) -> list[DataFrame]:
        """The runs without their buckets. Spark 4.1 takes a union of bucketed scans for one bucketed table but then
        drops the buckets from the scans, so a group over the union would not bring a key's rows together."""
        return [self.table.spark.read.schema(self.table.schema).parquet(f"{self.table.root}/runs/{r.run}") for r in self.runs]

    def files(self) -> list[str]:
        return [f for frame in self.frames() for f in frame.inputFiles()]

    def without(self, df: DataFrame, on: Sequence[str] | None = None) -> DataFrame:
        """Rows of ``df`` whose key the table does not have. ``on`` names the key's columns in ``df``; NULLs are no key."""
        names = dict(zip(self.table.keys, on or self.table.keys, strict=True))
        for run in self.frames():
            known = run.select(*[F.col(k).alias(name) for k, name in names.items()])
            df = df.join(known, list(names.values()), "left_anti")
        return df

    def lookup(self, df: DataFrame, on: str, value: str, alias: str) -> DataFrame:
        """``df`` with the table's ``value`` for the key in its column ``on`` as ``alias``, NULL if the table has none.

        For tables of one key column whose keys are written once; the runs are not shuffled.
        """
        found = []
        for i, run in enumerate(self.frames()):
            found.append(f"_found{i}")
            df = df.join(run.select(F.col(self.table.keys[0]).alias(on), F.col(value).alias(found[-1])), on, "left")
        kind = self.table.schema[value].dataType
        return df.withColumn(alias, F.coalesce(*[F.col(c) for c in found]) if found else F.lit(None).cast(kind)).drop(*found)

    def union(self) -> DataFrame:
        """The rows of all runs as they were written."""
        frames = self.plain()
        return reduce(DataFrame.unionByName, frames) if frames else self.table.spark.createDataFrame([], self.table.schema)

    def matching(self, df: DataFrame) -> DataFrame:
        """Rows of the table whose key ``df`` has, one for each key; the runs are not shuffled."""
        t = self.table
        found = df.select(*t.keys).distinct()
        for i, run in enumerate(self.frames()):
            found = found.join(run.select(*t.keys, F.struct(*t.values, F.lit(1).alias("_one")).alias(f"_{i}")), t.keys, "left")
        if not self.runs:
            return t.spark.createDataFrame([], t.schema)
        each = F.explode(F.array_compact(F.array(*[F.col(f"_{i}") for i in range(len(self.runs))])))
        rows = found.select(*t.keys, each.alias("_row")).select(*t.keys, *[F.col("_row")[v].alias(v) for v in t.values])
        return t.folded(rows)

    def all(self) -> DataFrame:
        return self.table.folded(self.union())


class KeyedTable:
    """A table below ``root`` with the given ``schema`` and ``keys``; ``fold`` makes one value of several of a key."""

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], fold: Callable[[str], Column] = F.max, fan: int = FAN
    ) -> None:
        self.spark, self.root, self.schema, self.keys, self.fold, self.fan = spark, root, schema, list(keys), fold, fan
        self._read: dict[Run, DataFrame] = {}

    def frame(self, run: Run) -> DataFrame:
        if run not in self._read:
            self._read[run] = read_bucketed(self.spark, f"{self.root}/runs/{run.run}", self.schema, self.keys, run.buckets)
        return self._read[run]

    @property
    def values(self) -> list[str]:
        return [f.name for f in self.schema.fields if f.name not in self.keys]

    def folded(self, rows: DataFrame) -> DataFrame:
        if not self.values:
            return rows.select(*self.keys).distinct()
        return rows.groupBy(*self.keys).agg(*[self.fold(v).alias(v) for v in self.values]).select(*self.schema.names)

    def _path(self, part: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{part}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self) -> dict[int, list[Run]]:
        """Versions by batch; only the last few are there."""
        files, top = self._files(), self._path("versions")
        if not files.exists(top):
            return {}
        names = [entry.getPath().getName() for entry in files.listStatus(top)]
        out = {}
        for name in names:
            if name.endswith(".json"):
                stream = files.open(self._path(f"versions/{name}"))
                try:
                    said = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                finally:
                    stream.close()
                out[int(name.removesuffix(".json"))] = [Run(**r) for r in json.loads(said)]
        return out

    def _list(self, batch_id: int, runs: Sequence[Run]) -> None:
        """Write a version. It has its name only once it is whole."""
        files, part, whole = self._files(), self._path(f"versions/{batch_id}.part"), self._path(f"versions/{batch_id}.json")
        stream = files.create(part, True)
        stream.write(bytearray(json.dumps([r._asdict() for r in runs]).encode()))
        stream.close()
        files.delete(whole, False)
        if not files.rename(part, whole):
            raise OSError(f"cannot write {whole}")

    def started(self) -> bool:
        """Whether the table has a version."""
        return bool(self._versions())

    def before(self, batch_id: int) -> KeyedView:
        """The table as batches before ``batch_id`` left it."""
        known = {b: runs for b, runs in self._versions().items() if b < batch_id}
        return KeyedView(self, known[max(known)] if known else [])

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Add the rows of a batch, evaluated once. Given a key that is there already, both rows count until they are folded."""
        versions = self._versions()
        earlier = {b: runs for b, runs in versions.items() if b < batch_id}
        runs = list(earlier[max(earlier)]) if earlier else []
        # Runs of full levels go into the new one: like a carry when counting.
        level, merged = 0, []
        while len(full := [r for r in runs if r.level == level]) + 1 >= self.fan:
            merged += full
            level += 1
        buckets = runs[0].buckets if runs else buckets_of(self.spark)
        new = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        if merged:
            new = self.folded(reduce(DataFrame.unionByName, [new, *KeyedView(self, merged).plain()]))
        name = f"batch={batch_id}"
        self._read = {run: frame for run, frame in self._read.items() if run.run != name}
        write_bucketed(new.repartition(buckets, *self.keys), f"{self.root}/runs/{name}", self.keys, buckets)
        size = self.spark.read.schema(self.schema).parquet(f"{self.root}/runs/{name}").count()
        if size:
            runs = [*(r for r in runs if r not in merged), Run(name, level, size, buckets)]
        self._list(batch_id, runs)
        self._drop_unused(earlier, runs)

    def _drop_unused(self, earlier: dict[int, list[Run]], runs: Sequence[Run]) -> None:
        """Delete versions before the one that this batch read, and the runs that only they list."""
        if not earlier:
            return
        last = max(earlier)
        used = {r.run for r in (*runs, *earlier[last])}
        files = self._files()
        for b in earlier:
            if b < last:
                for r in earlier[b]:
                    if r.run not in used:
                        files.delete(self._path(f"runs/{r.run}"), True)
                files.delete(self._path(f"versions/{b}.json"), False)
