"""Writers and readers of the crawl store (Parquet)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlframe import schema
from crawlframe.functions.content import content_bytes, mime_extension
from crawlframe.functions.urls import url_basename, url_domain
from crawlframe.operators.filters import filter_empty_refs, filter_image_sources, filter_image_types
from crawlframe.operators.frontier import frontier_positions
from crawlframe.operators.ids import assign_ids
from crawlframe.sources.keyed import KeyedTable

QUEUE = T.StructType(schema.FRONTIER.fields + [T.StructField("seq", T.LongType(), True), T.StructField("pos", T.IntegerType(), True)])


def conform(df: DataFrame, table: T.StructType) -> DataFrame:
    """Columns of ``df`` in the order and types of a table; columns it lacks become NULL."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.fields
    ])


def write_rows(df: DataFrame, path: str, batch_id: int | None = None, partition_by: str | None = None) -> None:
    """Append rows. With ``batch_id`` they replace that batch's own directory, so a repeated batch adds nothing."""
    target = path if batch_id is None else f"{path}/batch_id={batch_id}"
    writer = df.write.mode("append" if batch_id is None else "overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(target)


def write_pages(pages: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Page rows, one directory per page type, so that reports by type read only what they need."""
    write_rows(conform(pages, schema.PAGE), path, batch_id, "page_type_code")


def stored_before(spark: SparkSession, path: str, table: T.StructType, batch_id: int, since: int = 0) -> DataFrame:
    """Rows that batches from ``since`` on and before ``batch_id`` wrote below ``path``; the filter prunes directories."""
    if batch_id == 0:
        return spark.createDataFrame([], table)
    full = T.StructType(table.fields + [T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).parquet(path).where(F.col("batch_id").between(since, batch_id - 1)).drop("batch_id")


def page_data_rows(documents: DataFrame) -> DataFrame:
    """Binary documents: the text content as UTF-8 bytes."""
    return conform(documents.withColumn("data", content_bytes(F.col("content"))), schema.PAGE_DATA)


def write_page_data(documents: DataFrame, path: str, batch_id: int | None = None) -> None:
    write_rows(page_data_rows(documents), path, batch_id)


def store_index(spark: SparkSession, root: str) -> dict[str, KeyedTable]:
    """What batches look up in the store below ``root``: URLs, contents, hosts and the last id of each table."""

    def table(name: str, key: str, value: str | None = None) -> KeyedTable:
        fields = [T.StructField(key, T.StringType())] + ([T.StructField(value, T.LongType())] if value else [])
        return KeyedTable(spark, f"{root}/index/{name}", T.StructType(fields), [key])

    return {"url": table("url", "url", "id"), "content": table("content", "html_hash"), "site": table("site", "domain", "id"), "last": table("last", "name", "id")}


def image_rows(images: DataFrame, start: int = 1) -> DataFrame:
    """Images of the known types, numbered from ``start``, with the base name of their source as file name.

    ``images`` has (page_id, pos, src, content_type) and optionally content and accessed_time. A
    ``data:`` URI has no file name and is its own content; its type stands in its text.
    """
    is_data = F.lower(F.substring("src", 1, 5)) == "data:"
    typed = filter_image_sources(filter_empty_refs(images, "src")).withColumn(
        "extension", mime_extension(F.when(is_data, F.col("src")).otherwise(F.col("content_type")))
    )
    content = F.col("content") if "content" in images.columns else F.lit(None).cast("string")
    rows = filter_image_types(typed).withColumns({
        "_key": F.concat_ws(":", "page_id", "pos"),
        "filename": F.when(is_data, F.lit("")).otherwise(url_basename(F.col("src"))),
        "content_type": F.col("extension"),
        "data": content_bytes(F.when(is_data, F.col("src")).otherwise(content)),
    })
    # Keys alone are numbered; contents meet their ids in a join.
    return rows.join(assign_ids(rows.select("_key"), "_key", start=start), "_key").select("id", *[c for c in rows.columns])


def write_images(images: DataFrame, path: str, batch_id: int | None = None, start: int | None = None) -> None:
    """Store images. Ids go on from ``start``, or else from the highest that ``path`` has, or that its earlier batches have."""
    if start is None:
        start = last_id(images.sparkSession, path, batch_id) + 1
    write_rows(conform(image_rows(images, start), schema.IMAGE), path, batch_id)


def last_id(spark: SparkSession, path: str, batch_id: int | None) -> int:
    """Highest id below ``path``, of the batches before ``batch_id`` if given; 0 if there is none."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not top.getFileSystem(spark._jsc.hadoopConfiguration()).exists(top):
        return 0
    rows = spark.read.schema("id long, batch_id long").parquet(path)
    if batch_id is not None:
        rows = rows.where(F.col("batch_id") < batch_id)
    return rows.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]


def write_links(edges: DataFrame, path: str, batch_id: int | None = None) -> None:
    write_rows(conform(edges, schema.LINK), path, batch_id)


def save_frontier(queue: DataFrame, root: str, version: int) -> None:
    """Store the frontier (url, parent_url, seq and, where it has one, pos) as a new version; the log entry makes it current.

    Earlier versions are left alone, so a failed save loses nothing.
    """
    conform(queue, QUEUE).write.mode("overwrite").parquet(f"{root}/rows/version={version}")
    spark = queue.sparkSession
    spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(f"{root}/log")


def load_frontier(spark: SparkSession, root: str) -> DataFrame:
    """The current frontier as host queues (host, url, parent_url, seq, pos, position), in order of seq, then pos."""
    version = spark.read.schema("version long").parquet(f"{root}/log").agg(F.max("version")).first()[0]
    rows = spark.read.schema(QUEUE).parquet(f"{root}/rows/version={version}")
    return frontier_positions(rows.withColumn("host", url_domain(F.col("url"))), ["pos"])
