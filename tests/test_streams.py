"""Streams over several files, one per batch, against the batch operators."""

import random

import pytest
from pyspark.sql import functions as F

from crawlframe.operators.dedup import dedup_by_content
from crawlframe.operators.filters import route_fetches
from crawlframe.operators.frontier import politeness_slots
from crawlframe.plans.pages import expand_frontier
from crawlframe.streaming import batches
from crawlframe.streaming import dedup as stream_dedup
from crawlframe.streaming import frontier as stream_frontier
from crawlframe.streaming import routing

FETCHES = "seq long, url string, html string, content_type string, accessed_s long"


def file_stream(spark, root, rows, schema, parts=3):
    """A stream of ``parts`` files holding the rows in order, one file per batch."""
    step = -(-len(rows) // parts)
    for i in range(parts):
        spark.createDataFrame(rows[i * step:(i + 1) * step], schema).coalesce(1).write.mode("append").parquet(f"{root}/input")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/input")


@pytest.fixture(scope="module")
def fetch_rows():
    rng = random.Random(6)
    types = ["text/html", "application/pdf", None, "text/plain"]
    return [(i, f"http://h{rng.randint(0, 9)}.si/p{rng.randint(0, 60)}", f'<a href="/p{rng.randint(0, 60)}">t{rng.randint(0, 40)}</a>',
             rng.choice(types), 1000 + i // 2) for i in range(180)]


@pytest.mark.parametrize("spread", [None, "seq"])
def test_dedup_urls(spark, tmp_path, fetch_rows, spread):
    root = str(tmp_path)
    stream_dedup.start_dedup_urls(file_stream(spark, root, fetch_rows, FETCHES), root, spread).awaitTermination()
    got = [r.url for r in spark.read.parquet(f"{root}/urls").collect()]
    assert len(got) == len(set(got)) and set(got) == {r[1] for r in fetch_rows}


def test_dedup_content(spark, tmp_path, fetch_rows):
    root = str(tmp_path)
    stream_dedup.start_dedup_content(file_stream(spark, root, fetch_rows, FETCHES), root).awaitTermination()
    cols = ["seq", "page_type_code", "html", "html_hash"]
    got = sorted(map(tuple, spark.read.parquet(f"{root}/pages").select(*cols).collect()))
    want = sorted(map(tuple, dedup_by_content(spark.createDataFrame(fetch_rows, FETCHES)).select(*cols).collect()))
    assert [g[:2] for g in got] == [w[:2] for w in want] and got == want


def test_frontier_expand(spark, tmp_path, fetch_rows):
    root = str(tmp_path)
    stored = spark.createDataFrame([("http://h1.si/p1",), ("http://h2.si/p2",)], "url string")
    exclude = spark.createDataFrame([("http://h3.si",)], "domain string")
    stream = file_stream(spark, root, fetch_rows, FETCHES)
    stream_frontier.start_frontier_expand(stream, root, stored, exclude=exclude).awaitTermination()
    got = spark.read.parquet(f"{root}/frontier").select("host", "seq", "pos", "parent_url", "url")
    want = expand_frontier(spark.createDataFrame(fetch_rows, FETCHES), stored, exclude=exclude)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_politeness(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, rng.randint(0, 9), i * 5, 40) for i in range(400)]
    schema = "seq long, host long, arrival_us long, limit_us long"
    root = str(tmp_path)
    stream_frontier.start_politeness(file_stream(spark, root, rows, schema, 4), root).awaitTermination()
    got = {r.seq: r.slot_us for r in spark.read.parquet(f"{root}/slots").collect()}
    assert got == {r.seq: r.slot_us for r in politeness_slots(spark.createDataFrame(rows, schema)).collect()}


def test_route_results(spark, tmp_path, fetch_rows):
    root, seen = str(tmp_path), []

    def store(route):
        def handle(df, batch_id):
            seen.append((route, batch_id))
            batches.write_batch(df.select("seq"), f"{root}/out/route={route}", batch_id)
        return handle

    handlers = {"website": store("website"), "document": store("document")}
    routing.start_route_results(file_stream(spark, root, fetch_rows, FETCHES), root, handlers).awaitTermination()
    want = route_fetches(spark.createDataFrame(fetch_rows, FETCHES)).where(F.col("route") != "skip").select("route", "seq")
    got = spark.read.parquet(f"{root}/out").select("route", "seq")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert len(seen) == 6


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.range(5)
    for _ in range(2):
        batches.write_batch(rows, path, 0)
    assert spark.read.parquet(path).count() == 5
    assert batches.earlier_batches(spark, path, rows.schema, 1).count() == 5
    assert batches.earlier_batches(spark, path, rows.schema, 0).count() == 0
