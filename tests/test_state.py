"""State of streams and stores: keyed tables, keyed stream state, restarts, batches that run twice."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlframe.operators.frontier import politeness_slots
from crawlframe.sources.keyed import FAN, KeyedTable
from crawlframe.streaming import dedup as stream_dedup
from crawlframe.streaming import frontier as stream_frontier

PAIR = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
REQUESTS = "seq long, host long, arrival_us long, limit_us long"
FETCHES = "seq long, url string, html string, content_type string, accessed_s long"


def pairs(spark, rows):
    return spark.createDataFrame(rows, PAIR)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def feed(spark, root, schema, parts, start):
    """Drain the stream after each part: every part but the first meets a restarted query."""
    progress = []
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{root}/input")
        query = start(spark.readStream.schema(schema).parquet(f"{root}/input"))
        query.awaitTermination()
        progress += [p for p in query.recentProgress if p["numInputRows"]]
    return progress


def test_keyed_table_grows_like_a_counter(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "it's"), PAIR, ["k"])
    want = {}
    for batch in range(9):
        rows = [(str(k), k) for k in range(batch * 3, batch * 3 + 5)]
        fresh = table.before(batch).without(pairs(spark, rows))
        assert {r.k for r in fresh.collect()} == {k for k, _ in rows} - want.keys()
        table.add(fresh, batch)
        want |= dict(rows)
        runs = table.before(batch + 1).runs
        assert max(sum(r.level == level for r in runs) for level in (0, 1)) < FAN
    view = table.before(9)
    assert rows_of(view.all()) == sorted(want.items()) and view.rows == len(want)
    assert rows_of(view.matching(pairs(spark, [("4", 0), ("x", 0), ("4", 1)]))) == [("4", 4)]
    assert table.before(0).runs == [] and table.before(0).all().collect() == []


def test_a_batch_of_a_keyed_table_that_runs_twice(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), PAIR, ["k"], fold=F.max)
    for batch in range(2 * FAN):
        for _ in range(2):
            assert table.before(batch).rows == batch
            table.add(pairs(spark, [(str(batch), 1)]), batch)
    assert rows_of(table.before(99).all()) == sorted((str(k), 1) for k in range(2 * FAN))


def test_files_do_not_grow_with_batches_of_the_same_keys(spark, tmp_path):
    new_only, updated = (KeyedTable(spark, str(tmp_path / n), PAIR, ["k"], fold=F.max) for n in ("a", "b"))
    sizes = []
    for batch in range(10):
        rows = pairs(spark, [(str(k), batch) for k in range(20)])
        new_only.add(new_only.before(batch).without(rows), batch)
        updated.add(rows, batch)
        sizes.append((len(new_only.before(batch + 1).files()), len(updated.before(batch + 1).files())))
    assert {a for a, _ in sizes} == {sizes[0][0]}
    # Two levels of at most FAN - 1 runs; the tenth batch has no more than the third.
    assert sizes[9][1] <= sizes[FAN - 2][1] + 2 * sizes[0][1] and sizes[9][1] < 10 * sizes[0][1] / 2
    assert rows_of(updated.before(10).all()) == sorted((str(k), 9) for k in range(20))


def test_stored_side_is_not_shuffled(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), PAIR, ["k"])
    for batch in range(3):
        table.add(pairs(spark, [(f"{batch}-{k}", k) for k in range(50)]), batch)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = table.before(3).without(pairs(spark, [("1-1", 1), ("z", 2)]))
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("Bucketed: true") == 3
        assert rows_of(fresh) == [("z", 2)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def requests(n, hosts, parts, seed):
    """Requests in order of arrival within and over the parts, shuffled inside a part, equal arrivals included."""
    rng = random.Random(seed)
    rows = [(i, rng.choice(hosts), i // 3 * 7, 40) for i in range(n)]
    cut = [rows[k * n // parts : (k + 1) * n // parts] for k in range(parts)]
    for part in cut:
        rng.shuffle(part)
    return rows, cut


@pytest.mark.parametrize("first_waits", [False, True])
def test_politeness_keeps_hosts_by_key(spark, tmp_path, first_waits):
    rows, parts = requests(400, [0] * 8 + list(range(40)), 5, 8)
    root = str(tmp_path)
    start = lambda s: stream_frontier.start_politeness(s, root, first_waits)
    progress = feed(spark, root, REQUESTS, parts, start)
    got = {r.seq: r.slot_us for r in spark.read.parquet(f"{root}/slots").collect()}
    assert got == {r.seq: r.slot_us for r in politeness_slots(spark.createDataFrame(rows, REQUESTS), first_fetch_waits=first_waits).collect()}
    # A batch writes the hosts it has, and reads no others.
    for part, p in zip(parts, progress, strict=True):
        state, hosts = p["stateOperators"][0], {r[1] for r in part}
        assert state["numRowsUpdated"] == len(hosts)
        assert int(state["customMetrics"].get("rocksdbGetCount", 0)) <= 2 * len(hosts)
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == len({r[1] for r in rows})


def test_politeness_in_batches_equals_keyed_state(spark, tmp_path):
    rows, parts = requests(200, [0] * 20 + [1, 2, 3], 4, 9)
    root = str(tmp_path)
    feed(spark, root, REQUESTS, parts, lambda s: stream_frontier.start_politeness_batches(s, root))
    got = {r.seq: r.slot_us for r in spark.read.parquet(f"{root}/slots").collect()}
    assert got == {r.seq: r.slot_us for r in politeness_slots(spark.createDataFrame(rows, REQUESTS)).collect()}


def test_odd_requests(spark, tmp_path):
    rows = [(1, None, 5, 3), (2, None, 5, 3), (3, 7, None, None), (4, 7, 9, None), (5, 8, None, 4)]
    root = str(tmp_path)
    feed(spark, root, REQUESTS, [rows], lambda s: stream_frontier.start_politeness(s, root))
    got = {r.seq: r.slot_us for r in spark.read.parquet(f"{root}/slots").collect()}
    assert got == {1: 5, 2: 8, 3: None, 4: 9, 5: None}


def test_state_has_a_row_for_each_url(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, "https://hot.si" if i % 3 else f"http://h{rng.randint(0, 9)}.si/p{rng.randint(0, 60)}#x", f"<p>{rng.randint(0, 50)}", None, i) for i in range(600)]
    root = str(tmp_path)
    feed(spark, root, FETCHES, [rows[k * 150 : (k + 1) * 150] for k in range(4)], lambda s: stream_dedup.start_dedup_urls(s, root, order="seq"))
    urls = {r[1].split("#")[0].replace("https://hot.si", "http://hot.si/") for r in rows}
    state = stream_dedup.known_urls(spark.range(1), root).before(99)
    assert sorted(r.url for r in state.all().collect()) == sorted(urls) and state.rows == len(urls)
    firsts = {}
    for r in rows:
        firsts.setdefault(r[1].split("#")[0].replace("https://hot.si", "http://hot.si/"), r[0])
    assert {r.url: r.seq for r in spark.read.parquet(f"{root}/urls").collect()} == firsts
