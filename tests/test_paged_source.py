"""The ``paged`` data source: ranges, order, admission, restarts."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadlake.session import scratch_path
from acadlake.sources.paged_source import scan_pages, stream_pages
from acadlake.streaming.paged import PagedLoad

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def land(spark, root, numbers, record=lambda n: [{"k": n, "v": "x"}]):
    lines = [(n // 256, f"{n}\t" + json.dumps({"data": record(n)})) for n in numbers]
    spark.createDataFrame(lines, "faixa long, value string").coalesce(1).write.mode("append").partitionBy("faixa").text(root)


def numbers(df):
    return sorted(r[0] for r in df.select("pagina").collect())


def test_a_range_opens_its_folders_only(spark):
    root = scratch_path(spark, "src")
    land(spark, root, range(700))
    assert numbers(scan_pages(spark, root)) == list(range(700))
    part = scan_pages(spark, root, 250, 260, pages_per_partition=4)
    assert numbers(part) == list(range(250, 260))
    assert part.rdd.getNumPartitions() == 3                    # 250-253, 254-255 | 256-259
    assert scan_pages(spark, root, 256, 512).rdd.getNumPartitions() == 1


def test_no_pages_blank_lines_and_lines_without_number(spark, tmp_path):
    assert scan_pages(spark, scratch_path(spark, "nothing")).count() == 0
    folder = tmp_path / "faixa=0"
    folder.mkdir()
    (folder / "a.txt").write_text("\n0\t[]\r\n\n1\té\n", encoding="utf-8")
    assert [tuple(r) for r in scan_pages(spark, f"file:{tmp_path}").orderBy("pagina").collect()] == [(0, "[]"), (1, "é")]
    (folder / "b.txt").write_text("no number\n")
    with pytest.raises(Exception, match="does not start with a page number"):
        scan_pages(spark, str(tmp_path)).count()


def test_long_pages_come_whole(spark):
    root = scratch_path(spark, "src")
    land(spark, root, range(3), lambda n: [{"k": n, "v": "é" * 3_000_000}])
    size = len(json.dumps({"data": [{"k": 0, "v": "é" * 3_000_000}]}))
    assert [r[0] for r in scan_pages(spark, root).select(F.length("corpo")).collect()] == [size] * 3


def drain(spark, root, place, limit):
    """Page numbers of each batch that a run of the stream delivers."""
    got = []
    query = (stream_pages(spark, root, f"{place}/position", limit).writeStream
             .foreachBatch(lambda df, _: got.append(numbers(df))).option("checkpointLocation", f"{place}/log").start())
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return [batch for batch in got if batch]


def test_batches_are_bounded_and_a_restart_goes_on(spark):
    root, place = scratch_path(spark, "src"), scratch_path(spark, "state")
    land(spark, root, range(250, 263))
    assert drain(spark, root, place, 100) == []                 # page 0 has not landed: nothing is skipped
    land(spark, root, range(0, 250))
    assert drain(spark, root, place, 100) == [list(range(100)), list(range(100, 200)), list(range(200, 263))]
    assert drain(spark, root, place, 100) == []
    land(spark, root, [3, 264])                                 # a page again, and one behind a gap
    assert drain(spark, root, place, 100) == []
    land(spark, root, [263])
    assert drain(spark, root, place, 100) == [[263, 264]]


def test_a_failed_batch_is_delivered_again(spark):
    root, place = scratch_path(spark, "src"), scratch_path(spark, "state")
    land(spark, root, range(10))
    seen = []

    def fail(df, number):
        seen.append(numbers(df))
        if len(seen) == 2:
            raise RuntimeError("lost")

    query = (stream_pages(spark, root, f"{place}/position", 4).writeStream.foreachBatch(fail)
             .option("checkpointLocation", f"{place}/log").start())
    with pytest.raises(Exception, match="lost"):
        query.processAllAvailable()
    query.stop()
    assert seen == [[0, 1, 2, 3], [4, 5, 6, 7]]
    assert drain(spark, root, place, 4) == [[4, 5, 6, 7], [8, 9]]


def test_a_load_through_the_source(spark):
    root, place = scratch_path(spark, "src"), scratch_path(spark, "load")
    new = lambda: PagedLoad(spark, root, f"{place}/t", f"{place}/c", SCHEMA, "k")
    pages = {0: [(1, "a"), (2, "b")], 1: [(2, "again"), (3, "c")], 2: [(4, "d")], 3: [], 4: [(99, "behind the end")]}
    body = lambda n: [{"k": k, "v": v} for k, v in pages[n]]
    land(spark, root, [0, 2, 3, 4], body)
    load = new()
    assert load.run_in_order(2) == 1                            # page 1 is missing
    assert sorted(tuple(r) for r in load.result().select("k", "v").collect()) == [(1, "a"), (2, "b")]
    land(spark, root, [1], body)
    assert new().run_in_order(2) == 2
    assert sorted(tuple(r) for r in new().result().select("k", "v").collect()) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    assert new().run_in_order(2) == 0
    new().reset()
    assert new().result().count() == 0 and new().run_in_order(8) == 1 and new().result().count() == 4
