from datetime import datetime

import __spark_entry__ as entry
from pagliaio.streaming import deduplicated, observe_stream, sessions, upsert_sink, windowed_counts


def run(df, name, mode="append"):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination(180)
    return df.sparkSession.sql(f"SELECT * FROM {name}").collect()


def stamp(hour, minute=0):
    return datetime(2026, 1, 1, hour, minute)


def test_observe_stream_over_several_batches(spark, tmp_path):
    schema = "source string, source_id string, at timestamp, price long"
    rows = [[("s", "1", stamp(2), 100), ("s", "1", stamp(1), 90), ("s", "2", stamp(1), None)], [("s", "1", stamp(3), 100), ("s", "2", stamp(2), 50)], [("s", "1", stamp(4), None), ("s", "2", stamp(3), 60), ("s", "2", stamp(1), 1)]]
    for k, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / f"in/b={k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    got = sorted((r.source_id, r["at"], r.event, r.price, r.previous) for r in run(observe_stream(stream), "observed"))
    assert got == [("1", stamp(1), "new", 90, None), ("1", stamp(2), "change", 100, 90), ("2", stamp(1), "new", None, None), ("2", stamp(3), "change", 60, 50)]


def test_upsert_sink_and_replay(spark, tmp_path):
    write = upsert_sink(str(tmp_path / "t"), ["k"], "seq")
    first = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "k string, v int, seq int")
    second = spark.createDataFrame([("a", 2, 2), ("a", 3, 1)], "k string, v int, seq int")
    write(first, 0)
    write(second, 1)
    write(second, 1)
    assert {(r.k, r.v) for r in spark.read.parquet(str(tmp_path / "t/v=1")).collect()} == {("a", 2), ("b", 1)}


def test_windows_sessions_and_dedupe(spark):
    schema = spark.read.parquet("/root/testdata/sf0.001/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet("/root/testdata/sf0.001")
    n = spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert sum(r["n"] for r in run(windowed_counts(stream), "tumbling", "complete")) == n
    assert sum(r["n"] for r in run(sessions(stream), "sessions", "complete")) == n
    assert len(run(deduplicated(stream), "deduplicated")) == n


def test_results_of_streams_stay_out_of_the_driver(spark, tmp_path):
    """A folder of files is read like one file, and no result passes through a table in the driver's memory."""
    whole = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    whole.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    users = whole.groupBy("user_id").count().collect()
    for name, check in (("stream_distinct", lambda rows: [r.n for r in rows] == [whole.count()]), ("stream_sessions", lambda rows: sorted((r.user_id, r.n) for r in rows) == sorted(tuple(r) for r in users)), ("stream_windows", lambda rows: sum(r.n for r in rows) == whole.count())):
        df = entry.queries()[name](spark, str(tmp_path))
        plan = df._jdf.queryExecution().analyzed().toString()
        assert "MemoryPlan" not in plan and "parquet" in plan
        assert check(df.collect()), name


def test_stream_over_no_events(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(0).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    assert [r.n for r in entry.queries()["stream_distinct"](spark, str(tmp_path)).collect()] == [0]
    assert entry.queries()["stream_sessions"](spark, str(tmp_path)).collect() == []
