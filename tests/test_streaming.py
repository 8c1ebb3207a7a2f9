from __future__ import annotations

from tessera.streaming import feeds


def run(df, mode, name):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.sql(f"select * from {name}")


def test_stream_equals_batch(spark, sf_dir):
    stream = run(feeds.windowed(feeds.event_stream(spark, sf_dir)), "complete", "windows")
    key = lambda r: (r.window_start, r.event_type, r.n)
    assert sorted(map(key, stream.collect())) == sorted(map(key, feeds.event_windows(spark, sf_dir).collect()))


def test_state(spark, sf_dir):
    rows = run(feeds.first_seen(feeds.event_stream(spark, sf_dir)), "update", "firsts").collect()
    assert rows and all(r.is_new for r in rows)


def state(spark, path):
    return {r.k: r.v for r in feeds.current(spark, path).collect()}


def test_upsert(spark, tmp_path):
    path = f"{tmp_path}/state"
    apply = feeds.upsert_by_batch(path, ["k"], buckets=4)
    assert feeds.current(spark, path) is None
    batch = lambda *rows: spark.createDataFrame(list(rows), "k int, v string")
    apply(batch((1, "a"), (2, "b"), (None, "n")), 0)
    apply(batch((2, "c")), 1)
    assert state(spark, path) == {1: "a", 2: "c", None: "n"}
    apply(batch((2, "c")), 1)  # the same batch again
    apply(batch((3, "d"), (None, "m")), 0)  # after a lost checkpoint batches start anew
    apply(batch(), 2)
    assert state(spark, path) == {1: "a", 2: "c", 3: "d", None: "m"}


def test_upsert_rewrites_touched_buckets_and_keeps_the_latest_version(spark, tmp_path):
    path = f"{tmp_path}/state"
    apply = feeds.upsert_by_batch(path, ["k"], version="t", buckets=8)
    batch = lambda *rows: spark.createDataFrame(list(rows), "k int, t int, v string")
    apply(batch(*[(k, 1, f"v{k}") for k in range(200)]), 0)
    apply(batch((5, 3, "new"), (5, 2, "late"), (6, 0, "too late")), 1)
    assert len([p for p in (tmp_path / "state/step=1").iterdir() if p.name.startswith("bucket=")]) <= 2
    got = state(spark, path)
    assert got == {k: f"v{k}" for k in range(200)} | {5: "new"}


def test_an_unfinished_step_is_passed_over(spark, tmp_path):
    path = f"{tmp_path}/state"
    apply = feeds.upsert_by_batch(path, ["k"])
    apply(spark.createDataFrame([(1, "a")], "k int, v string"), 0)
    (tmp_path / "state/step=1/bucket=0").mkdir(parents=True)
    apply(spark.createDataFrame([(1, "b")], "k int, v string"), 1)
    assert state(spark, path) == {1: "b"}
