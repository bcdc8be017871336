"""Streams over the stage log against their batch twins: restarts, replays, and what stays on disk."""

import os
import random

from pyspark.sql import functions as F

from cutlight.operators import operations as op
from cutlight.sources.versions import closed
from cutlight.streaming import stage_log as sl

LOG = "movie_id bigint, event_id bigint, stage string, ts_us bigint, seq bigint, status string, fingerprint bigint"
STATES = ("COMPLETE", "RUNNING", "FAILED_RETRYABLE", "FAILED_FINAL", "PENDING")


def rows(n, seed=1):
    rng = random.Random(seed)
    return [(rng.randint(0, 2), rng.randint(0, 4), rng.choice("ab"), rng.randint(0, 50), i, rng.choice(STATES), rng.randint(0, 1)) for i in range(n)]


def test_states_follow_the_log_and_stay_small(spark, tmp_path):
    log, target = f"{tmp_path}/log", f"{tmp_path}/states"
    data, sizes = rows(240), []
    for i in range(12):
        part = data[i * 20 : i * 20 + 20] + (data[:5] if i == 7 else [])  # a replay
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(log)
        sl.upsert_states(sl.read_log(spark, log, LOG), target, f"{tmp_path}/checkpoint", 3)
        sizes.append(len(os.listdir(target)))
        want = op.stage_state(spark.createDataFrame(data[: i * 20 + 20], LOG), ["seq"])
        if i in (0, 2, 7, 11):
            assert sorted(map(tuple, sl.read_corrected(spark, target).collect())) == sorted(map(tuple, want.collect()))
    assert max(sizes) <= 5
    # a base that was not closed is not read, and a batch that runs again writes over its own delta
    (last,) = closed(spark, target, "base")[-1:]
    os.makedirs(f"{target}/base={last + 100}")
    want = op.stage_state(spark.createDataFrame(data, LOG), ["seq"])
    assert sorted(map(tuple, sl.read_corrected(spark, target).collect())) == sorted(map(tuple, want.collect()))


def test_streaks_grow_over_batches_and_skip_replays(spark, tmp_path):
    log, out = f"{tmp_path}/log", f"{tmp_path}/out"
    rng, data = random.Random(3), []
    for i in range(200):
        data.append((i % 2, 0, "a", i, i, data[-2][5] if i > 1 and rng.random() < 0.8 else rng.choice(STATES), 0))
    schema = "movie_id bigint, seq bigint, ts_us bigint, status string"
    for a, b in ((0, 60), (40, 110), (110, 112), (112, 200)):
        spark.createDataFrame(data[a:b], LOG).select("movie_id", "seq", "ts_us", "status").coalesce(1).write.mode("append").parquet(log)
        got = sl.failure_streaks(sl.read_log(spark, log, schema), 4)
        got.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination(60)
    want = op.failure_streaks(spark.createDataFrame(data, LOG), ["seq"], 4)
    got = sl.longest(spark.read.schema(got.schema).parquet(out)).select("movie_id", "status", "started", "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 3
    assert got.where(F.col("n") >= 5).count() > 0


def test_streaks_by_tables_grow_over_batches_and_skip_replays(spark, tmp_path):
    log, out = f"{tmp_path}/log", f"{tmp_path}/out"
    rng, data = random.Random(3), []
    for i in range(200):
        data.append((i % 2, 0, "a", i, i, data[-2][5] if i > 1 and rng.random() < 0.8 else rng.choice(STATES), 0))
    schema = "movie_id bigint, seq bigint, ts_us bigint, status string"
    for a, b in ((0, 60), (40, 110), (110, 111), (111, 200), (0, 30)):
        part = data[a:b] + data[a : a + 3]  # rows that come twice
        spark.createDataFrame(part, LOG).select("movie_id", "seq", "ts_us", "status").coalesce(1).write.mode("append").parquet(log)
        sl.upsert_streaks(sl.read_log(spark, log, schema), out, f"{tmp_path}/checkpoint", 4)
    want = op.failure_streaks(spark.createDataFrame(data, LOG), ["seq"], 4)
    got = sl.longest(sl.read_streaks(spark, out)).select("movie_id", "status", "started", "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 3
    assert sum(os.path.exists(f"{out}/runs={n}/kind=open") for n in closed(spark, out, "runs")) <= 2
    # a batch that runs again, as after a crash before its commit, writes the same
    for name in ("4", ".4.crc"):
        os.remove(f"{tmp_path}/checkpoint/commits/{name}")
    sl.upsert_streaks(sl.read_log(spark, log, schema), out, f"{tmp_path}/checkpoint", 4)
    got = sl.longest(sl.read_streaks(spark, out)).select("movie_id", "status", "started", "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_streaks_query_starts_no_python_by_title(spark, monkeypatch):
    from cutlight import registry

    monkeypatch.setattr(sl, "failure_streaks", None)
    assert registry.QUERIES["x03_stream_failure_streaks"](spark, "/root/testdata/sf0.001").count() > 0
