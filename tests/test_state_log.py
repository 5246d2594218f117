import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.streaming import state_log, sync_state
from millrace.streaming.state_log import StateLog


def batches(spark, seed=1, n=6, size=80):
    rng = random.Random(seed)
    rows = [[(f"s{rng.randrange(60)}" if rng.random() < 0.7 else "hot", n_ * size + i, rng.choice(["seen", "pending", "completed"])) for i in range(size)] for n_ in range(n)]
    return rows, [spark.createDataFrame(r, "source_id string, seq long, action string") for r in rows]


def same(spark, got, rows):
    want = sync_state.fold_actions(spark.createDataFrame(rows, "source_id string, seq long, action string"))
    return sorted(got.collect()) == sorted(want.collect())


def filters_of(df):
    """The partition filters of a plan's scans."""
    return re.findall(r"PartitionFilters: \[(.*?), PushedFilters", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("cuts", [set(), {0}, {2, 4}, {5}, {0, 1, 2, 3, 4, 5}])
def test_equals_the_full_fold_at_any_cut(spark, tmp_path, cuts):
    rows, frames = batches(spark)
    log = StateLog(spark, str(tmp_path / "log"))
    assert log.state().count() == 0
    for n, frame in enumerate(frames):
        assert log.append(frame) == n
        if n in cuts:
            log.snapshot()
        if n in (2, 5):
            assert same(spark, log.state(), sum(rows[: n + 1], []))
    log.compact()
    assert same(spark, log.state(), sum(rows, []))


def test_only_the_tail_and_the_asked_buckets_are_read(spark, tmp_path):
    rows, frames = batches(spark, 2)
    log = StateLog(spark, str(tmp_path / "log"))
    for frame in frames[:4]:
        log.append(frame)
    log.snapshot()
    log.append(frames[4])
    scans = filters_of(log.state())
    assert any(re.search(r"batch#\d+ > 3", f) for f in scans) and any("version#" in f for f in scans)
    one = log.state(["hot", "s1", "never"])
    assert {r["source_id"] for r in one.collect()} == {"hot", "s1"}
    own = {r[0] for r in spark.createDataFrame([("hot",), ("s1",), ("never",)], "s string").select(state_log.bucket_of(F.col("s"))).collect()}
    told = next(f for f in filters_of(one) if "bucket#" in f)
    assert own <= set(map(int, re.findall(r"(?<![#\d])\d+", told))) <= own | {0}  # and version 0
    want = {r["source_id"]: r for r in sync_state.fold_actions(spark.createDataFrame(sum(rows[:5], []), "source_id string, seq long, action string")).collect()}
    assert all(r == want[r["source_id"]] for r in one.collect())


def test_a_snapshot_rewrites_touched_buckets_only_and_a_broken_one_changes_nothing(spark, tmp_path):
    rows, frames = batches(spark, 3)
    log = StateLog(spark, str(tmp_path / "log"))
    log.append(frames[0])
    assert log.snapshot() == 0 and log.snapshot() == 0  # nothing new
    log.append(spark.createDataFrame([("hot", 1000, "completed")], "source_id string, seq long, action string"))
    assert log.snapshot() == 1
    bucket = spark.range(1).select(state_log.bucket_of(F.lit("hot"))).first()[0]
    assert [p.name for p in (tmp_path / "log" / "data" / "version=1").glob("bucket=*")] == [f"bucket={bucket}"]
    # a snapshot that breaks off before its list of versions
    log.append(frames[1])
    (tmp_path / "log" / "versions" / "version=1").rename(tmp_path / "aside")
    assert log.version()[0] == 0
    assert same(spark, log.state(), rows[0] + [("hot", 1000, "completed")] + rows[1])
    assert log.snapshot() == 2
    log.compact()
    assert same(spark, log.state(), rows[0] + [("hot", 1000, "completed")] + rows[1])
    assert not list((tmp_path / "log" / "log").glob("batch=*")) and log.append(frames[2]) == 3
    assert same(spark, log.state(), rows[0] + [("hot", 1000, "completed")] + rows[1] + rows[2])
