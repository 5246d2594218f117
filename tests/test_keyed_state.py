from datetime import datetime, timedelta

from pyspark.sql import functions as F

from millrace.streaming import paged_stream, source_state, sync_state

START = datetime(2024, 1, 1)
ACTIONS = "source_id string, seq long, action string, ts timestamp"


def put_pages(spark, folder, rows, numbers, size):
    for n in numbers:
        spark.createDataFrame(rows[n * size : (n + 1) * size], ACTIONS).repartition(2).write.parquet(f"{folder}/page={n}")


def test_pages_are_read_once_over_two_runs(spark, tmp_path):
    rows = [(f"s{i % 7}", i, "seen", START + timedelta(minutes=i)) for i in range(120)]
    folder = str(tmp_path / "pages")
    put_pages(spark, folder, rows, range(7), 10)

    def run():
        stream = paged_stream.read_pages(spark, folder, ACTIONS, str(tmp_path / "progress" / "at.json"), pages_per_batch=3, lanes=2)
        query = stream.writeStream.option("checkpointLocation", str(tmp_path / "ck")).foreachBatch(lambda df, n: df.withColumn("task", F.spark_partition_id()).write.mode("overwrite").parquet(str(tmp_path / "out" / f"batch={n}"))).start()
        query.processAllAvailable()
        query.stop()

    run()
    put_pages(spark, folder, rows, [7, 8, 10, 11], 10)  # page 9 is missing, so 10 and 11 have to wait
    run()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["seq"] for r in got.collect()) == list(range(90))
    assert got.groupBy("page").agg(F.countDistinct("batch").alias("n")).where("n > 1").count() == 0
    pages = {r["batch"]: sorted(r["p"]) for r in got.groupBy("batch").agg(F.collect_set("page").alias("p")).collect()}
    assert pages[0] == [0, 1, 2] and max(map(len, pages.values())) == 3
    assert got.where("batch = 0").select("task").distinct().count() == 2  # several partitions
    put_pages(spark, folder, rows, [9], 10)
    run()
    assert sorted(r["seq"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(120))


def test_passes(spark, tmp_path):
    rows = [("s", i, "seen", START) for i in range(20)]
    folder = str(tmp_path / "pages")
    put_pages(spark, folder, rows, range(4), 5)
    stream = paged_stream.read_pages(spark, folder, ACTIONS, str(tmp_path / "at.json"), pages_per_batch=3, lanes=3, passes=2)
    query = stream.writeStream.format("memory").queryName("passes").option("checkpointLocation", str(tmp_path / "ck")).start()
    query.processAllAvailable()
    query.stop()
    got = spark.table("passes").groupBy("pass").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("seq").alias("d")).collect()
    assert sorted((r["pass"], r["n"], r["d"]) for r in got) == [(0, 20, 20), (1, 20, 20)]


def stream_of(spark, tmp_path, per_batch):
    pages = paged_stream.read_pages(spark, str(tmp_path / "pages"), ACTIONS, str(tmp_path / "at.json"), pages_per_batch=per_batch)
    return source_state.keyed_state(pages, wait_ms=600_000, tries=2)


def test_pending_sources_come_back_by_timers_and_state_survives_a_restart(spark, tmp_path):
    def at(minutes):
        return START + timedelta(minutes=minutes)

    rows = [("a", 0, "pending", at(0)), ("b", 1, "pending", at(1)), ("c", 2, "seen", at(2)), ("b", 3, "completed", at(3))]  # page 0
    rows += [("c", 4, "pending", at(4)), ("d", 5, "completed", at(5)), ("d", 6, "pending", at(6)), ("x", 7, "seen", at(20))]  # page 1
    rows += [("x", 8, "seen", at(21)), ("c", 9, "completed", at(22)), ("x", 10, "seen", at(23)), ("x", 11, "seen", at(40))]  # page 2: a, c, d are due
    rows += [("x", 12, "seen", at(41)), ("x", 13, "seen", at(42)), ("e", 14, "completed", at(43)), ("e", 15, "completed", at(44))]  # page 3: a and d once more
    folder, out, check = str(tmp_path / "pages"), str(tmp_path / "out"), str(tmp_path / "ck")
    put_pages(spark, folder, rows, range(2), 4)
    source_state.run(stream_of(spark, tmp_path, 1), out, check)
    half = spark.createDataFrame(rows[:8], ACTIONS)
    assert sorted(source_state.current(spark, out).collect()) == sorted(sync_state.fold_actions(half).collect())
    assert {r["source_id"]: (r["completed"], r["pending"]) for r in source_state.look_up(spark, check).collect()}["d"] == (5, 6)
    put_pages(spark, folder, rows, [2, 3], 4)
    source_state.run(stream_of(spark, tmp_path, 1), out, check)
    whole = spark.createDataFrame(rows, ACTIONS)
    assert sorted(source_state.current(spark, out).collect()) == sorted(sync_state.fold_actions(whole).collect())
    again = [(r["batch"], r["source_id"], r["tries"]) for r in source_state.changes_of(spark, out).where("kind = 'again'").orderBy("batch", "source_id").collect()]
    # timers see the watermark that the batches before have reached: 20 minutes in batch 2, 40 in batch 3
    assert again == [(2, "a", 1), (2, "d", 1), (3, "a", 2), (3, "d", 2)]


def test_counts_by_action_are_kept(spark, tmp_path):
    rows = [("a", i, ["seen", "pending", "seen"][i % 3], START + timedelta(seconds=i)) for i in range(12)]
    put_pages(spark, str(tmp_path / "pages"), rows, range(3), 4)
    source_state.run(stream_of(spark, tmp_path, 2), str(tmp_path / "out"), str(tmp_path / "ck"))
    held = spark.read.format("statestore").option("stateVarName", "counts").load(str(tmp_path / "ck"))
    assert {r["user_map_key"]["action"]: r["user_map_value"]["n"] for r in held.select("user_map_key", "user_map_value").collect()} == {"seen": 8, "pending": 4}
