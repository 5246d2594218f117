import json

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.sources.folder_set import OWN, FolderSetWriter, publish


def table(spark, n=5000):
    return spark.range(n).select((F.col("id") % 97).cast("string").alias("document_id"), F.col("id").alias("pos"), F.when(F.col("id") % 3 > 0, F.lit("é\n")).alias("text")).repartition(5)


def files(path):
    return {str(p.relative_to(path)): p.read_bytes() for p in sorted(path.rglob("*")) if p.is_file()}


def test_folders_appear_at_once_and_repeat_byte_for_byte(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("millrace.sources.folder_set.PART_ROWS", 1000)
    rows = table(spark)
    tables = {"all": (rows, ["document_id", "pos"]), "few": (rows.where("pos < 10"), ["document_id"]), "none": (rows.where("false"), ["document_id"])}
    for name in ("one", "two"):
        publish(spark, tables, str(tmp_path / name), {"manifest.json": "{}"})
    made = files(tmp_path / "one")
    assert made == files(tmp_path / "two") and "manifest.json" in made and (tmp_path / "one" / "none").is_dir()
    assert len([f for f in made if f.startswith("all/")]) == 5  # several tasks wrote
    schema = "document_id string, pos long, text string"
    back = spark.read.schema(schema).json(str(tmp_path / "one" / "all"))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    lines = [json.loads(x) for f, raw in made.items() if f.startswith("all/") for x in raw.decode().splitlines()]
    assert any("text" in x and x["text"] is None for x in lines)
    assert spark.read.schema(schema).json(str(tmp_path / "one" / "none")).count() == 0
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith(".")] == []


def test_a_failing_task_leaves_nothing(spark, tmp_path):
    bad = table(spark).withColumn("text", F.when(F.col("pos") == 4321, F.raise_error(F.lit("no"))).otherwise(F.col("text")))
    with pytest.raises(PySparkException):
        publish(spark, {"good": (table(spark), ["document_id"]), "bad": (bad, ["document_id"])}, str(tmp_path / "out"))
    assert list(tmp_path.iterdir()) == []


def test_an_existing_target_is_refused(spark, tmp_path):
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "old").write_text("x")
    with pytest.raises(PySparkException, match="FileExistsError"):
        publish(spark, {OWN: (table(spark, 10), ["document_id"])}, str(tmp_path / "out"))
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["old"] and len(list(tmp_path.iterdir())) == 1


def batch(*lines):
    return iter([pa.RecordBatch.from_pydict({"folder": ["a"] * len(lines), "line": list(lines)})])


def test_a_repeated_attempt_counts_once(tmp_path):
    writer = FolderSetWriter(str(tmp_path / "out"), ["a"], {})
    first, second = writer.write(batch("1", "2")), writer.write(batch("1", "2"))
    assert first.lines == second.lines == {"a": 2} and first.files != second.files
    writer.commit([second, None])
    assert [p.read_text() for p in (tmp_path / "out" / "a").iterdir()] == ["1\n2\n"]
    other = FolderSetWriter(str(tmp_path / "late"), ["a"], {})
    made = other.write(batch("3"))
    other.abort([made])
    (tmp_path / "late").mkdir()
    with pytest.raises(FileExistsError):  # came up while the tasks ran
        other.commit([made])
    with pytest.raises(ValueError):
        writer.write(iter([pa.RecordBatch.from_pydict({"folder": ["b"], "line": ["1"]})]))
