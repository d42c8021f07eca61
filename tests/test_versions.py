"""Versions of published tables, at every moment of a publication, and the one-pass scan of published files."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans import quality, report
from tidemark.sources import versions


def values(df):
    return sorted(r[0] for r in df.collect())


def test_a_reader_sees_a_whole_table_between_any_two_steps(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.current(spark, path) is None
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    assert versions.publish(spark.range(3), path) == 1
    spark.range(5).write.parquet(f"{path}/data-unfinished")  # written, not committed
    assert values(versions.read(spark, path)) == [0, 1, 2]
    log = tmp_path / "t" / versions.LOG
    commit = {"version": 2, "folder": "data-unfinished", "kind": "parquet", "rows": 5, "schema": spark.range(1).schema.jsonValue()}
    for text in ("", json.dumps(commit)[:20], json.dumps(commit)):  # the commit file is begun, half there, not ended
        (log / "00000002.json").write_text(text)
        assert values(versions.read(spark, path)) == [0, 1, 2]
    for name in list(os.listdir(log)):  # written past Hadoop, so its checksum file is stale
        if name.endswith(".crc"):
            os.remove(log / name)
    (log / "00000002.json").write_text(json.dumps(commit) + "\n")
    assert values(versions.read(spark, path)) == [0, 1, 2, 3, 4] and values(versions.read(spark, path, 1)) == [0, 1, 2]


def test_refused_and_competing_versions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.publish(spark.range(2), path)
    before = sorted(os.listdir(path))

    def refuse(fresh):
        raise ValueError("refused")

    for df, check in ((spark.range(0), lambda fresh: None), (spark.range(4), refuse)):
        with pytest.raises(ValueError):
            versions.publish(df, path, check)
    assert sorted(os.listdir(path)) == before and values(versions.read(spark, path)) == [0, 1]

    numbers = versions._numbers  # another writer commits between our look at the log and our commit
    monkeypatch.setattr(versions, "_numbers", lambda s, p: [] if p == path else numbers(s, p))
    assert versions._commit(spark, path, "data-other", "parquet", spark.range(1).schema, 1) == 2


def test_only_the_newest_versions_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 5):
        assert versions.publish(spark.range(n), path, kind="csv", compression="gzip" if n == 3 else None) == n
    assert [v.number for v in versions.versions(spark, path)] == [4, 3] and len([f for f in os.listdir(path) if f.startswith("data-")]) == 2
    assert values(versions.read(spark, path, 3)) == [0, 1, 2] and values(versions.read(spark, path, text=True)) == ["0", "1", "2", "3"]
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path, 1)


RULES = {"a": quality.Rule(3, 4, ("entity", "v", "w")), "b": quality.Rule(1, 2, ("x",)), "c": quality.Rule(1), "gone": quality.Rule(1)}


def published(spark, folder):
    rows = [("one", 1.0, "x,y"), ("one", float("inf"), "z"), ('t"wo', 2.0, "infinity"), ('t"wo', 3.0, 'say "inf"'), ('t"wo', 4.0, None), (None, 5.0, "q")]
    report.write_report(
        {
            "a": spark.createDataFrame(rows, "entity STRING, v DOUBLE, note STRING").repartition(3),
            "b": spark.createDataFrame([(i, -float("inf") if i == 7 else 0.5) for i in range(9)], "x INT, y DOUBLE"),
            "c": spark.range(500).withColumn("t", F.lit("information")).repartition(2),
        },
        folder,
    )


def test_one_scan_gives_the_shapes_of_all_files(spark, tmp_path):
    published(spark, str(tmp_path))
    found = report.current_tables(spark, str(tmp_path), list(RULES))
    issues = quality.scan_issues(quality.scan(spark, found), RULES, ["entity"])
    got = {(r.entity, r.table, r.message) for r in issues.collect()}
    assert got == {
        ("one", "a", "2 rows, below minimum 3"), ("one", "a", "infinity in at least one cell"), ("one", "a", "columns not found: w"),
        ('t"wo', "a", "infinity in at least one cell"), ('t"wo', "a", "columns not found: w"),
        (None, "a", "1 rows, below minimum 3"), (None, "a", "columns not found: w"),
        (None, "b", "9 rows, above maximum 2"), (None, "b", "infinity in at least one cell"),
    }
    whole = report.validate_report(spark, str(tmp_path), "2024-01-01", RULES).collect()
    assert got | {(None, "gone", "required output is missing")} == {(r.entity, r.table, r.message) for r in whole}


@pytest.mark.parametrize("harm", ["cut", "lost"])
def test_a_bad_file_does_not_hide_the_others(spark, tmp_path, harm):
    path = str(tmp_path / "a")
    versions.publish(spark.range(2000).withColumn("t", F.uuid()).repartition(2), path, kind="csv", compression="gzip")
    versions.publish(spark.range(3), str(tmp_path / "c"), kind="csv")
    folder = versions.current(spark, path).folder
    victim = sorted(f for f in os.listdir(folder) if f.endswith(".gz"))[0]
    whole = open(f"{folder}/{victim}", "rb").read()
    assert len(gzip.decompress(whole).splitlines()) == 1001
    for f in os.listdir(folder):
        if f.endswith(".crc"):
            os.remove(f"{folder}/{f}")
    if harm == "cut":
        with open(f"{folder}/{victim}", "wb") as f:
            f.write(whole[: len(whole) // 2])
    else:
        os.remove(f"{folder}/{victim}")
    found = report.current_tables(spark, str(tmp_path), ["a", "c"])
    got = [(r.table, r.rule, r.message) for r in quality.scan_issues(quality.scan(spark, found), {"a": quality.Rule(1), "c": quality.Rule(1)}).collect()]
    assert [x[:2] for x in got] == [("a", "files")] and "of 2000 that were published" in got[0][2]
