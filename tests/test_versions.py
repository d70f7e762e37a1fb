"""Versioned folders: merges touch few files, publish once, and survive a lost writer."""

import pytest
from pyspark.sql import functions as F

from tablecraft.sources import versions

KEYS = ["k"]


def numbers(spark, start, stop, value="a"):
    return spark.range(start, stop, 1, 4).select(
        F.col("id").alias("k"), F.lit(value).alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad")
    )


def values(df):
    return {r["k"]: r["v"] for r in df.collect()}


@pytest.fixture
def many_files(spark):
    """Small tables in many files, as large ones are."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_merge_of_neighbouring_keys_rewrites_few_bytes(spark, tmp_path, many_files):
    path = str(tmp_path / "t")
    versions.create(numbers(spark, 0, 20_000), path, KEYS)
    assert versions.merge(numbers(spark, 5_000, 5_200, "b"), path, KEYS) == 1
    new, every = versions.written_bytes(spark, path, 1)
    assert 0 < new < every * 0.15  # one or two of 16 files, with 1 % of the keys
    got = values(versions.read(spark, path, KEYS))
    assert len(got) == 20_000 and {k for k, v in got.items() if v == "b"} == set(range(5_000, 5_200))
    # the version before is still there
    assert set(values(versions.read(spark, path, KEYS, 0)).values()) == {"a"}


def test_scattered_keys_are_appended_and_compacted(spark, tmp_path, many_files):
    path = str(tmp_path / "t")
    versions.create(numbers(spark, 0, 20_000), path, KEYS)
    scattered = numbers(spark, 0, 20_100, "b").where("k % 100 = 7")
    versions.merge(scattered, path, KEYS, how="append")
    new, every = versions.written_bytes(spark, path, 1)
    assert 0 < new < every * 0.1
    versions.merge(numbers(spark, 7, 8, "c"), path, KEYS, how="append")
    expected = {k: "a" for k in range(20_000)} | {k: "b" for k in range(7, 20_100, 100)} | {7: "c"}
    assert values(versions.read(spark, path, KEYS)) == expected
    assert versions.compact(spark, path, KEYS) == 3
    assert values(versions.read(spark, path, KEYS)) == expected
    assert versions.manifest(spark, path, 3).where("tier > 0").count() == 0
    assert versions.compact(spark, path, KEYS) == 3


def test_a_rewrite_after_runs_keeps_their_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.create(numbers(spark, 0, 10), path, KEYS)
    versions.merge(numbers(spark, 3, 5, "b"), path, KEYS, how="append")
    versions.merge(numbers(spark, 4, 6, "c"), path, KEYS)
    got = values(versions.read(spark, path, KEYS))
    assert got == {k: "a" for k in range(10)} | {3: "b", 4: "c", 5: "c"}


def test_ignore_keeps_known_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.create(numbers(spark, 5, 10), path, KEYS)
    versions.merge(numbers(spark, 0, 8, "b"), path, KEYS, mode="ignore")
    assert values(versions.read(spark, path, KEYS)) == {k: "b" if k < 5 else "a" for k in range(10)}


def test_files_never_overlap(spark, tmp_path, many_files):
    path = str(tmp_path / "t")
    versions.create(numbers(spark, 0, 4_000).where("k % 2 = 0"), path, KEYS)
    for low in (100, 3_000, 3_990):
        mixed = numbers(spark, low, low + 30, "b").unionByName(numbers(spark, 2_000 + low // 100, 2_003 + low // 100, "c"))
        versions.merge(mixed, path, KEYS)
    files = versions.manifest(spark, path, 3).where("file IS NOT NULL").orderBy("lo").collect()
    assert all(a["hi"]["k"] < b["lo"]["k"] for a, b in zip(files, files[1:]))
    assert sum(f["rows"] for f in files) == versions.read(spark, path, KEYS).count()


def test_a_writer_lost_before_publishing_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.create(numbers(spark, 0, 10), path, KEYS)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "publish", lost)
        with pytest.raises(OSError):
            versions.merge(numbers(spark, 0, 10, "b"), path, KEYS)
    assert set(values(versions.read(spark, path, KEYS)).values()) == {"a"}
    assert versions.merge(numbers(spark, 0, 2, "c"), path, KEYS) == 1
    # the files of the lost writer are named by no manifest; the others stay readable
    assert versions.vacuum(spark, path) >= 1
    assert values(versions.read(spark, path, KEYS)) == {k: "c" if k < 2 else "a" for k in range(10)}


def test_of_two_writers_one_has_to_merge_again(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.create(numbers(spark, 0, 10), path, KEYS)
    versions.merge(numbers(spark, 0, 1, "b"), path, KEYS, onto=0)
    with pytest.raises(versions.VersionConflict):
        versions.merge(numbers(spark, 1, 2, "c"), path, KEYS, onto=0)
    assert versions.merge(numbers(spark, 1, 2, "c"), path, KEYS) == 2
    got = values(versions.read(spark, path, KEYS))
    assert (got[0], got[1], got[2]) == ("b", "c", "a")


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.create(numbers(spark, 0, 10).where("k < 0"), path, KEYS)
    assert versions.read(spark, path, KEYS).count() == 0
    versions.merge(numbers(spark, 0, 3), path, KEYS)
    versions.merge(numbers(spark, 0, 3).where("k < 0"), path, KEYS)
    assert values(versions.read(spark, path, KEYS)) == {0: "a", 1: "a", 2: "a"}


@pytest.mark.parametrize("within", [None, "part"])
def test_ranges_of_files_come_from_their_ends_and_no_column_is_counted(spark, tmp_path, monkeypatch, within):
    df = spark.range(3_000).selectExpr("IF(id % 50 = 0, NULL, id * 7919 % 3001) AS k", "concat('s', id * 31 % 997) AS s", "id % 3 AS part")
    plans = []

    def kept(frame, name="cut", cut=versions.cut_lineage):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return cut(frame, name)

    monkeypatch.setattr(versions, "cut_lineage", kept)
    path = str(tmp_path / "t")
    found = versions.add_files(df if within else df.drop("part"), path, ["k", "s"], 0, 5, within).collect()
    seen = {}
    for r in spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/data").select("k", "s", F.col("_metadata.file_path").alias("f")).collect():
        seen.setdefault(r["f"].split("/t/")[1], []).append((r["k"] is not None, r["k"], r["s"]))
    assert len(found) == len(seen) and sum(r["rows"] for r in found) == 3_000
    for r in found:
        low, high = min(seen[r["file"]], key=str_key), max(seen[r["file"]], key=str_key)
        assert (tuple(r["lo"]), tuple(r["hi"]), r["rows"]) == (low[1:], high[1:], len(seen[r["file"]]))
        assert r["bytes"] > 0 and r["added"] == 5
    assert len(plans) == 1 and "ReadSchema: struct<>" in plans[0] and "SortAggregate" not in plans[0]


def str_key(row):
    return row[0], row[1] or 0, row[2]


def test_files_keep_the_newest_row_of_a_key(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (None, "c", 1), (None, "d", 2), (2, "e", 0)], "k int, v string, n int")
    folder = versions.write_files(df, str(tmp_path), ["k"], newest="n")
    rows = spark.read.parquet(f"{tmp_path}/{folder}")
    assert rows.columns == ["k", "v"] and sorted((r["v"], r["k"]) for r in rows.collect()) == [("b", 1), ("d", None), ("e", 2)]
