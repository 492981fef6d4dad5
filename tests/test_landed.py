"""Content of unlicensed repositories stays unread; places of URLs in a topic."""

import time

import pytest
from pyspark.sql import functions as F

from tablefold.functions.delimited import name_columns, numbered
from tablefold.operators import filters
from tablefold.sources import landed

LICENSES = [("a", "one", 200, ("MIT",)), ("b", "two", 404, ("MIT",)), ("c", "three", 200, ("Other",)), ("d", "four", 200, None), ("e", "007", 200, ("BSD",)), ("e", "007", 200, ("BSD",))]


@pytest.fixture
def licenses(spark):
    return spark.createDataFrame(LICENSES, "owner string, repo string, status int, license struct<name:string>")


def land(path, owner, repo, name, data):
    folder = path / f"owner={owner}" / f"repo={repo}" / "topic=my topic"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(data)


@pytest.mark.parametrize("max_bytes", [1, 1 << 20])
def test_only_licensed_repositories_are_read(spark, tmp_path, licenses, max_bytes):
    docs = spark.createDataFrame([(i, owner, repo, f"text {i}") for i, (owner, repo, *_) in enumerate(LICENSES[:5])], "id int, owner string, repo string, content string")
    docs.write.partitionBy("owner", "repo").parquet(str(tmp_path / "p"))
    for file in (tmp_path / "p").rglob("*.parquet"):
        if not ("owner=a" in str(file) or "owner=e" in str(file)):
            file.write_bytes(b"cannot be read")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    files = spark.read.schema("id int, content string, owner string, repo string").parquet(str(tmp_path / "p"))
    kept = filters.prune_licensed(files, licenses, max_bytes)
    assert sorted((r.id, r.content, r.license["name"]) for r in kept.collect()) == [(0, "text 0", "MIT"), (4, "text 4", "BSD")]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_files_of_repositories(spark, tmp_path, licenses):
    land(tmp_path, "a", "one", "x y.csv", b"\xef\xbb\xbfa,b\n1,2")
    land(tmp_path, "a", "one", "bad.csv", b"\xff\xfe")
    land(tmp_path, "b", "two", "z.csv", b"secret")
    land(tmp_path, "e", "007", "w.csv", b"c;d")
    found = landed.read_repository_files(spark, str(tmp_path), licenses)
    assert sorted((r.topic, r.file_name, r.content) for r in found.collect()) == sorted([("my topic", "x y.csv", "a,b\n1,2"), ("my topic", "bad.csv", None), ("my topic", "w.csv", "c;d")], key=str)
    assert found.columns == landed.read_files(spark, str(tmp_path)).columns


def test_places_of_urls_are_unique_in_a_topic(spark, tmp_path):
    for topic, name, lines in (("t", "one", ["u1", "u2"]), ("t", "two", ["u3"]), ("s", "one", ["u4", "", "u5"]), ("s", "zero", [""])):
        (tmp_path / topic).mkdir(exist_ok=True)
        (tmp_path / topic / f"{name}.txt").write_text("\n".join(lines))
    rows = sorted((r.topic, r.url_pos, r.url) for r in landed.read_manifest(spark, str(tmp_path)).collect())
    assert [r[2] for r in rows] == ["u4", "u5", "u1", "u2", "u3"]
    assert len({r[:2] for r in rows}) == 5


def by_hand(names):
    """A name that is taken gets its number of earlier takers until it is free."""
    taken, out = {}, []
    for name in names:
        while name in taken:
            taken[name] += 1
            name = f"{name}.{taken[name] - 1}"
        taken[name] = 1
        out.append(name)
    return out


def test_names_are_numbered_apart(spark):
    cases = [[], ["a"], ["a", "b"], ["a", "a", "a"], ["id", "id", "id.1"], ["a", "a.1", "a"], ["x", "x", "x.1", "x", "x.1", "x.1.1", "x"], ["a.1", "a", "a", "a.1", "b", "b"], ["w"] * 40]
    got = spark.createDataFrame([(c,) for c in cases], "f array<string>").select(name_columns(F.col("f")).alias("n"), numbered(F.col("f")).alias("m")).collect()
    assert [r.n for r in got] == [by_hand(c) for c in cases] == [r.m for r in got]


def test_repeats_of_a_wide_header_are_counted_without_comparing_all_pairs(spark):
    """Comparing each name with all earlier ones took 10 seconds for 40,000 names and four times as long for twice as many."""
    cases = [[f"w{i % 7}" for i in range(70_000)], ["a", None, "a", None, "", ""]]
    frame = spark.createDataFrame([(c,) for c in cases], "f array<string>")
    began = time.time()
    got = [r.n for r in frame.select(name_columns(F.col("f")).alias("n")).collect()]
    assert time.time() - began < 15
    assert got[0] == by_hand(cases[0]) and got[1] == ["a", None, "a.1", None, "Unnamed: 4", "Unnamed: 5"]
