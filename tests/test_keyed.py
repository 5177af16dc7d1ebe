"""Keyed tables: which files a merge touches, replays, failures, ties."""

import pytest

from scorewatch.session import shared_folder
from scorewatch.sources import keyed

SCHEMA = "id string, at int, v string"
BUCKETS = 8


@pytest.fixture()
def root(spark):
    return shared_folder(spark, "test-keyed")


def files(spark, root):
    hadoop, path = keyed._path(spark, f"{root}/bucket_of_{BUCKETS}=*/part-*")
    return {f.getPath().toString().partition("bucket_of_")[2] for f in hadoop.globStatus(path) or []}


def held(spark, root):
    return sorted(tuple(r) for r in keyed.read(spark, root, BUCKETS).select("id", "at", "v").collect())


def load(root, frame, number, **options):
    keyed.merge(frame, root, "id", number, order=["at"], buckets=BUCKETS, **options)


def test_a_merge_touches_only_its_buckets(spark, rows, root):
    assert not keyed.exists(spark, root, BUCKETS)
    load(root, rows([(f"k{i}", 0, "old") for i in range(200)], SCHEMA), 0)
    before = files(spark, root)
    assert len({f.partition("/")[0] for f in before}) == BUCKETS
    load(root, rows([("k7", 1, "new")], SCHEMA), 1)
    after = files(spark, root)
    gone = {f.partition("/")[0] for f in before - after}
    assert len(gone) == 1 and {f.partition("/")[0] for f in after - before} == gone
    assert [r for r in held(spark, root) if r[2] == "new"] == [("k7", 1, "new")] and len(held(spark, root)) == 200


def test_a_replay_changes_no_file(spark, rows, root):
    first, second = rows([("a", 5, "x"), ("b", 5, "x")], SCHEMA), rows([("b", 1, "y"), ("c", 1, "y")], SCHEMA)
    load(root, first, 0)
    load(root, second, 1)
    before, want = files(spark, root), [("a", 5, "x"), ("b", 1, "y"), ("c", 1, "y")]
    assert held(spark, root) == want
    for number, again in enumerate((first, second)):
        load(root, again, number)
        assert files(spark, root) == before and held(spark, root) == want


def test_one_row_per_key_and_ties(spark, rows, root):
    batch = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "y"), ("a", 2, "z"), (None, 1, "n"), (None, 2, "m"), ("t", 1, "p"), ("t", 1, "q")]
    load(root, rows(batch, SCHEMA), 0)
    found = held_dict = {r[0]: r for r in keyed.read(spark, root, BUCKETS).select("id", "at", "v").collect()}
    assert found["a"][1:] == (3, "y") and found[None][1:] == (2, "m")
    other = shared_folder(spark, "test-keyed")
    load(other, rows(batch[::-1], SCHEMA), 0)
    assert {r[0]: r for r in keyed.read(spark, other, BUCKETS).select("id", "at", "v").collect()} == held_dict


def test_the_first_row_stays(spark, rows, root):
    load(root, rows([("a", 5, "x"), ("b", 5, "x")], SCHEMA), 0, first=True)
    load(root, rows([("a", 6, "later"), ("b", 4, "earlier"), ("c", 9, "only")], SCHEMA), 1, first=True)
    assert held(spark, root) == [("a", 5, "x"), ("b", 4, "earlier"), ("c", 9, "only")]


def test_empty_loads_and_other_columns(spark, rows, root):
    load(root, rows([], SCHEMA), 0)
    assert not keyed.exists(spark, root, BUCKETS)
    load(root, rows([("a", 1, "x")], SCHEMA), 1)
    load(root, rows([], SCHEMA), 2)
    assert held(spark, root) == [("a", 1, "x")]
    with pytest.raises(ValueError, match="not those of the table"):
        load(root, rows([("a", 1)], "id string, at int"), 3)


def test_a_failed_merge_leaves_the_table(spark, rows, root):
    load(root, rows([("a", 1, "x"), ("b", 1, "x")], SCHEMA), 0)
    before = files(spark, root)
    with pytest.raises(Exception, match="broken row"):
        load(root, rows([("a", 2, "y")], SCHEMA).selectExpr("id", "at", "string(raise_error('broken row')) as v"), 1)
    assert files(spark, root) == before and held(spark, root) == [("a", 1, "x"), ("b", 1, "x")]


def test_an_unfinished_merge_is_made_good(spark, rows, root, monkeypatch):
    """The driver dies after staging, with one bucket already deleted: reading or merging again completes it."""
    load(root, rows([("a", 1, "x"), ("b", 1, "x")], SCHEMA), 0)
    finish = keyed.finish
    with monkeypatch.context() as patch:
        patch.setattr(keyed, "finish", lambda *a: None)
        load(root, rows([("a", 2, "y"), ("c", 2, "y")], SCHEMA), 1)
    hadoop, path = keyed._path(spark, f"{root}/bucket_of_{BUCKETS}=*")
    staged = spark.read.parquet(f"{root}/_staged").where("id = 'a'").first()[f"bucket_of_{BUCKETS}"]
    hadoop.delete(keyed._path(spark, f"{root}/bucket_of_{BUCKETS}={staged}")[1], True)
    want = [("a", 2, "y"), ("b", 1, "x"), ("c", 2, "y")]
    assert held(spark, root) == want
    finish(spark, root, BUCKETS)
    assert held(spark, root) == want and not hadoop.exists(keyed._path(spark, f"{root}/_staged")[1])


def test_a_hot_key_combines_before_the_shuffle(spark, root):
    many = spark.range(30_000).selectExpr("IF(id % 3 = 0, 'hot', string(id)) AS id", "int(id) AS at", "'v' AS v")
    load(root, many, 0)
    assert keyed.read(spark, root, BUCKETS).where("id = 'hot'").first()["at"] == 29_997
    assert keyed.read(spark, root, BUCKETS).count() == 20_001
