"""Tables that are replaced safely."""

import pytest
from pyspark.sql import functions as F

from starboard import snapshots
from starboard.plans import marts as M
from starboard.plans.analysis import Frames
from starboard.plans.dataset import analyze_dataset
from starboard.schemas import CANONICAL, MARTS

SCORES = "score int, count bigint, percentage double"
FILES = {"r_csv": "user_id,movie_id,rating\n" + "".join(f"{u},7,4\n" for u in range(5))}


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int")


def read(spark, folder, table, rows):
    paths = snapshots.current(spark, folder).get(table)
    return rows(spark.read.parquet(*paths)) if paths else None


def failing(spark, schema="n int"):
    """A frame that writes some rows and then fails."""
    rows = spark.range(0, 1000, 1, 4)
    value = F.when(F.col("id") == 999, F.raise_error(F.lit("broken half-way"))).otherwise(F.col("id"))
    names = [field.split()[0] for field in schema.split(", ")]
    return rows.select(*[value.cast("int").alias(name) for name in names])


def test_tables_are_switched_together(spark, tmp_path, rows):
    folder = str(tmp_path / "set")
    assert snapshots.current(spark, folder) == {}
    snapshots.replace(spark, folder, {"a": numbers(spark, 1), "b": numbers(spark, 2)})
    before = spark.read.parquet(*snapshots.current(spark, folder)["a"])
    with snapshots.Change(spark, folder) as change:
        change.put({"a": numbers(spark, 3)})
        assert rows(change.read("a")) == [(3,)] and change.read("c") is None
        assert read(spark, folder, "a", rows) == [(1,)]
        change.put({"b": None, "c": numbers(spark, 4)})
    assert [read(spark, folder, name, rows) for name in "abc"] == [[(3,)], None, [(4,)]]
    # Who looked the old rows up can still read them, until the next switch.
    assert rows(before) == [(1,)]
    snapshots.replace(spark, folder, {"a": numbers(spark, 5)}, append=True, note={"batch": 2})
    assert read(spark, folder, "a", rows) == [(3,), (5,)]
    assert snapshots.note(spark, folder) == {"batch": 2}
    assert len(list((tmp_path / "set" / "a").iterdir())) == 2
    assert not list((tmp_path / "set" / "b").iterdir())


def test_a_failing_write_leaves_the_old_tables(spark, tmp_path, rows):
    folder = str(tmp_path / "set")
    snapshots.replace(spark, folder, {"a": numbers(spark, 1), "b": numbers(spark, 2)})
    with pytest.raises(Exception, match="broken half-way"):
        snapshots.replace(spark, folder, {"a": numbers(spark, 9), "b": failing(spark)})
    with pytest.raises(Exception, match="broken half-way"), snapshots.Change(spark, folder) as change:
        change.put({"a": numbers(spark, 9)})
        change.put({"b": failing(spark)})
    assert [read(spark, folder, name, rows) for name in "ab"] == [[(1,)], [(2,)]]
    assert [len(list((tmp_path / "set" / name).iterdir())) for name in "ab"] == [1, 1]


def test_a_crash_between_write_and_switch_leaves_the_old_tables(spark, tmp_path, rows, monkeypatch):
    folder = str(tmp_path / "set")
    snapshots.replace(spark, folder, {"a": numbers(spark, 1)})

    def crash(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(snapshots, "_switch", crash)
    with pytest.raises(KeyboardInterrupt):
        snapshots.replace(spark, folder, {"a": numbers(spark, 9)})
    monkeypatch.undo()
    assert read(spark, folder, "a", rows) == [(1,)]


def test_marts_survive_a_failing_mart(spark, tmp_path, rows):
    root = str(tmp_path)
    good = spark.createDataFrame([(1, 2, 100.0)], SCORES)
    M.write_marts(spark, {"rating_distribution": good}, root, 1)
    with pytest.raises(Exception, match="broken half-way"):
        M.write_marts(spark, {"rating_distribution": failing(spark, SCORES),
                              "dashboard_summary": failing(
                                  spark, "total_movies int, total_ratings int, total_users int, "
                                         "avg_rating int")}, root, 1)
    assert rows(M.read_mart(spark, root, "rating_distribution", 1), "score", "count") == [(1, 2)]


def test_canonical_tables_survive_a_failing_one(spark, tmp_path):
    ratings = spark.createDataFrame([(1, 2, 3.0, 4)], CANONICAL["ratings"])
    M.write_canonical(Frames(ratings), str(tmp_path), 6)
    bad = failing(spark, "movie_id int").selectExpr("movie_id", "'' title", "'' title_full",
                                                    "'' genres_raw")
    with pytest.raises(Exception, match="broken half-way"):
        M.write_canonical(Frames(ratings.union(ratings), bad), str(tmp_path), 6)
    kept = M.read_canonical(spark, str(tmp_path), 6)
    assert kept.ratings.count() == 1 and kept.movies is None


def test_a_dataset_is_rewritten_whole_or_not_at_all(spark, folder, tmp_path, monkeypatch):
    path, root = folder(**FILES), str(tmp_path / "marts")
    analyze_dataset(spark, path, root, 4, "four")
    (tmp_path / "files" / "s.csv").write_text("user_id,movie_id,rating\n9,9,1\n")
    whole = M._conformed_marts

    def one_fails(marts):
        return whole(marts) | {"top_movies": failing(spark, "movie_name int")}

    monkeypatch.setattr(M, "_conformed_marts", one_fails)
    with pytest.raises(Exception, match="broken half-way"):
        analyze_dataset(spark, path, root, 4, "renamed")
    monkeypatch.undo()
    assert M.read_canonical(spark, root, 4).ratings.count() == 5
    assert M.read_mart(spark, root, "dashboard_summary", 4).first()["total_ratings"] == 5
    assert tuple(M.list_datasets(spark, root).first()) == (4, "four", 0, 5, 5)
    analyze_dataset(spark, path, root, 4)
    assert tuple(M.list_datasets(spark, root).first()) == (4, "four", 0, 6, 6)


def test_all_datasets_are_read_from_their_manifests(spark, tmp_path, rows):
    root = str(tmp_path)
    schema = MARTS["rating_distribution"]
    assert M.read_all(spark, root, "rating_distribution", schema).count() == 0
    for number in (1, 12):
        mart = spark.createDataFrame([(1, number, 100.0)], SCORES)
        M.write_marts(spark, {"rating_distribution": mart}, root, number)
        M.write_marts(spark, {"rating_distribution": mart}, root, number)
    everything = M.read_all(spark, root, "rating_distribution", schema)
    assert rows(everything, "dataset_id", "count") == [(1, 1), (12, 12)]
    assert rows(everything.where("dataset_id = 12"), "count") == [(12,)]
    M.delete_dataset(spark, root, 12)
    assert rows(M.read_all(spark, root, "rating_distribution", schema), "dataset_id") == [(1,)]
