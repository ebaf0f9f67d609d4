import json

import pytest

from starboard.__main__ import main
from starboard.operators import present as P
from starboard.plans import marts as M
from starboard.plans.dataset import analyze_dataset
from starboard.schemas import CANONICAL, MARTS

FILES = {
    "ratings_csv": "user_id,movie_id,rating,timestamp\n" + "".join(
        f"{u},{m},{(u + m) % 5 + 1},{u}\n" for u in range(1, 9) for m in range(10, 16)),
    "movies_csv": "movie_id,title,genres\n" + "".join(
        f'{m},"Movie {m} (19{m})",{"Drama|War" if m % 2 else "Comedy"}\n' for m in range(10, 18)),
    "users_csv": "user_id,gender,age,occupation\n" + "".join(
        f"{u},{'M' if u % 2 else 'F'},{u * 9},{'writer' if u < 5 else 'artist'}\n"
        for u in range(1, 11)),
}


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "marts")


def snapshot(spark, root, dataset_id):
    return {name: sorted(map(str, M.read_mart(spark, root, name, dataset_id).collect()))
            for name in MARTS}


def test_upload_end_to_end(spark, folder, root):
    path = folder(**FILES)
    number = M.register_dataset(spark, root, "mine")
    assert number == 1
    assert [tuple(r) for r in M.dataset_status(spark, root).collect()] == [(1, "analyzing")]
    assert M.dataset_badge(M.read_registry(spark, root)).first()["badge"] == "not_analysed"

    analyze_dataset(spark, path, root, number)
    assert [tuple(r) for r in M.dataset_status(spark, root).collect()] == [(1, "ready")]
    assert tuple(M.list_datasets(spark, root).first()) == (1, "mine", 8, 48, 8)
    assert M.dataset_badge(M.read_registry(spark, root)).first()["badge"] == "analysed"
    for name, schema in MARTS.items():
        mart = M.read_mart(spark, root, name, number)
        assert mart.dtypes == [(f.name, f.dataType.simpleString()) for f in schema.fields]
        assert mart.count() > 0
    assert M.mart_view(spark, root, "dashboard_summary", number).first()["total_ratings"] == 48
    gender = M.mart_view(spark, root, "gender_comparison", number).collect()
    assert [(r["gender"], r["user_count"]) for r in gender] == [("F", 5), ("M", 5)]
    ages = [r["age_group"] for r in M.mart_view(spark, root, "age_group_stats", number).collect()]
    assert ages == ["Under18", "26-35", "36-45", "46-55", "56+"]

    before = snapshot(spark, root, number)
    created = M.read_registry(spark, root).first()["created_at"]
    analyze_dataset(spark, path, root, number)
    assert snapshot(spark, root, number) == before
    assert M.read_registry(spark, root).first()["created_at"] == created


def test_marts_go_away_when_their_files_do(spark, folder, root, tmp_path):
    path = folder(**FILES)
    analyze_dataset(spark, path, root, 4, "four")
    (tmp_path / "files" / "users.csv").unlink()
    (tmp_path / "files" / "movies.csv").unlink()
    analyze_dataset(spark, path, root, 4)
    for name in ("top_movies", "genre_stats", "gender_comparison", "occupation_stats"):
        assert M.read_mart(spark, root, name, 4).isEmpty()
    users = M.mart_view(spark, root, "active_users", 4).first()
    assert (users["gender"], users["age"], users["occupation"]) == ("?", "0", "?")
    assert tuple(M.list_datasets(spark, root).first()) == (4, "four", 0, 48, 8)
    sections = {row["name"] for row in M.dataset_briefing(spark, root, 4).collect()}
    assert sections == {"dashboard_summary", "rating_distribution"}


def test_datasets_do_not_meet_and_can_be_deleted(spark, folder, root):
    path = folder(**FILES)
    analyze_dataset(spark, path, root, 2, "two")
    analyze_dataset(spark, path, root, 3, "three", lo=2, hi=4)
    kept = snapshot(spark, root, 2)
    assert kept != snapshot(spark, root, 3)
    M.delete_dataset(spark, root, 3)
    assert snapshot(spark, root, 2) == kept
    assert all(not values for values in snapshot(spark, root, 3).values())
    assert [r["id"] for r in M.list_datasets(spark, root).collect()] == [2]
    with pytest.raises(ValueError):
        M.delete_dataset(spark, root, 0)


@pytest.mark.parametrize("bad", ["1", "1 or 1=1", -1, 1.5, True, None])
def test_ids_are_numbers(spark, root, bad):
    with pytest.raises(ValueError):
        M.read_mart(spark, root, "top_movies", bad)


def test_counts_fall_back_to_the_ratings(spark, root):
    ratings = spark.createDataFrame([(1, 2, 3.0, 4), (1, 3, 3.0, 4)], CANONICAL["ratings"])
    from starboard.plans.analysis import Frames
    M.write_canonical(Frames(ratings), root, 6)
    M.update_registry(spark, root, 6)
    assert tuple(M.list_datasets(spark, root).first()) == (6, "Dataset_6", 2, 2, 1)


def test_append_repeats(spark, root):
    mart = spark.createDataFrame([(1, 2, 100.0)], "score int, count bigint, percentage double")
    M.append_mart(mart, root, "rating_distribution", 1)
    M.append_mart(mart, root, "rating_distribution", 1)
    assert M.read_mart(spark, root, "rating_distribution", 1).count() == 2


def test_reading_one_dataset_leaves_the_others_alone(spark, root):
    mart = spark.createDataFrame([(1, 2, 100.0)], "score int, count bigint, percentage double")
    for number in (1, 2, 12):
        M.append_mart(mart, root, "rating_distribution", number)
    files = M.read_mart(spark, root, "rating_distribution", 2).inputFiles()
    assert files and all("/dataset_id=2/" in name for name in files)
    everything = M.read_all(spark, root, "rating_distribution", MARTS["rating_distribution"])
    assert everything.where("dataset_id = 12").count() == 1


def test_briefing_sections_in_order(spark, folder, root):
    analyze_dataset(spark, folder(**FILES), root, 2, "two")
    lines = M.dataset_briefing(spark, root, 2).collect()
    names = list(dict.fromkeys(row["name"] for row in lines))
    assert names == ["dashboard_summary", "rating_distribution", "genre_stats", "top_movies",
                     "gender_comparison", "age_group_stats", "occupation_stats"]
    scores = [json.loads(r["content"])["score"] for r in lines if r["name"] == "rating_distribution"]
    assert scores == [1, 2, 3, 4, 5]


def test_views_show_as_many_rows_as_asked_for(spark):
    rows = [(f"m{i:02}", 4.5, i) for i in range(30)]
    mart = spark.createDataFrame(rows, "movie_name string, avg_rating double, rating_count long")
    assert M.serve(mart, "top_movies").count() == M.VIEW_ROWS
    assert M.serve(mart, "top_movies", 25).count() == 25
    assert M.serve(mart, "top_movies", None).count() == 30


def test_export(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a,b"), (2, None)], "i int, s string")
    path = str(tmp_path / "out")
    M.export_delimited(frame, path)
    assert [tuple(r) for r in spark.read.csv(path).orderBy("_c0").collect()] == [
        ("1", "a,b"), ("2", None)]


def test_presentation(spark, rows):
    frame = spark.createDataFrame([("a", 1), ("b", 3), ("007", None)], "k string, v int")
    assert [json.loads(r["json"]) for r in P.json_rows(frame).collect()] == [
        {"k": "a", "v": 1}, {"k": "b", "v": 3}, {"k": "007", "v": None}]
    assert rows(P.share_of_slice(frame, "v"), "share_pct") == [(25.0,), (75.0,), (None,)]
    assert rows(P.mean_line(frame, "v"), "mean_value") == [(2.0,)] * 3
    assert rows(P.top_n_slice(frame, ["k"], 1)) == [("007", None)]


class Recorder:
    """Stands in for a frame and its writer; there is no database to write to."""

    def __init__(self):
        self.calls = {}

    def select(self, *columns):
        self.calls["select"] = [str(column) for column in columns]
        return self

    @property
    def write(self):
        return self

    def __getattr__(self, name):
        def call(*values, **named):
            self.calls[name] = named or values
            return self

        return call


def test_jdbc_options_come_from_the_caller(spark):
    frame = Recorder()
    M.write_jdbc(frame, {"url": "jdbc:x", "dbtable": "t", "batchsize": "50"}, {"title": "movie_name"})
    assert frame.calls["format"] == ("jdbc",) and frame.calls["mode"] == ("overwrite",)
    assert frame.calls["options"] == {
        "batchsize": "50", "truncate": "true", "url": "jdbc:x", "dbtable": "t"}
    assert "title AS movie_name" in frame.calls["select"][0]


def test_job_from_headerless_files(spark, tmp_path, rows):
    source, root = tmp_path / "in", str(tmp_path / "marts")
    source.mkdir()
    (source / "ratings.dat").write_text("1::9::5::7\n2::9::4::7\n2::9::6::7\n2::9::4::late\n")
    (source / "movies.dat").write_text("9::Heat (1995)::Action|Crime\n")
    (source / "users.dat").write_text("1::F::25::3::48067\n2::M::35::4::48067\n")
    main([str(source), root, "4", "--raw", "--min-count", "2"])
    top = M.read_mart(spark, root, "top_movies", 4)
    assert [(r.movie_name, float(r.avg_rating), r.rating_count) for r in top.collect()] == [
        ("Heat", 4.5, 2)]
