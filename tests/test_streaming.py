import datetime as dt

import pytest

from starboard.streaming import ratings as X

HEADER = "userId,movie,score,time\n"


@pytest.fixture
def work(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def ingest(spark, work):
    lines = X.read_rating_lines(spark, str(work / "in"))
    judged = X.parse_rating_lines(lines, ("userId", "movie", "score", "time"))
    X.stream_ingest(judged, str(work / "out"), str(work / "log")).awaitTermination()
    return X.ingested(spark, str(work / "out"))


def test_files_are_taken_in_once(spark, work, rows):
    (work / "in" / "a.csv").write_text(HEADER + "1,2,3,4\n\n1,x,3,4\n" + HEADER + "2,2,99,4\n")
    good, bad = ingest(spark, work)
    assert rows(good) == [(1, 2, 3.0, 4)]
    assert rows(bad) == [("1,x,3,4", "missing_key"), ("2,2,99,4", "rating_out_of_range")]
    (work / "in" / "b.csv").write_text(HEADER + "5,6,4.5,\n")
    good, _ = ingest(spark, work)
    assert rows(good) == [(1, 2, 3.0, 4), (5, 6, 4.5, 0)]
    good, _ = ingest(spark, work)
    assert good.count() == 2


def test_running_distribution(spark, work, rows):
    schema = "user_id int, movie_id int, rating double"

    def arrive(name, ratings):
        frame = spark.createDataFrame([(1, 1, r) for r in ratings], schema)
        frame.coalesce(1).write.parquet(str(work / "in" / name))

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(
            str(work / "in"))
        X.write_result(
            X.stream_distribution(stream), str(work / "out"), str(work / "log")
        ).awaitTermination()
        return rows(X.read_result(spark, str(work / "out")))

    arrive("a", [1.0, 1.5, 4.0])
    assert run() == [(1, 2), (4, 1)]
    arrive("b", [4.5, 5.0])
    assert run() == [(1, 2), (4, 2), (5, 1)]


def test_late_events_are_left_out(spark, work, rows):
    schema = "ts timestamp"
    day = dt.datetime(2024, 1, 1)

    def arrive(name, *hours):
        frame = spark.createDataFrame([(day + dt.timedelta(hours=h),) for h in hours], schema)
        frame.coalesce(1).write.parquet(str(work / "in" / name))

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(
            str(work / "in"))
        X.write_result(
            X.stream_activity(stream), str(work / "out"), str(work / "log"), mode="append"
        ).awaitTermination()
        return rows(X.read_result(spark, str(work / "out")), "window_start", "count")

    arrive("a", 1, 2, 30)
    assert run() == [(day, 2)]
    arrive("b", 3, 31, 60)
    done = run()
    assert done == [(day, 2), (day + dt.timedelta(days=1), 2)]


def test_unknown_delimiters_are_refused(spark, work):
    with pytest.raises(ValueError):
        X.parse_rating_lines(X.read_rating_lines(spark, str(work / "in")), ("a",), sep=";")


def test_lines_as_in_a_folder_read_at_once(spark, work, rows):
    (work / "in" / "a.csv").write_text(HEADER + "3000000000,2,3,4\n" * 2 + "7\n8.0,2,3,4\n")
    good, bad = ingest(spark, work)
    assert sorted(rows(good)) == [(8, 2, 3.0, 4), (3000000000, 2, 3.0, 4)]
    assert rows(bad) == [("7", "too_few_fields")]


def test_another_header_stops_the_stream(spark, work):
    (work / "in" / "a.csv").write_text("movie,userId,score,time\n20,10,4,1\n")
    with pytest.raises(Exception, match="header differs from the declared columns"):
        ingest(spark, work)
