"""Files of any dialect as a stream, duplicates by keyed state, results kept by switching."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starboard.plans.dataset import load_dataset
from starboard.sources.parsing import quarantine_of
from starboard.streaming import held as H
from starboard.streaming import ratings as X
from starboard.streaming import uploads as U


@pytest.fixture
def work(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def put(work, **files):
    for name, content in files.items():
        stem, _, ending = name.rpartition("_")
        (work / "in" / f"{stem}.{ending}").write_text(content)


def ingest(spark, work, day=None, per_batch=None):
    lines = U.read_upload_lines(spark, str(work / "in"), per_batch)
    arrived = None if day is None else lambda _: F.lit(dt.datetime(2024, 1, 1) + dt.timedelta(day))
    U.ingest_uploads(lines, str(work / "out"), str(work / "log"), arrived=arrived).awaitTermination()


def unique(spark, work, within="7 days"):
    query = U.write_unique(U.unique_ratings(spark, str(work / "out"), within), str(work / "out"),
                           str(work / "unique-log"))
    query.awaitTermination()
    return query


FILES = {
    "a_csv": "user_id,movie_id,rating,title\n1,3,4,Score\n2,3,4,rating\nuser_id,movie_id,rating,title\n",
    "b_tsv": "movie\tscore\tuserId\n20\t4.5\t10\n21\tfive\t10\n21\t99\t10\n\n7\n",
    "c_dat": "5::1000::3.5::978300760\n6::1001::4::978300761\n",
    "d_csv": "movieId,title,genres\n20,Score,Drama\n21,title,War\n",
    "e_csv": "user_id,gender,age\n10,F,33\n",
    "f_csv": "1000,0.5,2000,0.5\n1001,1.5,2001,1.5\n",
    "g_txt": "no delimiter here\n",
}


@pytest.mark.parametrize("per_batch", [None, 1])
def test_a_stream_of_files_equals_a_folder_read_at_once(spark, work, rows, per_batch):
    put(work, **FILES)
    dataset = load_dataset(spark, str(work / "in"))
    ingest(spark, work, per_batch=per_batch)
    unique(spark, work)
    out = str(work / "out")
    assert rows(U.uploaded_ratings(spark, out)) == rows(dataset.frames.ratings)
    assert sorted(rows(U.uploaded_ratings(spark, out))) == [
        (1, 3, 4.0, 0), (2, 3, 4.0, 0), (5, 1000, 3.5, 978300760), (6, 1001, 4.0, 978300761),
        (10, 20, 4.5, 0)]
    assert rows(U.uploaded_movies(spark, out)) == rows(dataset.frames.movies)
    names = ["user_id", "gender", "age"]
    assert rows(U.uploaded_users(spark, out), *names) == rows(dataset.frames.users, *names)
    assert rows(quarantine_of(U.upload_rows(spark, out)), "value", "reason") == rows(
        dataset.quarantine, "value", "reason")
    judged = U.upload_files(spark, out).withColumn(
        "name", F.element_at(F.split("file_path", "/"), -1))
    assert rows(judged, "name", "reason") == [
        ("a.csv", None), ("b.tsv", None), ("c.dat", None), ("d.csv", None), ("e.csv", None),
        ("f.csv", "ambiguous_columns"), ("g.txt", "no_delimiter")]


def test_files_are_taken_in_once(spark, work, rows):
    put(work, a_csv="user_id,movie_id,rating\n1,2,3\n")
    for _ in range(2):
        ingest(spark, work)
        unique(spark, work)
    put(work, b_csv="rating,movie_id,user_id\n4,5,6\n")
    ingest(spark, work)
    unique(spark, work)
    assert rows(U.uploaded_ratings(spark, str(work / "out"))) == [(1, 2, 3.0, 0), (6, 5, 4.0, 0)]


def test_repeats_within_the_time_count_once_and_state_does_not_grow(spark, work, rows):
    head = "user_id,movie_id,rating,ts\n"
    held = []
    for day in (0, 5, 6, 30, 45, 60):
        # Each day 50 ratings of its own, and twice one that comes in again and again.
        own = "".join(f"{1000 + day * 100 + i},1,2,{day}\n" for i in range(50))
        put(work, **{f"d{day}_csv": head + own + "7,7,5,0\n" * 2})
        ingest(spark, work, day)
        query = unique(spark, work)
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    kept = U.uploaded_ratings(spark, str(work / "out"))
    assert kept.where("user_id <> 7").count() == 300
    # Of days 0, 5 and 6 one stays. State goes once a batch has shown that its time is over, so
    # day 30 is still held against day 0, and day 45 is not.
    assert kept.where("user_id = 7").count() == 2
    assert max(held) <= 3 * 50 + 1 and held[-1] <= 2 * 51


def test_no_value_stops_the_declared_stream(spark, work, rows):
    put(work, a_csv="user_id,movie_id,rating,title\n1,3,4,Score\n2,3,movie,Score\n")
    lines = X.read_rating_lines(spark, str(work / "in"))
    judged = X.parse_rating_lines(lines, ("user_id", "movie_id", "rating", "title"))
    X.stream_ingest(judged, str(work / "out"), str(work / "log")).awaitTermination()
    good, bad = X.ingested(spark, str(work / "out"))
    assert rows(good) == [(1, 3, 4.0, 0)]
    assert rows(bad) == [("2,3,movie,Score", "invalid_rating")]


def scores(spark, work, mode, *values, **options):
    frame = spark.createDataFrame([(v,) for v in values], "rating double")
    frame.coalesce(1).write.mode("append").parquet(str(work / "in"))
    stream = spark.readStream.schema("rating double").parquet(str(work / "in"))
    X.write_result(X.stream_distribution(stream), str(work / mode), str(work / f"{mode}-log"),
                   mode, **options).awaitTermination()
    return X.read_result(spark, str(work / mode))


def test_changed_rows_give_the_same_table_as_whole_results(spark, work, rows):
    steps = [(1.0, 1.5, 4.0), (4.5, 2.0), (1.0,)]
    for step in steps:
        updated = scores(spark, work, "update", *step, keys=["score"])
    complete = scores(spark, work, "complete")
    assert rows(updated) == rows(complete) == [(1, 3), (2, 1), (4, 2)]
    # One table and the one before it, not a folder for each batch.
    assert len(list((work / "update" / "result").iterdir())) == 2
    with pytest.raises(ValueError, match="keys"):
        scores(spark, work, "update")


def test_a_repeated_batch_changes_nothing(spark, work, rows):
    kept = scores(spark, work, "complete", 1.0)
    before = rows(kept)
    # The same input under a fresh log is batch 0 again, which the table has seen.
    stream = spark.readStream.schema("rating double").parquet(str(work / "in"))
    doubled = X.stream_distribution(stream).withColumn("count", F.col("count") * 2)
    X.write_result(doubled, str(work / "complete"), str(work / "fresh-log")).awaitTermination()
    assert rows(X.read_result(spark, str(work / "complete"))) == before


def test_a_failing_batch_leaves_the_last_result(spark, work, rows, monkeypatch):
    scores(spark, work, "complete", 1.0)
    broken = X.stream_distribution(spark.readStream.schema("rating double").parquet(
        str(work / "in"))).withColumn("count", F.when(F.col("score") == 2, F.raise_error(
            F.lit("broken half-way"))).otherwise(F.col("count")))
    spark.createDataFrame([(2.0,)], "rating double").write.mode("append").parquet(str(work / "in"))
    log = str(work / "complete-log")
    with pytest.raises(Exception, match="broken half-way"):
        X.write_result(broken, str(work / "complete"), log).awaitTermination()
    assert rows(X.read_result(spark, str(work / "complete"))) == [(1, 1)]


@pytest.mark.parametrize("declared", [True, False])
def test_batches_are_not_sorted_by_their_folders(spark, work, declared, monkeypatch):
    put(work, a_csv="user_id,movie_id,rating\n1,2,3\n1,x,3\n4,5,five\n")
    module, seen = (X if declared else U), []
    begun = module.start

    def watched(lines, write, *rest):
        def noted(batch, batch_id):
            write(batch, batch_id)
            seen.append(batch.sparkSession.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        return begun(lines, noted, *rest)

    monkeypatch.setattr(module, "start", watched)
    path, out, log = str(work / "in"), str(work / "out"), str(work / "log")
    if declared:
        judged = X.parse_rating_lines(
            X.read_rating_lines(spark, path), ("user_id", "movie_id", "rating"))
        X.stream_ingest(judged, out, log).awaitTermination()
    else:
        U.ingest_uploads(U.read_upload_lines(spark, path), out, log).awaitTermination()
    assert seen == [str(X.MOST_FOLDERS)]
    # The caller's session keeps its own setting.
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_state_has_fewer_entries_than_ratings(spark, work):
    head = "user_id,movie_id,rating,ts\n"
    ratings = [f"{i % 97 - 5},{i},{i % 10},{i}\n" for i in range(2 * H.PARTS)]
    for name in ("a", "b"):
        put(work, **{f"{name}_csv": head + "".join(ratings)})
        ingest(spark, work, 0)
        query = unique(spark, work)
        assert 0 < query.lastProgress["stateOperators"][0]["numRowsTotal"] <= H.PARTS
    kept = U.uploaded_ratings(spark, str(work / "out"))
    assert kept.count() == kept.distinct().count() == 2 * H.PARTS
    assert kept.where("user_id = movie_id % 97 - 5 and rating = movie_id % 10 and ts = movie_id"
                      ).count() == 2 * H.PARTS


@pytest.mark.parametrize("parts", [1, 50])
def test_first_rows_are_those_of_sparks_own_operator(spark, work, rows, parts, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_ROWS", 3)
    monkeypatch.setattr(H, "GATHERED_ROWS", 40)
    schema = "key long, score double, at timestamp"
    stream = spark.readStream.schema(schema).parquet(str(work / "in"))
    runs = {
        "own": stream.withWatermark("at", "36 hours").dropDuplicatesWithinWatermark(["key", "score"]),
        "held": H.first_within(stream, ["key", "score"], "at", "36 hours", parts),
    }
    start = dt.datetime(2024, 1, 1)
    for step, hour in enumerate((0, 20, 36, 37, 50, 120, 121, 90, 156, 157, 300)):
        time = start + dt.timedelta(hours=hour)
        keys = [(i - 3) * 2**60 if i < 7 else i for i in range(step % 4, 60 + step, 1 + step % 3)]
        data = [(key, score, time) for key in keys for score in (0.0, -0.5, 1e300)]
        spark.createDataFrame(data * 2, schema).write.mode("append").parquet(str(work / "in"))
        for name, frame in runs.items():
            X.start(frame, lambda batch, n, name=name: batch.write.mode("append").parquet(
                str(work / name)), "append", str(work / f"{name}-log"), True).awaitTermination()
    found = {name: rows(spark.read.parquet(str(work / name)), "key", "score", "at") for name in runs}
    assert found["held"] == found["own"]
    assert len(found["held"]) > 3 * 60


def test_the_earliest_of_a_batch_counts(spark, work, rows):
    start, schema = dt.datetime(2024, 1, 1), "key long, at timestamp"
    stream = spark.readStream.schema(schema).parquet(str(work / "in"))
    # The watermark of the second batch is past a week after day 3, not after days 4 and 5.
    for batch in ([(1, 5), (1, 3), (1, 4)], [(1, 9), (2, 17.5)], [(1, 18)]):
        data = [(key, start + dt.timedelta(day)) for key, day in batch]
        spark.createDataFrame(data, schema).write.mode("append").parquet(str(work / "in"))
        X.start(H.first_within(stream, ["key"], "at", "7 days"),
                lambda batch, n: batch.write.mode("append").parquet(str(work / "kept")), "append",
                str(work / "log"), True).awaitTermination()
    kept = rows(spark.read.parquet(str(work / "kept")), "key", "at")
    assert sorted((key, (at - start).total_seconds() / 86400) for key, at in kept) == [
        (1, 3), (1, 18), (2, 17.5)]
