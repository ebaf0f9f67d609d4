import pytest
from pyspark.sql import functions as F

from starboard.operators import cleaning as C
from starboard.operators import mapping as M
from starboard.sources import tables

STRICT = ("user_id", "movie_id", "ts")


@pytest.fixture
def dirty(spark):
    return spark.createDataFrame(
        [("1", "10", "4", "100"), ("1", "10", " 4 ", "100"), ("2", "x", "4", "100"),
         (None, "10", "4", "100"), ("3", "10", "five", "1"), ("3", "11", "", "1"),
         ("3", "12", "7.5", "1"), ("4", "10", "-1", "1"), ("5", "10", "0.5", "late")],
        "user_id string, movie_id string, rating string, ts string")


def test_lenient_and_strict(dirty, rows):
    valid, bad = C.clean_ratings(dirty, 0, 10)
    assert rows(valid) == [(1, 10, 4.0, 100), (3, 12, 7.5, 1), (5, 10, 0.5, 0)]
    assert rows(bad, "reason") == [
        ("invalid_rating",), ("invalid_rating",), ("missing_key",), ("missing_key",),
        ("rating_out_of_range",)]
    assert bad.where("reason = 'missing_key' and movie_id = 'x'").count() == 1
    strict, aside = C.clean_ratings(dirty, 1, 5, STRICT)
    assert rows(strict) == [(1, 10, 4.0, 100)]
    assert aside.where("reason = 'invalid_timestamp'").count() == 1


def test_duplicates_stay_on_request(dirty):
    valid, bad = C.clean_ratings(dirty, 0, 10, dedup=False)
    assert valid.count() + bad.count() == dirty.count()


def test_quality_counts(dirty):
    counts = C.quality_counts(dirty).first().asDict()
    assert counts == {
        "rows_before": 9, "rows_after": 4, "rows_removed": 5, "missing_key": 2,
        "invalid_timestamp": 0, "invalid_rating": 2, "rating_out_of_range": 1}


def test_missing_time_becomes_zero(spark, rows):
    frame = spark.createDataFrame([(1, 2, 3.0)], "user_id int, movie_id int, rating double")
    assert rows(C.clean_ratings(frame)[0]) == [(1, 2, 3.0, 0)]


def test_users_and_counts(spark, rows):
    users = spark.createDataFrame(
        [("1", "Male", " 18 ", ""), ("1", "Male", "18", None), ("2", "Female", "x", "lawyer"),
         (None, "Male", "3", "artist")],
        "user_id string, gender string, age string, occupation string")
    clean = C.clean_users(users)
    assert rows(clean, "user_id", "age", "age_group", "occupation") == [
        (1, 18, "Under18", None), (2, None, None, "lawyer")]
    assert rows(C.gender_tally(clean)) == [(1, 1)]
    assert rows(C.table_counts({"users": clean, "raw": users})) == [("raw", 4), ("users", 2)]


def test_movies(spark, rows):
    movies = spark.createDataFrame(
        [("1", " Heat (1995) ", "Action| |Crime"), ("1", "Heat (1995)", "Action| |Crime"), ("x", "a", "b")],
        "movie_id string, title string, genres_raw string")
    clean = C.clean_movies(movies)
    assert rows(clean) == [(1, "Heat", "Heat (1995)", "Action| |Crime")]
    assert rows(C.movie_genres(clean)) == [(1, "Heat", "Action"), (1, "Heat", "Crime")]


def test_trim_and_keys(spark, rows):
    frame = spark.createDataFrame([(" a\t", 1), ("b", None)], "s string, k int")
    assert rows(C.require_keys(C.trim_fields(frame), "k")) == [("a", 1)]


def test_headers_and_aliases():
    assert M.normalize_header(['"User_ID"', " `Score` ", "'x'"]) == ["user_id", "score", "x"]
    assert M.map_aliases(["Movie", "movieId", "USER", "rate", "Score", "genres_raw", "ts"]) == {
        "movieId": "movie_id", "USER": "user_id", "Score": "rating", "genres_raw": "genres",
        "ts": "time"}


@pytest.mark.parametrize("names, role", [
    (["user_id", "movie_id", "rating"], "ratings"), (["rating"], "ratings"),
    (["movie_id", "title"], "movies"), (["movie_id", "title", "rating"], "ratings"),
    (["user_id", "age"], "users"), (["user_id", "gender"], "users"),
    (["user_id", "movie_id", "time"], None), (["movie_id"], None),
])
def test_classification(names, role):
    assert M.classify_table(names) == role


def test_canonicalize(spark, rows):
    raw = spark.createDataFrame([("1", "2", "x", "z")], ["userId", "movie", "score", "zip.code"])
    renamed = M.rename_columns(raw)
    assert renamed.columns == ["user_id", "movie_id", "rating", "zip.code"]
    assert rows(M.canonicalize(renamed, "ratings")) == [(1, 2, None, 0)]


def test_default_fill(spark, rows):
    frame = spark.createDataFrame([(1, None), (2, "F")], "user_id int, gender string")
    assert rows(M.default_fill(frame, M.PROFILE_DEFAULTS)) == [
        (1, "?", 0, "?"), (2, "F", 0, "?")]
    assert set(M.default_fill(frame, M.USER_DEFAULTS).columns) >= {"zipcode", "age_group"}


def test_merge_role_frames(spark, rows):
    a = spark.createDataFrame([(1, 2)], "user_id int, rating int")
    b = spark.createDataFrame([(3, 4, 5)], "user_id int, rating int, time int")
    assert rows(M.merge_role_frames([a, b])) == [(1, 2, None), (3, 4, 5)]


def test_raw_files(spark, folder, rows):
    path = folder(
        ratings_dat="UserID::MovieID::Rating::Timestamp\n1::10::5::97\n\n1::10::5::97\n1::10::9::97\n1::x::3::9\n2::11::3\n",
        movies_dat="1::Toy Story (1995)::Animation|Comedy\n2::Title::Drama\n3::short\n",
        users_dat="1::F::1::10::48067\n2::m::56::16::70072 \n3::M::25::99::x\n4::M::25::0\n".encode()
        + b"5::M::30::\xff7::12\n",
    )
    assert rows(tables.read_raw_dat(spark, f"{path}/ratings.dat", "ratings")) == [(1, 10, 5.0, 97)]
    assert rows(tables.read_raw_dat(spark, f"{path}/movies.dat", "movies"), "movie_id", "title") == [
        (1, "Toy Story"), (2, "Title")]
    users = tables.read_raw_dat(spark, f"{path}/users.dat", "users")
    assert rows(users.where("user_id < 4")) == [
        (1, "Female", 1, "Under18", 10, "K-12 student", "48067"),
        (2, "Male", 56, "56+", 16, "self-employed", "70072"),
        (3, "Male", 25, "19-25", 99, "unknown", "x")]


def test_header_tables(spark, folder, rows):
    path = folder(
        ratings_csv="user_id,movie_id,rating,timestamp\n1,2,4.5,9\nx,2,3,9\n",
        movies_csv='movie_id,title,title_full,genres_raw\n1,"A, the","A, the (1999)",Drama\n',
        up_tsv="movieId\tTitle\tGenre\n1\tHeat\tCrime\n",
    )
    assert rows(tables.read_table(spark, f"{path}/ratings.csv", "ratings")) == [
        (1, 2, 4.5, 9), (None, 2, 3.0, 9)]
    assert rows(tables.read_table(spark, f"{path}/movies.csv", "movies")) == [
        (1, "A, the", "A, the (1999)", "Drama")]
    assert tables.read_dialect(spark, [f"{path}/up.tsv"], "\t").columns == ["movie_id", "title", "genres"]


def test_every_file_is_read_by_its_own_header(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("user_id,movie_id,rating\n1,2,3\n\nuser_id,movie_id,rating\n5\n")
    (tmp_path / "b.csv").write_text('\n"Rating","movie_id",note,user_id\n4,20,"a, b",10\n3,21,,11\n')
    (tmp_path / "c.csv").write_text("ts,user_id\n7,3\n")
    (tmp_path / "d.csv").write_text("")
    paths = [str(tmp_path / f"{name}.csv") for name in "abcd"]
    assert sorted(rows(tables.read_table(spark, str(tmp_path), "ratings")), key=repr) == sorted([
        (1, 2, 3.0, None), (5, None, None, None), (10, 20, 4.0, None), (11, 21, 3.0, None),
        (3, None, None, 7)], key=repr)
    both = tables.read_dialect(spark, paths, ",")
    assert set(both.columns) == {"user_id", "movie_id", "rating", "note", "time"}
    assert rows(both, "user_id", "rating", "note", "time") == sorted([
        ("1", "3", None, None), ("5", None, None, None), ("10", "4", "a, b", None),
        ("11", "3", None, None), ("3", None, None, "7")], key=repr)


def test_headers_count_across_splits_and_without_broadcast(spark, tmp_path, rows, monkeypatch):
    (tmp_path / "a.csv").write_text("user_id,movie_id,rating\n" + "1,2,3\n" * 2000)
    (tmp_path / "b.csv").write_text("rating,movie_id,user_id\n" + "3,2,1\n" * 2000)
    monkeypatch.setattr("starboard.sources.sizes.BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        found = tables.read_table(spark, str(tmp_path), "ratings")
        assert found.rdd.getNumPartitions() >= 1
        assert rows(found.distinct()) == [(1, 2, 3.0, None)] and found.count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_catalog(spark, rows):
    spark.range(3).createOrReplaceTempView("counted")
    assert rows(tables.catalog_counts(spark).where(F.col("tbl") == "counted")) == [("counted", 3)]
    assert tables.preview(spark, "counted", 2).count() == 2


def test_bytes_that_are_no_utf8_are_dropped(spark, tmp_path, rows):
    lines = [b"1::Caf\xc3\xa9 \xff\xfe(1999)::Drama", b"2::\xe2\x82::War", b"3::\xc3::Drama|W\x80ar",
             "4::kept � here::War".encode(), "5::kept �".encode() + b"\xf0\x9f\x98 so::War",
             b"\xff6::six::War", "7::\U0001f600::War".encode()]
    (tmp_path / "movies.dat").write_bytes(b"\n".join(lines) + b"\n")
    expected = []
    for line in lines:
        number, title, genres = line.decode(errors="ignore").split("::")
        expected.append((int(number), title.replace(" (1999)", ""), title, genres))
    found = tables.read_raw_dat(spark, str(tmp_path / "movies.dat"), "movies")
    assert rows(found) == sorted(expected, key=repr)
