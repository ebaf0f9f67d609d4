"""Rating files of every dialect, and of every kind of damage, written from the driver's tables.

Every row of the tables becomes a line. The files land in a fresh folder of the shared
scratch space, once per session and scale, and the ingestion queries read them from there.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.bindings import epoch_seconds, half_star, movies, table
from starboard.session import scratch_path


def _text(column: Column) -> Column:
    return column.cast("string")


def _write_lines(lines: Column, header: str, df: DataFrame, path: str) -> None:
    """Raw lines below a header line in each file; nothing is quoted or escaped."""
    (
        df.select(lines.alias(header))
        .write.mode("append")
        .option("header", True)
        .option("sep", "\u0001")
        .option("quote", "")
        .option("emptyValue", "")
        .option("escape", "\u0002")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def damaged_line(line_number: Column, user: Column, movie: Column, rating: Column, ts: Column) -> Column:
    """A rating line; all but the line numbers 1 and 7 are damaged, each in its own way."""
    whole = F.concat_ws(",", user, movie, rating, ts)
    return (
        F.when(line_number == 2, "")
        .when(line_number == 3, "user_id,movie_id,rating,timestamp")
        .when(line_number == 4, F.concat_ws(",", user, movie, F.lit("five"), ts))
        .when(line_number == 5, user)
        .when(line_number == 6, F.concat_ws(",", user, movie, F.lit("100"), ts))
        .when(line_number == 7, F.concat_ws(",", whole, F.lit("999"), F.lit("more")))
        .otherwise(whole)
    )


def damaged_ratings(spark: SparkSession, sf: str) -> tuple[DataFrame, Column, str]:
    lines = damaged_line(
        F.col("l_linenumber"),
        _text(F.col("l_orderkey")),
        _text(F.col("l_partkey")),
        _text(half_star(F.col("l_quantity"))),
        _text(epoch_seconds(F.col("l_shipdate"))),
    )
    return table(spark, sf, "lineitem"), lines, "user_id,movie_id,rating,timestamp"


@cache
def messy_folder(spark: SparkSession, sf: str) -> str:
    """Files of three delimiters and all roles, among them some that must be rejected."""
    path = scratch_path(spark, "messy")

    df, lines, header = damaged_ratings(spark, sf)
    _write_lines(lines, header, df, path)

    events = F.concat_ws(
        "\t",
        _text(F.col("user_id")),
        _text(F.col("event_id")),
        _text(half_star(F.col("value"))),
        _text(epoch_seconds(F.col("ts"))),
    )
    _write_lines(events, "userId\tmovie\tscore\ttime", table(spark, sf, "events"), path)

    orders = F.concat_ws(
        "::",
        _text(F.col("o_custkey")),
        _text(F.col("o_orderkey")),
        _text(F.floor("o_totalprice") % 12),
        _text(epoch_seconds(F.col("o_orderdate"))),
    )
    _write_lines(orders, "UserID::MovieID::Rating::Timestamp", table(spark, sf, "orders"), path)

    parts = F.concat(
        _text(F.col("movie_id")), F.lit(',"'), F.col("title"), F.lit(", the "),
        F.col("title_full"), F.lit('",'), F.col("genres_raw"), F.lit(",x"),
    )
    _write_lines(parts, "movieId,title,genre,shelf", movies(spark, sf), path)

    customers = F.concat_ws(
        "\t",
        _text(F.col("c_custkey")),
        F.when(F.col("c_custkey") % 3 == 0, "F").otherwise("M"),
        F.when(F.col("c_custkey") % 11 == 5, "").otherwise(_text(F.col("c_custkey") % 70)),
        F.col("c_mktsegment"),
        F.lit("12345"),
    )
    _write_lines(
        customers, "user_id\tgender\tage\toccupation\tzip_code", table(spark, sf, "customer"), path
    )

    no_rating = F.concat_ws(",", _text(F.col("s_suppkey")), _text(F.col("s_nationkey")), F.lit("1"))
    _write_lines(no_rating, "user_id,movie_id,timestamp", table(spark, sf, "supplier"), path)

    unknown = table(spark, sf, "region").coalesce(1)
    _write_lines(F.concat(F.lit("x,"), "r_name"), "alpha,beta", unknown, path)
    table(spark, sf, "region").where("false").select("r_name").coalesce(1).write.mode(
        "append").text(path)

    prose = table(spark, sf, "region").select(F.concat(F.lit("A note about "), "r_name"))
    prose.write.mode("append").text(path)
    return path


def _event_columns() -> dict[str, Column]:
    return {
        "user": _text(F.col("user_id")), "movie": _text(F.col("event_id")),
        "score": _text(half_star(F.col("value"))), "time": _text(epoch_seconds(F.col("ts"))),
    }


@cache
def headerless_folder(spark: SparkSession, sf: str) -> str:
    """Files without headers: three delimiters, all roles, customary and other column orders,
    one file whose columns cannot be told apart and one that holds none of the roles."""
    path = scratch_path(spark, "headerless")

    def put(name: str, sep: str, *columns: Column) -> None:
        table(spark, sf, name).select(F.concat_ws(sep, *columns)).write.mode("append").text(path)

    line = F.col("l_linenumber")
    put("lineitem", ",", _text(F.col("l_orderkey")), _text(F.col("l_partkey")),
        F.when(line == 4, "five").when(line == 6, "100")
        .otherwise(_text(half_star(F.col("l_quantity")))),
        _text(epoch_seconds(F.col("l_shipdate"))))
    event = _event_columns()
    put("events", "\t", event["time"], event["score"], event["user"], event["movie"])
    key = F.col("c_custkey")
    put("customer", "\t", _text(key), F.when(key % 3 == 0, "F").otherwise("M"),
        F.when(key % 11 == 5, "").otherwise(_text(key % 70)), F.col("c_mktsegment"), F.lit("12345"))
    catalogue = movies(spark, sf)
    quoted = F.concat(F.lit('"'), "title", F.lit(", the "), "title_full", F.lit('"'))
    catalogue.select(F.concat_ws(",", _text(F.col("movie_id")), quoted, "genres_raw")).write.mode(
        "append").text(path)
    supplier = F.col("s_suppkey")
    score = _text((supplier % 10 + 1) / F.lit(2.0))
    put("supplier", ",", _text(supplier + 1000), score, _text(F.col("s_nationkey") + 1000), score)
    put("region", ",", F.lit("x"), F.col("r_name"))
    return path


def put_uploads(spark: SparkSession, sf: str, path: str, late: bool) -> None:
    """Files for a stream. First three layouts of ratings: with an extra column that holds header
    words, with other names in another order, and with no names; and movies, one of them called
    Score. Later a part of the ratings once more, laid out differently."""
    lines = table(spark, sf, "lineitem")
    line = F.col("l_linenumber")
    user, movie = _text(F.col("l_orderkey")), _text(F.col("l_partkey"))
    score = F.when(line == 4, "five").otherwise(_text(half_star(F.col("l_quantity"))))
    time = _text(epoch_seconds(F.col("l_shipdate")))
    if late:
        again = F.concat_ws("\t", time, movie, user, score)
        _write_lines(again, "ts\tmovie\tuser\trate", lines.where(line <= 4), path)
        return
    note = F.element_at(F.array(F.lit("Score"), F.lit("title"), F.lit("plain")),
                        (line % 3 + 1).cast("int"))
    _write_lines(F.concat_ws(",", user, movie, score, note, time),
                 "user_id,movie_id,rating,note,timestamp", lines, path)
    event = _event_columns()
    swapped = F.concat_ws(",", event["movie"], event["time"], event["user"], event["score"])
    _write_lines(swapped, "movie,time,userId,score", table(spark, sf, "events"), path)
    orders = F.concat_ws("::", _text(F.col("o_custkey")), _text(F.col("o_orderkey")),
                         _text(half_star(F.col("o_totalprice"))),
                         _text(epoch_seconds(F.col("o_orderdate"))))
    table(spark, sf, "orders").select(orders).write.mode("append").text(path)
    title = F.when(F.col("movie_id") % 2 == 0, "Score").otherwise(F.col("title"))
    _write_lines(F.concat_ws("\t", _text(F.col("movie_id")), title, F.col("genres_raw")),
                 "movieId\ttitle\tgenres", movies(spark, sf), path)


@cache
def damaged_folder(spark: SparkSession, sf: str) -> str:
    """Only the damaged comma separated ratings; the first line of each order comes twice."""
    path = scratch_path(spark, "damaged")
    df, lines, header = damaged_ratings(spark, sf)
    _write_lines(lines, header, df, path)
    _write_lines(lines, header, df.where("l_linenumber = 1"), path)
    return path


@cache
def raw_dat_folder(spark: SparkSession, sf: str) -> str:
    """Headerless '::' files of coded users, one folder per kind."""
    path = scratch_path(spark, "raw")
    coded = F.concat_ws(
        "::",
        _text(F.col("c_custkey")),
        F.element_at(F.array(*map(F.lit, ("M", "m", "F", "x"))), (F.col("c_custkey") % 4 + 1).cast("int")),
        F.concat(F.lit(" "), _text(F.col("c_custkey") % 70)),
        _text(F.col("c_custkey") % 25),
        F.lit(" 48067 "),
    )
    table(spark, sf, "customer").select(coded).write.text(f"{path}/users")
    titles = F.concat_ws("::", _text(F.col("movie_id")), "title_full", "genres_raw")
    movies(spark, sf).select(titles).write.text(f"{path}/movies")
    rated = F.concat_ws(
        "::",
        _text(F.col("l_orderkey")),
        _text(F.col("l_partkey")),
        F.when(F.col("l_linenumber") == 4, "five").when(F.col("l_linenumber") == 6, "0")
        .otherwise(_text(half_star(F.col("l_quantity")))),
        F.when(F.col("l_linenumber") == 5, "late").otherwise(_text(epoch_seconds(F.col("l_shipdate")))),
    )
    table(spark, sf, "lineitem").select(rated).write.text(f"{path}/ratings")
    return path


@cache
def canonical_csv(spark: SparkSession, sf: str) -> str:
    """Movies as a CSV table with a header row."""
    path = scratch_path(spark, "csv")
    movies(spark, sf).write.option("header", True).option("escape", '"').csv(path)
    return path


@cache
def two_headers(spark: SparkSession, sf: str) -> str:
    """Ratings as CSV tables of two column orders, one with quotes and a column of its own."""
    path = scratch_path(spark, "two-headers")
    line = table(spark, sf, "lineitem")
    user, movie = _text(F.col("l_orderkey")), _text(F.col("l_partkey"))
    score, time = _text(half_star(F.col("l_quantity"))), _text(epoch_seconds(F.col("l_shipdate")))
    _write_lines(F.concat_ws(",", user, movie, score, time), "user_id,movie_id,rating,timestamp",
                 line, path)
    event = _event_columns()
    note = F.concat(F.lit('"by '), _text(F.col("event_id")), F.lit(', later"'))
    _write_lines(F.concat_ws(",", event["score"], note, event["movie"], event["user"], event["time"]),
                 '"rating",note,"movie_id",user_id,timestamp', table(spark, sf, "events"), path)
    return path


@cache
def marked_csv(spark: SparkSession, sf: str) -> str:
    """Ratings as CSV tables whose files begin with a byte order mark."""
    path = scratch_path(spark, "marked")
    lines = F.concat_ws(",", *_event_columns().values())
    _write_lines(lines, "\ufeffuser_id,movie_id,rating,timestamp", table(spark, sf, "events"), path)
    return path


@cache
def broken_titles(spark: SparkSession, sf: str) -> str:
    """Headerless movies whose titles hold bytes that are no UTF-8."""
    path = scratch_path(spark, "broken")
    parts = table(spark, sf, "part")
    bad = F.element_at(F.array(*[F.unhex(F.lit(code)).cast("string") for code in (
        "FF", "E282", "C3", "F09F98")]), (F.col("p_partkey") % 4 + 1).cast("int"))
    parts.select(F.concat(
        _text(F.col("p_partkey")), F.lit("::"), bad, "p_name", bad, F.lit(" \u00e9::"), "p_type")
    ).write.text(path)
    return path


@cache
def unusable_folders(spark: SparkSession, sf: str) -> dict[str, str]:
    """Folders that have to be rejected: prose, movies alone, ratings that are no numbers."""
    paths = {name: scratch_path(spark, name) for name in ("prose", "movies", "words")}
    table(spark, sf, "region").select("r_name").write.text(paths["prose"])
    _write_lines(F.concat_ws(",", _text(F.col("movie_id")), "title"), "movie_id,title",
                 movies(spark, sf), paths["movies"])
    _write_lines(F.concat_ws(",", _text(F.col("s_suppkey")), F.lit("1"), F.lit("good")),
                 "user_id,movie_id,rating", table(spark, sf, "supplier"), paths["words"])
    return paths
