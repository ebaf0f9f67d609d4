import pytest
from pyspark.sql import functions as F

from starboard.functions import columns as fn


def values(spark, data, kind, expression):
    frame = spark.createDataFrame([(i, value) for i, value in enumerate(data)], f"i int, x {kind}")
    return [row[0] for row in frame.orderBy("i").select(expression(F.col("x"))).collect()]


def test_numbers(spark):
    text = ["4", " 4 ", "4.5", "-1", ".5", "1e1", "4f", "NaN", "Infinity", "0x1p3", "", "five", None]
    assert values(spark, text, "string", lambda x: fn.to_number(x, "double")) == [
        4.0, 4.0, 4.5, -1.0, 0.5, 10.0, None, None, None, None, None, None, None]
    assert values(spark, text, "string", lambda x: fn.to_number(x, "int")) == [
        4, 4, None, -1, None, None, None, None, None, None, None, None, None]
    assert values(spark, ["99999999999"], "string", lambda x: fn.to_number(x, "int")) == [None]


def test_title_year(spark):
    titles = ["Toy Story (1995)", "Se7en (1995)  ", "2001 (Part 2)", "Heat", "(1995) Heat", None]
    assert values(spark, titles, "string", fn.strip_title_year) == [
        "Toy Story", "Se7en", "2001 (Part 2)", "Heat", "(1995) Heat", None]


def test_genres(spark):
    genres = ["Action|Comedy", " Drama | |War|", "", None]
    assert values(spark, genres, "string", fn.genre_list) == [
        ["Action", "Comedy"], ["Drama", "War"], [], None]


def test_age_groups(spark):
    ages = [1, 18, 19, 25, 26, 35, 36, 45, 46, 55, 56, 99, None]
    assert values(spark, ages, "int", fn.age_bucket) == [
        "Under18", "Under18", "19-25", "19-25", "26-35", "26-35", "36-45", "36-45",
        "46-55", "46-55", "56+", "56+", None]


def test_codes(spark):
    assert values(spark, ["M", "m", "F", "x", None], "string", fn.decode_gender) == [
        "Male", "Male", "Female", "Female", None]
    codes = ["0", " 20 ", "21", "-1", "4.0", "", "99999999999", None]
    assert values(spark, codes, "string", fn.decode_occupation) == [
        "other", "writer", "unknown", "unknown", "unknown", "unknown", "unknown", "unknown"]


def test_scores(spark):
    ratings = [0.5, 1.0, 3.5, 4.49, 4.5, None]
    assert values(spark, ratings, "double", fn.score_bucket) == [0, 1, 3, 4, 4, None]
    assert values(spark, ratings, "double", lambda x: fn.score_bucket(x, "round")) == [
        1, 1, 4, 4, 5, None]
    with pytest.raises(ValueError):
        fn.score_bucket("x", "up")


def test_ratio_rounds_half_up_and_survives_zero(spark):
    frame = spark.createDataFrame([(1, 8), (1, 0)], "a int, b int")
    assert [r[0] for r in frame.select(fn.percent("a", "b", 1)).collect()] == [12.5, None]
    assert spark.range(1).select(fn.ratio(F.lit(1.0), F.lit(8.0), 2)).first()[0] == 0.13
