"""The rating model bound to the driver's tables, for Spark and as SQL for the oracle.

Whole tables are bound, without any filter. Profiles without ratings, movies without
ratings and ratings without profile or movie come from tables that stand apart:

* users are all customers and all suppliers; suppliers never rate;
* movies are all parts and all nations; nations are never rated;
* ratings are all order lines and all events; the users of events have no profile, and
  error events rate a movie that is not in the catalogue.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starboard.functions.columns import age_bucket
from starboard.operators.cleaning import movie_genres
from starboard.schemas import AGE_GROUPS


@cache
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of the driver; cached, for every fresh read looks the schema up again."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def epoch_seconds(moment: Column) -> Column:
    """Seconds since 1970 read off the clock shown, whatever the session time zone."""
    days = F.datediff(moment.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def half_star(value: Column) -> Column:
    """Whole part of a number to 0.5 ... 5.0."""
    return (value.cast("int") % 10 + 1) / F.lit(2.0)


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    ordered = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    lines = ordered.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        half_star(F.col("l_quantity")).alias("rating"),
        epoch_seconds(F.col("l_shipdate")).alias("ts"),
    )
    events = table(spark, sf, "events").select(
        (-1 - F.col("user_id")).alias("user_id"),
        F.when(F.col("event_type") == "error", F.lit(-1000).cast("bigint"))
        .otherwise(F.col("user_id")).alias("movie_id"),
        half_star(F.col("value")).alias("rating"),
        epoch_seconds(F.col("ts")).alias("ts"),
    )
    return lines.unionAll(events)


def movies(spark: SparkSession, sf: str) -> DataFrame:
    repeated = F.when(F.col("p_size") % 3 == 0, F.col("p_type")).otherwise("")
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.concat("p_name", F.lit(" ("), (1950 + F.col("p_size")).cast("string"), F.lit(")"))
        .alias("title_full"),
        F.concat("p_type", F.lit("|"), "p_brand", F.lit("| "), repeated).alias("genres_raw"),
    )
    nations = table(spark, sf, "nation").select(
        (-1 - F.col("n_nationkey")).cast("bigint").alias("movie_id"),
        F.col("n_name").alias("title"),
        F.concat("n_name", F.lit(" (1999)")).alias("title_full"),
        F.lit("ECONOMY|TRAVEL").alias("genres_raw"),
    )
    return parts.unionAll(nations)


def genres(spark: SparkSession, sf: str) -> DataFrame:
    return movie_genres(movies(spark, sf))


def users(spark: SparkSession, sf: str) -> DataFrame:
    def bound(key: str, user_id: Column, occupation: Column) -> list[Column]:
        return [
            user_id.alias("user_id"),
            F.when(F.col(key) % 3 == 0, "Female").otherwise("Male").alias("gender"),
            (F.col(key) % 70).cast("int").alias("age"),
            occupation.alias("occupation"),
        ]

    customers = table(spark, sf, "customer").select(
        *bound("c_custkey", F.col("c_custkey"), F.col("c_mktsegment"))
    )
    building = F.when(F.col("s_acctbal") < 5000, "BUILDING").otherwise("SUPPLIER")
    suppliers = table(spark, sf, "supplier").select(
        *bound("s_suppkey", -1000000000 - F.col("s_suppkey"), building)
    )
    both = customers.unionAll(suppliers)
    return both.withColumn("age_group", age_bucket("age"))


def age_case(age: str) -> str:
    """The age group of an age, as SQL."""
    tests = [
        f"when {age} is not null then '{label}'" if highest is None
        else f"when {age} <= {highest} then '{label}'"
        for label, highest in AGE_GROUPS
    ]
    return f"case {' '.join(tests)} end"


# The same tables for the oracle, as common table expressions.
SQL = {
    "ratings": """
  select o_custkey as user_id, l_partkey as movie_id,
         (cast(trunc(l_quantity) as integer) % 10 + 1) / 2.0::double as rating,
         cast(floor(epoch(l_shipdate)) as bigint) as ts
  from lineitem join orders on l_orderkey = o_orderkey
  union all
  select -1 - user_id, case when event_type = 'error' then -1000 else user_id end,
         (cast(trunc(value) as integer) % 10 + 1) / 2.0::double,
         cast(floor(epoch(ts)) as bigint)
  from events""",
    "movies": """
  select p_partkey as movie_id, p_name as title,
         p_name || ' (' || cast(1950 + p_size as varchar) || ')' as title_full,
         p_type || '|' || p_brand || '| ' ||
           case when p_size % 3 = 0 then p_type else '' end as genres_raw
  from part
  union all
  select cast(-1 - n_nationkey as bigint), n_name, n_name || ' (1999)', 'ECONOMY|TRAVEL'
  from nation""",
    "genres": """
  select distinct movie_id, title, trim(piece) as genre
  from (select movie_id, title, unnest(string_split(genres_raw, '|')) as piece from movies)
  where trim(piece) <> ''""",
    "users": f"""
  select *, {age_case("age")} as age_group
  from (
    select c_custkey as user_id, case when c_custkey % 3 = 0 then 'Female' else 'Male' end as gender,
           cast(c_custkey % 70 as integer) as age, c_mktsegment as occupation from customer
    union all
    select -1000000000 - s_suppkey, case when s_suppkey % 3 = 0 then 'Female' else 'Male' end,
           cast(s_suppkey % 70 as integer),
           case when s_acctbal < 5000 then 'BUILDING' else 'SUPPLIER' end from supplier)""",
}


def with_tables(*names: str, sql: str) -> str:
    """``sql`` behind the bound tables it reads. ``genres`` brings ``movies`` along."""
    wanted = list(names)
    if "genres" in wanted and "movies" not in wanted:
        wanted.insert(0, "movies")
    wanted.sort(key=lambda name: list(SQL).index(name))
    ctes = ",\n".join(f"{name} as ({SQL[name]})" for name in wanted)
    return f"with {ctes}\n{sql}"
