"""Every operator as a query over the driver's tables: name -> f(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import bindings as B
from checks import raw_files as R
from starboard.functions import columns as fn
from starboard.operators import analyses as A
from starboard.operators import cleaning as C
from starboard.operators import mapping
from starboard.operators import present as P
from starboard.plans import managed
from starboard.plans import marts as M
from starboard.plans.analysis import Frames, analyze_all
from starboard.plans.dataset import (
    Dataset,
    DatasetRejected,
    analyze_dataset,
    analyze_raw_dataset,
    load_dataset,
)
from starboard.session import scratch_path, size_shuffles, stage
from starboard.sources import tables
from starboard.sources.dialects import admission_report, sniff_dialect
from starboard.sources.lines import list_files, scan_lines
from starboard.sources.parsing import HEADER
from starboard.sources.profiles import with_profiles
from starboard.streaming import ratings as X
from starboard.streaming import uploads as U

Query = Callable[[SparkSession, str], DataFrame]


def _r(build: Callable[..., DataFrame], *names: str, **options) -> Query:
    """A query that applies ``build`` to bound tables."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        frames = [getattr(B, name)(spark, sf) for name in names]
        size_shuffles(*frames)
        return build(*frames, **options)

    return run


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, which every reader of results shows alike."""
    casts = {n: F.col(n).cast("double") for n, kind in df.dtypes if kind.startswith("decimal")}
    return df.withColumns(casts) if casts else df


# ---- cleaning --------------------------------------------------------------------------------


def dirty_ratings(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as rating rows of text, good and bad by line number."""
    number = F.col("l_linenumber")
    rating = (
        F.when(number == 1, "five")
        .when(number == 2, "")
        .when(number == 3, "-1")
        .when(number == 4, "100")
        .when(number == 5, F.lit(" 4 "))
        .when(number == 6, "7.5")
        .otherwise(B.half_star(F.col("l_quantity")).cast("string"))
    )
    return B.table(spark, sf, "lineitem").select(
        F.when(F.col("l_tax") > 0.07, F.lit(None).cast("string"))
        .otherwise(F.col("l_orderkey").cast("string")).alias("user_id"),
        F.col("l_partkey").cast("string").alias("movie_id"),
        rating.alias("rating"),
        F.when(F.col("l_returnflag") == "R", "n/a")
        .otherwise(B.epoch_seconds(F.col("l_shipdate")).cast("string")).alias("ts"),
    )


STRICT = ("user_id", "movie_id", "ts")


def strict_filter(spark, sf):
    return C.clean_ratings(dirty_ratings(spark, sf), 1, 5, STRICT, dedup=False)[0]


def lenient_filter(spark, sf):
    valid, _ = C.clean_ratings(dirty_ratings(spark, sf), 0, 10, dedup=False)
    return valid


def quarantine_reasons(spark, sf):
    _, bad = C.clean_ratings(dirty_ratings(spark, sf), 1, 5, STRICT)
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def strip_year(spark, sf):
    titles = B.movies(spark, sf).select("movie_id", "title_full")
    return titles.withColumn("title", fn.strip_title_year("title_full"))


def customer_codes(spark, sf):
    letter = F.element_at(
        F.array(*map(F.lit, ("M", "m", "F", "x"))), (F.col("c_custkey") % 4 + 1).cast("int")
    )
    return B.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        letter.alias("letter"),
        F.concat(F.lit(" "), (F.col("c_custkey") % 25).cast("string")).alias("code"),
        F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("occupation"),
    )


def decode_gender(spark, sf):
    return customer_codes(spark, sf).select("user_id", fn.decode_gender("letter").alias("gender"))


def decode_occupation(spark, sf):
    return customer_codes(spark, sf).select(
        "user_id", fn.decode_occupation("code").alias("occupation")
    )


def trim_fields(spark, sf):
    return C.trim_fields(customer_codes(spark, sf).select("user_id", "occupation"), "occupation")


def age_buckets(spark, sf):
    return B.users(spark, sf).select("user_id", "age", fn.age_bucket("age").alias("age_group"))


def distinct_rows(spark, sf):
    ratings = B.ratings(spark, sf)
    return C.distinct_rows(ratings.unionAll(ratings))


def require_keys(spark, sf):
    known = F.when(F.col("user_id") >= 0, F.col("user_id"))
    return C.require_keys(B.ratings(spark, sf).withColumn("user_id", known), "user_id")


def load_check(spark, sf):
    names = ("movies", "ratings", "users")
    loaded = {name: getattr(B, name)(spark, sf) for name in names}
    return C.table_counts({**loaded, "movie_genres": B.genres(spark, sf)})


# ---- mapping ---------------------------------------------------------------------------------


def aliased_ratings(spark, sf):
    return B.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("UserID"),
        F.col("l_partkey").cast("string").alias("movie"),
        F.col("l_quantity").cast("string").alias("Score"),
        F.col("l_linenumber").cast("string").alias("shelf"),
    )


def map_aliases(spark, sf):
    return mapping.rename_columns(aliased_ratings(spark, sf))


def canonical_ratings(spark, sf):
    return mapping.canonicalize(mapping.rename_columns(aliased_ratings(spark, sf)), "ratings")


def canonical_movies(spark, sf):
    bare = B.table(spark, sf, "part").select(
        F.col("p_partkey").alias("MovieId"), F.col("p_name").alias("Title")
    )
    return mapping.canonicalize(mapping.rename_columns(bare), "movies")


def default_fill(spark, sf):
    raters = B.ratings(spark, sf).select("user_id").distinct()
    profiles = A.profile(B.users(spark, sf))
    return mapping.default_fill(
        raters.join(profiles, "user_id", "left"), mapping.PROFILE_DEFAULTS
    )


def merge_role_frames(spark, sf):
    lines = mapping.rename_columns(aliased_ratings(spark, sf)).drop("shelf")
    events = B.table(spark, sf, "events").select(
        F.col("user_id").cast("string"),
        F.col("event_id").cast("string").alias("movie_id"),
        F.lit("3").alias("rating"),
        F.lit("7").alias("time"),
    )
    merged = mapping.merge_role_frames([lines, events])
    return mapping.canonicalize(merged, "ratings").groupBy("rating", "ts").agg(
        F.count(F.lit(1)).alias("n"), F.min("user_id").alias("least_user")
    )


# ---- ingestion -------------------------------------------------------------------------------


# Lines of a file below its header; their sum does not hang on the number of files.
DATA_LINES = "n_lines - if(has_header, 1, 0)"


def dialects(spark, sf):
    lines = scan_lines(spark, R.messy_folder(spark, sf))
    head = F.when(F.col("sep").isNotNull(), F.col("head")).otherwise("prose")
    sep = F.when(F.col("sep") == "\t", "tab").otherwise(F.coalesce("sep", F.lit("none")))
    fields = F.when(F.col("sep").isNotNull(), F.array_join("fields", "|")).otherwise("none")
    return sniff_dialect(lines).groupBy(
        head.alias("head"), sep.alias("sep"), "has_header",
        F.coalesce("role", F.lit("none")).alias("role"), fields.alias("fields"),
    ).agg(F.sum(F.expr(DATA_LINES)).alias("n_lines"))


def admission(spark, sf):
    folder = R.messy_folder(spark, sf)
    known = sniff_dialect(scan_lines(spark, folder))
    report = admission_report(list_files(spark, folder), known)
    path = F.regexp_replace("file_path", "^file:/+", "file:/")
    sizes = known.select(path.alias("file_path"), F.expr(DATA_LINES).alias("n"))
    shown = mapping.default_fill(report, {"role": "none", "reason": "none"})
    return shown.join(sizes, "file_path", "left").groupBy("accepted", "role", "reason").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_lines"))


@cache
def messy_dataset(spark: SparkSession, sf: str) -> Dataset:
    return load_dataset(spark, R.messy_folder(spark, sf))


def ingested(table: str) -> Query:
    return lambda spark, sf: getattr(messy_dataset(spark, sf).frames, table)


def ingested_users(spark, sf):
    """Empty ages lead to no age group; both are shown with a stand-in."""
    users = messy_dataset(spark, sf).frames.users
    shown = mapping.default_fill(users, {"age": -1, "age_group": "?"})
    return shown.select("user_id", "gender", "age", "age_group", "occupation")


def line_outcomes(spark, sf):
    return messy_dataset(spark, sf).lines.groupBy("role").agg(
        *[F.sum(name).alias(name) for name in ("valid", "quarantined", "repeated_headers")]
    )


def ingest_quarantine(spark, sf):
    return messy_dataset(spark, sf).quarantine.groupBy("role", "reason").agg(
        F.count(F.lit(1)).alias("n")
    )


@cache
def headerless_dataset(spark: SparkSession, sf: str) -> Dataset:
    return load_dataset(spark, R.headerless_folder(spark, sf))


def headerless(table: str, *columns: str) -> Query:
    return lambda spark, sf: getattr(headerless_dataset(spark, sf).frames, table).select(
        *columns or ["*"])


def headerless_users(spark, sf):
    users = headerless_dataset(spark, sf).frames.users
    shown = mapping.default_fill(users, {"age": -1, "age_group": "?"})
    return shown.select("user_id", "gender", "age", "age_group", "occupation", "zipcode")


def headerless_admission(spark, sf):
    """Lines of files by role and by the canonical columns at their positions."""
    lines = scan_lines(spark, R.headerless_folder(spark, sf))
    sniffed = stage(sniff_dialect(lines), "dialects")
    dialects = stage(with_profiles(lines, sniffed, partial(scan_lines, spark)), "profiled")
    report = admission_report(list_files(spark, R.headerless_folder(spark, sf)), dialects)
    path = F.regexp_replace("file_path", "^file:/+", "file:/")
    names = dialects.schema["at"].dataType.names
    found = F.array(*[F.struct(F.col("at")[n].alias("at"), F.lit(n).alias("name")) for n in names])
    told = F.array_sort(F.filter(found, lambda c: c["at"].isNotNull()))
    shown = dialects.select(path.alias("file_path"), "n_lines", F.array_join(
        F.transform(told, lambda c: F.concat(c["name"], F.lit(":"), c["at"])), " ").alias("places"))
    return mapping.default_fill(report, {"role": "none", "reason": "none"}).join(
        shown, "file_path").groupBy("accepted", "role", "reason", "places").agg(
        F.sum("n_lines").alias("n_lines"))


def headerless_marts(spark, sf):
    """Folder of headerless files of any order -> all marts."""
    root = scratch_path(spark, "headerless-marts")
    analyze_dataset(spark, R.headerless_folder(spark, sf), root, 8, "headerless")
    return _written(spark, root, 8)


def raw_dat(kind: str) -> Query:
    return lambda spark, sf: tables.read_raw_dat(spark, f"{R.raw_dat_folder(spark, sf)}/{kind}", kind)


def scan_csv(spark, sf):
    return tables.read_table(spark, R.canonical_csv(spark, sf), "movies")


def scan_two_headers(spark, sf):
    return tables.read_table(spark, R.two_headers(spark, sf), "ratings")


def read_two_headers(spark, sf):
    both = tables.read_dialect(spark, [R.two_headers(spark, sf)], ",")
    return both.select("user_id", "movie_id", "rating", "time", "note")


def strip_mark(spark, sf):
    return tables.read_table(spark, R.marked_csv(spark, sf), "ratings")


def undecodable(spark, sf):
    movies = tables.read_raw_dat(spark, R.broken_titles(spark, sf), "movies")
    return movies.select("movie_id", "title", "genres_raw")


def gates(spark, sf):
    """Folders that are rejected as a whole, with the gate that does it and their lines."""
    found = []
    for name, path in R.unusable_folders(spark, sf).items():
        try:
            load_dataset(spark, path)
            reason = "accepted"
        except DatasetRejected as rejected:
            reason = str(rejected).partition(" in ")[0]
        # Headers stand in each file; how many files there are is left to Spark.
        lines = scan_lines(spark, path).where(~F.startswith("value", F.lit("movie_id,")) & ~F.startswith(
            "value", F.lit("user_id,")))
        found.append(lines.agg(F.count(F.lit(1)).alias("n_lines")).select(
            F.lit(name).alias("folder"), F.lit(reason).alias("reason"), "n_lines"))
    return reduce(DataFrame.unionAll, found)


def ingest_quality(spark, sf):
    """Outcomes as counted while the rows were written."""
    rows = [(role, reason, n) for role, counts in messy_dataset(spark, sf).quality.items()
            for reason, n in counts.items() if reason != HEADER]
    return spark.createDataFrame(rows, "role string, reason string, n long")


def scan_catalog(spark, sf):
    for name in ("movies", "ratings", "users"):
        getattr(B, name)(spark, sf).createOrReplaceTempView(f"bound_{name}")
    return tables.catalog_counts(spark, pattern="bound_*")


# ---- marts and serving -----------------------------------------------------------------------


def bound_frames(spark, sf) -> Frames:
    tables = [getattr(B, name)(spark, sf) for name in ("ratings", "movies", "users", "genres")]
    size_shuffles(*tables)
    return Frames(*tables)


@cache
def mart_root(spark: SparkSession, sf: str) -> str:
    """Marts of dataset 1, a registered dataset 2 without marts, a default and a deleted one."""
    root = scratch_path(spark, "marts")
    marts = analyze_all(bound_frames(spark, sf), stage=stage)
    M.write_marts(spark, marts, root, 1)
    M.register_dataset(spark, root, "orders and events")
    M.register_dataset(spark, root, "waiting")
    M.update_registry(spark, root, 1)
    summary = {"dashboard_summary": M.read_mart(spark, root, "dashboard_summary", 1)}
    for dataset_id, name in ((0, "default"), (3, "dropped")):
        M.write_marts(spark, summary, root, dataset_id)
        M.update_registry(spark, root, dataset_id, name)
    M.delete_dataset(spark, root, 3)
    return root


def served(name: str) -> Query:
    return lambda spark, sf: _plain(M.mart_view(spark, mart_root(spark, sf), name, 1))


def remaining_marts(spark, sf):
    root = mart_root(spark, sf)
    return _plain(M.read_all(spark, root, "dashboard_summary", M.MARTS["dashboard_summary"]))


def briefing(spark, sf):
    return M.dataset_briefing(spark, mart_root(spark, sf), 1).select("name", "content")


def _long(marts) -> DataFrame:
    """All marts in one long table: mart, label, ratings, average or share."""
    shape = {
        "rating_distribution": ("score", "count", "percentage"),
        "top_movies": ("movie_name", "rating_count", "avg_rating"),
        "genre_stats": ("genre_name", "rating_count", "avg_rating"),
        "active_users": ("user_id", "rating_count", "avg_rating"),
        "gender_comparison": ("gender", "rating_count", "avg_rating"),
        "age_group_stats": ("age_group", "rating_count", "avg_rating"),
        "occupation_stats": ("occupation", "rating_count", "avg_rating"),
        "dashboard_summary": ("total_users", "total_ratings", "avg_rating"),
    }
    long = [
        marts[name].select(
            F.lit(name).alias("mart"),
            F.col(label).cast("string").alias("label"),
            F.col(count).cast("bigint").alias("ratings"),
            F.col(value).cast("double").alias("value"),
        )
        for name, (label, count, value) in shape.items()
    ]
    return reduce(DataFrame.unionAll, long)


def analyze_everything(spark, sf):
    return _long(analyze_all(bound_frames(spark, sf), stage=stage))


def _written(spark, root: str, dataset_id: int) -> DataFrame:
    return _long({name: M.read_mart(spark, root, name, dataset_id) for name in M.MARTS})


def raw_marts(spark, sf):
    """Folder of headerless files -> all marts."""
    root = scratch_path(spark, "raw-marts")
    analyze_raw_dataset(spark, R.raw_dat_folder(spark, sf), root, 6, "raw", min_count=3)
    return _written(spark, root, 6)


def exported(spark, sf):
    path = scratch_path(spark, "export")
    top = A.top_movies(B.ratings(spark, sf), B.movies(spark, sf))
    M.export_delimited(top, path)
    return spark.read.schema(top.schema).csv(path)


@cache
def canonical_root(spark: SparkSession, sf: str) -> str:
    root = scratch_path(spark, "canonical")
    M.write_canonical(bound_frames(spark, sf), root, 7)
    return root


def insert_canonical(spark, sf):
    """Rows, sums of ids and lengths of texts of what was written."""
    frames = M.read_canonical(spark, canonical_root(spark, sf), 7)
    shape = {
        "movies": ("movie_id", F.length("title") + F.length("genres_raw")),
        "ratings": ("movie_id", F.col("ts") + (2 * F.col("rating")).cast("bigint")),
        "users": ("user_id", F.col("age") + F.length("gender") + F.length("occupation")),
        "movie_genres": ("movie_id", F.length("title") + F.length("genre")),
    }
    return reduce(DataFrame.unionAll, [
        getattr(frames, table).agg(
            F.count(F.lit(1)).alias("cnt"), F.sum(key).alias("ids"), F.sum(values).alias("total")
        ).select(F.lit(table).alias("tbl"), "cnt", "ids", "total")
        for table, (key, values) in shape.items()
    ])


def registry_fallback(spark, sf):
    """A dataset with canonical tables but no marts: its counts come from the ratings."""
    root = canonical_root(spark, sf)
    M.update_registry(spark, root, 7, "from ratings")
    return M.list_datasets(spark, root)


def upload(spark, sf):
    """Folder of files of any dialect -> all marts."""
    root = scratch_path(spark, "upload")
    analyze_dataset(spark, R.messy_folder(spark, sf), root, 5, "upload")
    return _written(spark, root, 5)


def appended(spark, sf):
    """A mart appended twice holds its rows twice."""
    root = scratch_path(spark, "append")
    scores = A.rating_distribution(B.ratings(spark, sf))
    for _ in range(2):
        M.append_mart(scores, root, "rating_distribution", 1)
    return _plain(M.read_mart(spark, root, "rating_distribution", 1))


def inserted(table: str, *columns: str) -> Query:
    return lambda spark, sf: getattr(M.read_canonical(
        spark, canonical_root(spark, sf), 7), table).select(*columns)


def positions(spark, sf):
    """Where each row of the ordered marts stands."""
    # A sorted mart in one partition keeps its order, so rows are numbered as they come.
    analyzed = analyze_all(bound_frames(spark, sf), stage=stage)
    labels = {"rating_distribution": "score", "top_movies": "movie_name", "genre_stats": "genre_name",
              "active_users": "user_id", "gender_comparison": "gender",
              "age_group_stats": "age_group", "occupation_stats": "occupation"}
    return reduce(DataFrame.unionAll, [
        analyzed[name].coalesce(1).select(
            F.lit(name).alias("mart"), F.col(label).cast("string").alias("label"),
            (F.monotonically_increasing_id() % (1 << 33) + 1).alias("position"))
        for name, label in labels.items()])


def without_users(spark, sf):
    """Rows of the marts that can be computed without profiles."""
    frames = bound_frames(spark, sf)
    marts = analyze_all(Frames(frames.ratings, frames.movies, None, frames.movie_genres), stage=stage)
    return reduce(DataFrame.unionAll, [mart.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("mart"), "n") for name, mart in marts.items()])


# Three standard errors of a sketch.
CLOSE = 3 * 1.04 / 2 ** (A.PRECISION / 2)


def _close(counts: DataFrame, exact: str, estimate: str) -> Column:
    return F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(F.lit(1.0), CLOSE * F.col(exact))


def approximate_distinct(spark, sf):
    """Movies per genre, counted exactly, and whether the sketch comes close."""
    frames = bound_frames(spark, sf)
    exact, rough = [A.genre_stats(frames.ratings, frames.movie_genres, distinct=how)
                    for how in ("exact", "approx")]
    both = exact.join(rough.select("genre_name", F.col("movie_count").alias("estimate")), "genre_name")
    return both.select("genre_name", "movie_count", _close(
        both, "movie_count", "estimate").alias("is_close"), "rating_count")


def united_sketches(spark, sf):
    """Users and movies of two datasets together, from their stored sketches alone."""
    root = scratch_path(spark, "sketches")
    ratings = B.ratings(spark, sf)
    for number, side in enumerate(("user_id >= 0", "user_id < 0"), start=1):
        M.write_sketches(Frames(ratings.where(side), B.movies(spark, sf)), root, number)
    exact = reduce(DataFrame.unionAll, [
        frame.agg(F.count_distinct(key).alias("n")).select(F.lit(name).alias("measure"), "n")
        for name, frame, key in (("raters", ratings, "user_id"), ("rated_movies", ratings, "movie_id"),
                                 ("movies", B.movies(spark, sf), "movie_id"))])
    both = M.united_counts(spark, root).join(exact, "measure")
    return both.select("measure", "n", _close(both, "n", "estimate").alias("is_close"))


def managed_tables(spark, sf):
    """Rows of the catalog's tables after two datasets were published and one withdrawn."""
    root, base = scratch_path(spark, "managed"), "starboard_published"
    frames = bound_frames(spark, sf)
    managed.drop_tables(spark, base)
    for number in (1, 2):
        M.write_canonical(frames, root, number)
        # The bound ratings are a join; the written ones are read.
        written = M.read_canonical(spark, root, number)
        M.write_marts(spark, analyze_all(written, stage=stage), root, number)
        managed.publish(spark, root, number, base, scratch_path(spark, "base"))
    managed.withdraw(spark, 2, base)
    counts = tables.catalog_counts(spark, base).where(F.startswith("tbl", F.lit(f"spark_catalog.{base}."))
                                                      | F.startswith("tbl", F.lit(f"{base}.")))
    return counts.select(F.substring_index("tbl", ".", -1).alias("tbl"), "cnt")


def json_scores(spark, sf):
    return P.json_rows(M.mart_view(spark, mart_root(spark, sf), "rating_distribution", 1))


def genre_slice(spark, sf):
    genres = A.genre_stats(B.ratings(spark, sf), B.genres(spark, sf))
    return P.top_n_slice(genres, [F.desc("movie_count"), "genre_name"], 10)


def occupation_slice(spark, sf):
    jobs = A.occupation_stats(B.ratings(spark, sf), B.users(spark, sf))
    return P.top_n_slice(jobs, [F.desc("rating_count"), "occupation"], 15)


def genre_shares(spark, sf):
    return P.share_of_slice(genre_slice(spark, sf), "movie_count")


def score_mean(spark, sf):
    return P.mean_line(A.rating_distribution(B.ratings(spark, sf)).select("score", "count"), "count")


# ---- streams ---------------------------------------------------------------------------------


def _stream(spark, sf, name):
    # A stream reads a folder, hence the pattern; a folder of that name works as well.
    schema = B.table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def stream_ingest(spark, sf):
    out = scratch_path(spark, "stream")
    lines = X.read_rating_lines(spark, R.damaged_folder(spark, sf))
    judged = X.parse_rating_lines(lines, ("user_id", "movie_id", "rating", "timestamp"))
    X.stream_ingest(judged, f"{out}/data", f"{out}/log").awaitTermination()
    good, bad = X.ingested(spark, f"{out}/data")
    return good.select(F.lit("ok").alias("reason"), "rating").unionAll(
        bad.select("reason", F.lit(-1.0).alias("rating"))
    ).groupBy("reason", "rating").agg(F.count(F.lit(1)).alias("n"))


def stream_distribution(spark, sf):
    out = scratch_path(spark, "stream")
    ratings = _stream(spark, sf, "lineitem").select(B.half_star(F.col("l_quantity")).alias("rating"))
    result = X.stream_distribution(ratings)
    X.write_result(result, f"{out}/data", f"{out}/log").awaitTermination()
    return X.read_result(spark, f"{out}/data")


def stream_distribution_updated(spark, sf):
    """The same by changed rows, over several batches."""
    out = scratch_path(spark, "stream")
    B.table(spark, sf, "lineitem").select(
        B.half_star(F.col("l_quantity")).alias("rating")).repartition(3).write.parquet(f"{out}/in")
    ratings = spark.readStream.schema("rating double").option("maxFilesPerTrigger", 1).parquet(
        f"{out}/in")
    X.write_result(X.stream_distribution(ratings), f"{out}/data", f"{out}/log", mode="update",
                   keys=["score"]).awaitTermination()
    return X.read_result(spark, f"{out}/data")


@cache
def streamed_uploads(spark: SparkSession, sf: str) -> str:
    """Files of several layouts, some rows coming in again later, as rows and unique ratings."""
    out = scratch_path(spark, "uploads")
    for late in (False, True):
        R.put_uploads(spark, sf, f"{out}/in", late)
        lines = U.read_upload_lines(spark, f"{out}/in", files_per_batch=4)
        U.ingest_uploads(lines, out, f"{out}/log").awaitTermination()
        U.write_unique(U.unique_ratings(spark, out), out, f"{out}/unique-log").awaitTermination()
    return out


def uploaded_ratings(spark, sf):
    return U.uploaded_ratings(spark, streamed_uploads(spark, sf))


def uploaded_movies(spark, sf):
    return U.uploaded_movies(spark, streamed_uploads(spark, sf))


def uploaded_outcomes(spark, sf):
    """Lines of the streamed files by what became of them, repeats counted each."""
    rows = U.upload_rows(spark, streamed_uploads(spark, sf))
    return rows.groupBy("role", "reason").agg(F.count(F.lit(1)).alias("n"))


def stream_activity(spark, sf):
    out = scratch_path(spark, "stream")
    # The clock shown is taken as UTC, so the days do not hang on the session time zone.
    clock = F.timestamp_seconds(B.epoch_seconds(F.col("ts")))
    events = _stream(spark, sf, "events").select(clock.alias("ts"))
    result = X.stream_activity(events)
    X.write_result(result, f"{out}/data", f"{out}/log", mode="update",
                   keys=["window_start"]).awaitTermination()
    last = X.read_result(spark, f"{out}/data")
    day = F.date_add(
        F.lit("1970-01-01").cast("date"), (F.unix_seconds("window_start") / 86400).cast("int")
    )
    return last.select(F.date_format(day, "yyyy-MM-dd").alias("day"), "count")


QUERIES: dict[str, Query] = {
    # analyses
    "Q1_rating_distribution": _r(A.rating_distribution, "ratings"),
    "Q1a_rating_distribution_rounded": _r(A.rating_distribution, "ratings", bucket="round"),
    "Q1b_pct_of_constant": _r(A.rating_distribution, "ratings", total=1000209),
    "Q2_top_movies": _r(A.top_movies, "ratings", "movies"),
    "Q2_top_movies_uploads": _r(A.top_movies, "ratings", "movies", min_count=3),
    "Q2_top_movies_by_id": _r(A.top_movies, "ratings", "movies", min_count=20, by="movie_id"),
    "Q2a_top_movies_unrounded": _r(A.top_movies, "ratings", "movies", order="exact"),
    "Q3_genre_stats": _r(A.genre_stats, "ratings", "genres"),
    "Q3_genre_stats_all_movies": _r(A.genre_stats, "ratings", "genres", movie_scope="all"),
    "Q4_active_users": _r(A.active_users, "ratings", "users"),
    "Q4a_active_users_no_profile": _r(A.active_users, "ratings"),
    "Q5_gender_comparison": _r(A.gender_comparison, "ratings", "users"),
    "Q5_gender_comparison_all_users": _r(
        A.gender_comparison, "ratings", "users", user_scope="all"),
    "Q5a_gender_rating_share": _r(A.gender_rating_share, "ratings", "users"),
    "Q6_age_group_stats": _r(A.age_group_stats, "ratings", "users"),
    "Q6_age_group_stats_all_users": _r(A.age_group_stats, "ratings", "users", user_scope="all"),
    "Q7_age_genre_top3": _r(A.age_genre_topk, "ratings", "users", "genres"),
    "Q8_occupation_stats": _r(A.occupation_stats, "ratings", "users"),
    "Q8_occupation_stats_all_users": _r(
        A.occupation_stats, "ratings", "users", k=None, user_scope="all"),
    "Q9_dashboard_summary": _r(A.dashboard_summary, "ratings", "movies", "users"),
    "Q9_dashboard_summary_raters": _r(
        A.dashboard_summary, "ratings", "movies", "users", users_from="ratings"),
    "Q9a_genre_count": _r(A.genre_count, "genres"),
    "Q10_upload_summary_fallback": _r(A.summary_from_ratings, "ratings"),
    "Q11_user_counts_gender": _r(A.group_user_counts, "users", key="gender"),
    "Q11_user_counts_age_group": _r(A.group_user_counts, "users", key="age_group"),
    "Q11_user_counts_occupation": _r(A.group_user_counts, "users", key="occupation"),
    "Q12_movie_counts_all": _r(A.movie_counts_all, "genres"),
    "Q14_analyze_all": analyze_everything,
    "demographic_rollup": lambda spark, sf: A.demographic_rollup(
        A.user_activity(B.ratings(spark, sf)), B.users(spark, sf)),
    # cleaning
    "T1_strip_title_year": strip_year,
    "T2_explode_genres": lambda spark, sf: C.explode_genres(B.movies(spark, sf)),
    "T3_strict_rating_filter": strict_filter,
    "T4_lenient_rating_filter": lenient_filter,
    "T5_quality_counts": lambda spark, sf: C.quality_counts(dirty_ratings(spark, sf)),
    "T5_quarantine_reasons": quarantine_reasons,
    "T6_decode_gender": decode_gender,
    "T7_age_bucket": age_buckets,
    "T8_decode_occupation": decode_occupation,
    "T9_distinct_rows": distinct_rows,
    "T10_require_keys": require_keys,
    "T11_trim_fields": trim_fields,
    "T12_table_counts": load_check,
    "T13_gender_tally": _r(C.gender_tally, "users"),
    # mapping
    "C2_map_aliases": map_aliases,
    "C4_merge_role_files": merge_role_frames,
    "C5_typed_cast": canonical_ratings,
    "C6_default_fill": default_fill,
    "C7_title_full_fallback": canonical_movies,
    # sources and admission
    "S1_scan_csv": scan_csv,
    "S1_scan_two_headers": scan_two_headers,
    "S2_read_dialect": read_two_headers,
    "S3_scan_coloncolon_ratings": raw_dat("ratings"),
    "S3_scan_coloncolon_movies": raw_dat("movies"),
    "S3_scan_coloncolon_users": raw_dat("users"),
    "S6_sniff_dialect": dialects,
    "S3_undecodable_titles": undecodable,
    "S7_strip_bom": strip_mark,
    "S9_scan_catalog": scan_catalog,
    "V9_V10_gates": gates,
    "M5_managed_tables": managed_tables,
    "T5_ingest_quality": ingest_quality,
    "Q13_marts_without_users": without_users,
    "G12_G13_positions": positions,
    "G7_approximate_distinct": approximate_distinct,
    "G7_united_sketches": united_sketches,
    "K1_append": appended,
    "K5_inserted_ratings": inserted("ratings", "user_id", "movie_id", "rating", "ts"),
    "K5_inserted_movies": inserted("movies", "movie_id", "title", "title_full", "genres_raw"),
    "K5_inserted_users": inserted("users", "user_id", "gender", "age", "age_group", "occupation"),
    "K5_inserted_genres": inserted("movie_genres", "movie_id", "title", "genre"),
    "V1_V3_admission_report": admission,
    "V6_V8_line_outcomes": line_outcomes,
    "V8_ingest_quarantine": ingest_quarantine,
    "S2_ingested_ratings": ingested("ratings"),
    "V5_headerless_admission": headerless_admission,
    "V5_headerless_ratings": headerless("ratings"),
    "V5_headerless_movies": headerless("movies"),
    "V5_headerless_users": headerless_users,
    "V5_headerless_marts": headerless_marts,
    "C3_ingested_movies": ingested("movies"),
    "C3_ingested_users": ingested_users,
    # marts and serving
    "K2_uploaded_marts": upload,
    "K3_export_delimited": exported,
    "K5_insert_canonical": insert_canonical,
    "E4_marts_from_raw_files": raw_marts,
    "K6_update_registry_fallback": registry_fallback,
    "K8_json_rows": json_scores,
    **{f"P1_view_{name}": served(name) for name in M.MARTS},
    "P2_list_datasets": lambda spark, sf: M.list_datasets(spark, mart_root(spark, sf)),
    "P3_dataset_status": lambda spark, sf: M.dataset_status(spark, mart_root(spark, sf)),
    "P4_dataset_badge": lambda spark, sf: M.dataset_badge(
        M.read_registry(spark, mart_root(spark, sf))),
    "P5_delete_dataset": remaining_marts,
    "P6_dataset_briefing": briefing,
    "P7_top_genres_slice": genre_slice,
    "P7_top_occupations_slice": occupation_slice,
    "P8_share_of_slice": genre_shares,
    "P9_mean_line": score_mean,
    # streams
    "X1_stream_ingest": stream_ingest,
    "X1_stream_uploads": uploaded_ratings,
    "X1_stream_upload_movies": uploaded_movies,
    "X1_stream_upload_outcomes": uploaded_outcomes,
    "X2_stream_distribution": stream_distribution,
    "X2_stream_distribution_updated": stream_distribution_updated,
    "X3_stream_daily_activity": stream_activity,
}
