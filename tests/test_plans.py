"""What the plans must and must not contain, and behaviour under skew."""

import pytest
from pyspark.sql import functions as F

from starboard import session
from starboard.operators import analyses as A
from starboard.sources import tables as tables_of
from starboard.sources.dialects import admission_report, sniff_dialect
from starboard.sources.lines import list_files, scan_lines
from starboard.sources.parsing import measure, parse_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    """Half of all ratings by one user, half of one movie, on disk and too large to broadcast."""
    n = 40000
    ratings = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 3000).cast("int").alias("user_id"),
        F.when(F.col("id") % 4 < 2, 3).otherwise(F.col("id") % 500).cast("int").alias("movie_id"),
        (F.col("id") % 10 / 2 + 0.5).alias("rating"), F.col("id").alias("ts"))
    users = spark.range(3000).select(
        F.col("id").cast("int").alias("user_id"), F.lit("Male").alias("gender"),
        (F.col("id") % 70).cast("int").alias("age"), F.lit("writer").alias("occupation"))
    genres = spark.range(500).select(
        F.col("id").cast("int").alias("movie_id"), F.lit("t").alias("title"),
        F.concat(F.lit("g"), F.col("id") % 9).alias("genre"))
    found = {}
    for name, frame in (("ratings", ratings), ("users", users), ("genres", genres)):
        frame.repartition(6).write.parquet(str(tmp_path / name))
        found[name] = spark.read.parquet(str(tmp_path / name))
    return found


def test_scans_read_only_the_needed_columns(tables):
    text = plan(A.rating_distribution(tables["ratings"]))
    assert "ReadSchema: struct<rating:double>" in text and "user_id" not in text


def test_users_join_meets_folded_ratings(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(A.gender_comparison(tables["ratings"], tables["users"]))
        assert text.index("SortMergeJoin") < text.index("partial_sum(rating#")
        assert "CartesianProduct" not in text and "NestedLoop" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_k_without_full_sort(tables):
    text = plan(A.active_users(tables["ratings"], tables["users"]))
    assert "TakeOrderedAndProject" in text


def test_rank_limit_before_the_shuffle(tables):
    text = plan(A.age_genre_topk(tables["ratings"], tables["users"], tables["genres"]))
    assert "WindowGroupLimit" in text


def test_total_reuses_the_counts(spark, tables):
    distribution = A.rating_distribution(tables["ratings"])
    distribution.collect()
    assert "ReusedExchange" in plan(distribution)


def test_hot_user_is_split(spark, tables):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    call = lambda: A.age_genre_topk(tables["ratings"], tables["users"], tables["genres"])
    expected = [tuple(row) for row in call().collect()]
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        split = call()
        assert [tuple(row) for row in split.collect()] == expected
        assert "skew=true" in plan(split)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_sniffing_hashes_and_parsing_broadcasts(spark, folder):
    path = folder(a_csv="user_id,movie_id,rating\n1,2,3\n")
    lines = scan_lines(spark, path)
    dialects = sniff_dialect(lines)
    assert "ObjectHashAggregate" in plan(dialects) and "SortAggregate" not in plan(dialects)
    assert "BroadcastHashJoin" in plan(parse_rows(lines, dialects))


@pytest.mark.parametrize("columns", [["file_path", "head"], ["has_header", "n_lines"], ["role"]])
def test_sniffing_hashes_whatever_columns_are_read(spark, folder, columns):
    path = folder(a_csv="\nuser_id,movie_id,rating\n1,2,3\n", b_csv="x,y\n")
    dialects = sniff_dialect(scan_lines(spark, path))
    assert "SortAggregate" not in plan(dialects.select(*columns))
    assert "SortAggregate" not in plan(admission_report(list_files(spark, path), dialects))


def test_headers_of_known_layouts_are_found_by_hashing(spark, folder, monkeypatch):
    path, staged = folder(a_csv="\n\"rating\",user_id,movie_id\n4,1,2\n"), []
    monkeypatch.setattr(
        tables_of, "stage", lambda df, label: staged.append(plan(df)) or session.stage(df, label))
    found = tables_of.read_table(spark, path, "ratings").collect()
    assert [(row["user_id"], row["movie_id"], row["rating"]) for row in found] == [(1, 2, 4.0)]
    assert len(staged) == 1 and "SortAggregate" not in staged[0]


def test_parsing_without_broadcast_gives_the_same(spark, folder, rows, monkeypatch):
    path = folder(a_csv="user_id,movie_id,rating\n1,2,3\n", b_tsv="movie_id\ttitle\n1\tx\n")
    lines = scan_lines(spark, path)
    dialects = sniff_dialect(lines)
    broadcast = rows(parse_rows(lines, dialects).drop("extra"))
    monkeypatch.setattr("starboard.sources.parsing.BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = parse_rows(lines, dialects, size=measure(dialects)).drop("extra")
        assert "SortMergeJoin" in plan(joined)
        assert rows(joined) == broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hashes_of_many_files_are_broadcast_instead_of_their_dialects(
        spark, folder, rows, monkeypatch):
    path = folder(**{f"f{i}_csv": f"user_id,movie_id,rating\n{i},2,3\n" for i in range(12)},
                  b_tsv='movie_id\ttitle\tshelf\n1\t"x\ty"\t3\n', c_csv="rating,user,movie\n1,2,3\n")
    lines = scan_lines(spark, path)
    dialects = sniff_dialect(lines)
    whole = rows(parse_rows(lines, dialects).drop("extra"))
    monkeypatch.setattr("starboard.sources.parsing.BROADCAST_BYTES", 4000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        size = measure(dialects)
        assert size.bytes > 4000
        keyed = parse_rows(lines, dialects, size=size).drop("extra")
        assert "SortMergeJoin" not in plan(keyed) and "file_key" in plan(keyed)
        assert rows(keyed) == whole and len(whole) == 28
        monkeypatch.setattr(F, "xxhash64", lambda *_: F.lit(7).cast("bigint"))
        joined = parse_rows(lines, dialects, size=size).drop("extra")
        assert "SortMergeJoin" in plan(joined) and rows(joined) == whole
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ratings_are_read_once_for_their_share(spark, tables, tmp_path):
    for name in ("ratings", "users"):
        tables[name].write.parquet(str(tmp_path / f"{name}-once"))
    ratings, users = [spark.read.parquet(str(tmp_path / f"{name}-once")) for name in ("ratings", "users")]
    for scope in ("rated", "all"):
        assert plan(A.gender_rating_share(ratings, users, scope)).count("FileScan") == 2


def test_shuffles_are_sized_for_the_jobs_inside_only(spark, tables):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.sized_shuffles(tables["ratings"], bytes_per_partition=10) as inside:
        assert inside > int(before)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(inside)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_tables_are_broadcast_by_the_size_of_their_rows(spark, tables):
    before = spark.conf.get(session.SIZE_KEY)
    size = lambda: int(str(spark.read.parquet(*tables["users"].inputFiles())
                           ._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    plain = size()
    with session.sized_shuffles(tables["users"]):
        assert size() >= session.ROWS_PER_FILE_BYTE * plain - 8
    assert spark.conf.get(session.SIZE_KEY) == before and size() == plain


def test_profiles_join_and_group_on_one_shuffle_per_side(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(A.active_users(tables["ratings"], tables["users"]))
        assert text.count("Exchange hashpartitioning(user_id") == text.count("Exchange ") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shuffle_partitions_follow_the_input(spark, tables):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        joined = tables["ratings"].join(tables["users"], "user_id")
        assert session.size_shuffles(joined) == int(before)
        raised = session.size_shuffles(joined, bytes_per_partition=10_000)
        assert raised > int(before)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(raised)
        # However large the input is, a partition keeps its size.
        assert session.size_shuffles(joined, bytes_per_partition=10) > 900 * raised
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        master, applicationId = "yarn", "a"

    class Conf:
        @staticmethod
        def get(key, default):
            return default

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(RuntimeError):
        session.scratch_root(Session)


def test_batches_to_python_are_bounded_while_a_table_is_written(spark):
    seen = []
    key = session.BATCH_KEY
    with session.bounded_batches(spark):
        with session.bounded_batches(spark):
            seen.append(spark.conf.get(key))
        seen.append(spark.conf.get(key))
    assert seen == [str(session.BATCH_BYTES)] * 2 and spark.conf.get(key, None) is None
    spark.conf.set(key, "1000000")
    with session.bounded_batches(spark):
        seen.append(spark.conf.get(key))
    assert seen[-1] == spark.conf.get(key) == "1000000"
    spark.conf.unset(key)


def test_staged_tables_go_when_a_job_is_done(spark, tmp_path):
    other = spark.newSession()
    kept = session.stage(spark.range(3), "kept")
    gone = [session.stage(other.range(n), "gone") for n in (1, 2)]
    paths = [frame.inputFiles()[0] for frame in gone]
    assert session.release_staged(other) == 2 and session.release_staged(other) == 0
    for path in paths:
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            other.read.parquet(path)
    assert kept.count() == 3
