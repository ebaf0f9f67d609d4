"""Results as tables of the catalog."""

import pytest

from starboard.plans import managed as C
from starboard.plans import marts as M
from starboard.plans.dataset import analyze_dataset
from starboard.sources.tables import catalog_counts

BASE = "shared"


@pytest.fixture
def root(spark, folder, tmp_path):
    """Dataset 1 with ratings and movies, dataset 2 with ratings."""
    root = str(tmp_path / "marts")
    head = "user_id,movie_id,rating\n"
    path = folder(r_csv=head + "".join(f"{u},{u % 3},4\n" for u in range(9)),
                  m_csv="movie_id,title,genres\n" + "".join(f"{m},F{m},War\n" for m in range(3)))
    analyze_dataset(spark, path, root, 1, "one")
    (tmp_path / "files" / "m.csv").unlink()
    analyze_dataset(spark, path, root, 2, "two")
    C.create_tables(spark, BASE, str(tmp_path / "base"))
    yield root
    C.drop_tables(spark, BASE)


def counts(spark, pattern="*"):
    return {r["tbl"].rsplit(".", 1)[1]: r["cnt"] for r in catalog_counts(spark, BASE, pattern).collect()
            if "." in r["tbl"]}


def test_published_tables_are_listed_read_and_withdrawn(spark, root, rows):
    C.publish(spark, root, 1, BASE)
    C.publish(spark, root, 2, BASE)
    found = counts(spark)
    assert found["canonical_ratings"] == 18 and found["canonical_movies"] == 3
    assert found["genre_stats"] == 1 and found["dashboard_summary"] == 2
    assert found["canonical_users"] == 0 and found["gender_comparison"] == 0
    assert set(counts(spark, "canonical_*")) == {
        "canonical_ratings", "canonical_movies", "canonical_users", "canonical_movie_genres"}
    for name in ("top_movies", "rating_distribution"):
        assert rows(C.published(spark, BASE, name, 1)) == rows(M.read_mart(spark, root, name, 1))
    assert rows(C.published(spark, BASE, "canonical_ratings", 2)) == rows(
        M.read_canonical(spark, root, 2).ratings)
    files = C.published(spark, BASE, "canonical_ratings", 2).inputFiles()
    plan = C.published(spark, BASE, "canonical_ratings", 2)._jdf.queryExecution().toString()
    assert files and "PartitionFilters: [isnotnull(dataset_id" in plan

    C.withdraw(spark, 2, BASE)
    found = counts(spark)
    assert found["canonical_ratings"] == 9 and found["dashboard_summary"] == 1
    with pytest.raises(ValueError):
        C.withdraw(spark, 0, BASE)


def test_publishing_again_replaces_one_dataset_only(spark, root, rows, tmp_path):
    C.publish(spark, root, 1, BASE)
    C.publish(spark, root, 2, BASE)
    (tmp_path / "files" / "r.csv").write_text("user_id,movie_id,rating\n1,1,2\n")
    analyze_dataset(spark, str(tmp_path / "files"), root, 1)
    C.publish(spark, root, 1, BASE)
    assert rows(C.published(spark, BASE, "canonical_ratings", 1)) == [(1, 1, 2.0, 0)]
    # The movies are gone with their file.
    assert C.published(spark, BASE, "canonical_movies", 1).isEmpty()
    assert C.published(spark, BASE, "canonical_ratings", 2).count() == 9


@pytest.mark.parametrize("bad", ["a b", "x; drop table y", "", "a.b"])
def test_databases_have_plain_names(spark, bad):
    with pytest.raises(ValueError):
        C.create_tables(spark, bad)
