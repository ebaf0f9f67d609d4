"""Files of every dialect and every kind of damage."""

import pytest

from starboard.plans.dataset import DatasetRejected, load_dataset
from starboard.sources import profiles, sizes
from starboard.sources.dialects import admission_report, sniff_dialect
from starboard.sources.lines import list_files, scan_lines
from starboard.sources.profiles import with_profiles
from starboard.sources.parsing import line_counts, parse_lines, parse_rows, quarantine_of, usable

RATINGS = "user_id,movie_id,rating\n1,10,4\n2,11,5\n"


def parse(spark, path, lo=0, hi=10):
    lines = scan_lines(spark, path)
    dialects = sniff_dialect(lines)
    return parse_rows(lines, dialects, lo, hi), dialects


def outcome(spark, path, lo=0, hi=10):
    rows, _ = parse(spark, path, lo, hi)
    reasons = [row["reason"] for row in quarantine_of(rows).collect()]
    return usable(rows, "ratings").count(), sorted(reasons)


def reports(spark, path):
    report = admission_report(list_files(spark, path), sniff_dialect(scan_lines(spark, path)))
    return {row["file_path"].rsplit("/", 1)[1]: (row["accepted"], row["role"], row["reason"])
            for row in report.collect()}


def test_dialects(spark, folder):
    path = folder(
        a_csv=RATINGS,
        b_tsv="userId\tmovie\tscore\ttime\n1\t2\t3\t4\n",
        c_dat="UserID::MovieID::Rating::Timestamp\n1::2::3::4\n",
        d_csv='"Movie_ID","Title",`Category`,year\n1,x,y,1999\n',
        e_csv="1,2 movies,3\n",
    )
    found = {row["file_path"].rsplit("/", 1)[1]: row
             for row in sniff_dialect(scan_lines(spark, path)).collect()}
    assert {k: (r["sep"], r["has_header"], r["role"]) for k, r in found.items()} == {
        "a.csv": (",", True, "ratings"), "b.tsv": ("\t", True, "ratings"),
        "c.dat": ("::", True, "ratings"), "d.csv": (",", True, "movies"),
        "e.csv": (",", False, None)}
    assert found["b.tsv"]["fields"] == ["userid", "movie", "score", "time"]
    assert found["d.csv"]["fields"] == ["movie_id", "title", "category", "year"]
    assert found["d.csv"]["extra_names"] == ["year"]
    assert found["e.csv"]["fields"] == ["_c0", "_c1", "_c2"]


def test_first_line_decides_across_splits(spark, folder):
    path = folder(a_csv=RATINGS + "".join(f"{i},{i},5\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = scan_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 5
        head = sniff_dialect(lines).first()
        assert (head["head"], head["n_lines"]) == ("user_id,movie_id,rating", 3003)
        assert outcome(spark, path) == (3002, [])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_blank_lines_before_the_header(spark, folder):
    path = folder(a_csv=" \n\t\n" + RATINGS)
    assert outcome(spark, path) == (2, [])


def test_admission(spark, folder):
    path = folder(
        empty_csv="",
        blank_csv="\n \n",
        prose_txt="This is not a table.\nIt has no delimiter\n",
        unknown_csv="a,b\n1,2\n",
        norating_csv="user_id,movie_id,timestamp\n1,1,908356760\n",
        bom_csv="﻿用户ID,电影ID,评分\r\r\n1,10,4\r\r\n",
        good_csv=RATINGS,
        **{"two words_csv": RATINGS},
        ignored_json='{"user_id": 1, "movie_id": 2}',
    )
    assert reports(spark, path) == {
        "empty.csv": (False, None, "empty_file"),
        "blank.csv": (False, None, "empty_file"),
        "prose.txt": (False, None, "no_delimiter"),
        "unknown.csv": (False, None, "no_known_column"),
        "norating.csv": (False, None, "no_role"),
        "bom.csv": (False, None, "no_role"),
        "good.csv": (True, "ratings", None),
        "two%20words.csv": (True, "ratings", None),
    }


def test_bom_is_dropped(spark, folder):
    path = folder(a_csv="﻿" + RATINGS)
    assert outcome(spark, path) == (2, [])


def test_blank_lines_and_missing_values(spark, folder):
    path = folder(a_csv="user_id,movie_id,rating\n\n\n1,10,4\n\n2,,5\n\n3,12,\n\n")
    assert outcome(spark, path) == (1, ["invalid_rating", "missing_key"])


def test_repeated_headers(spark, folder):
    header = "user_id,movie_id,rating\n"
    path = folder(a_csv=f"{header}1,10,4\n{header}2,11,5\n USER_ID , movie_id,rating\n3,12,3\n")
    rows, dialects = parse(spark, path)
    counts = line_counts(rows, dialects).first()
    assert (counts["valid"], counts["quarantined"], counts["repeated_headers"]) == (3, 0, 2)


def test_invalid_ratings(spark, folder):
    values = ["five", "", "-1", "6", "0", "3.5", "N/A", "4", "5", "???", "2", "", "3", "100", "good"]
    lines = "".join(f"{i},{i},{value}\n" for i, value in enumerate(values, 1))
    path = folder(a_csv="user_id,movie_id,rating\n" + lines)
    assert outcome(spark, path)[0] == 7
    assert outcome(spark, path, 1, 5)[0] == 5
    reasons = outcome(spark, path)[1]
    assert len(reasons) == 8 and reasons.count("rating_out_of_range") == 2


def test_ragged_rows(spark, folder):
    path = folder(a_csv="user_id,movie_id,rating\n1,10,4\n2,11\n3,12,5,999,extra\n4,13,3\n5\n6,14,4\n")
    assert outcome(spark, path) == (4, ["invalid_rating", "too_few_fields"])


def test_mixed_delimiters(spark, folder):
    path = folder(a_csv="user_id,movie_id,rating,timestamp\n1,10,4,9\n2\t11\t5\t8\n3,12,3,7\n4\t13\t2\t6\n5,14,5,5\n")
    assert outcome(spark, path) == (3, ["too_few_fields", "too_few_fields"])
    seen = sniff_dialect(scan_lines(spark, path)).first()["delimiters_seen"]
    assert seen == ["\t", ","]


def test_empty_first_field_of_a_tab_line_does_not_shift(spark, folder):
    path = folder(a_tsv="user_id\tmovie_id\trating\n\t10\t4\n2\t11\t5\n")
    assert outcome(spark, path) == (1, ["missing_key"])


def test_quarantine_keeps_the_line(spark, folder):
    path = folder(a_csv="user_id,movie_id,rating\n  1,10,five  \n")
    rows, _ = parse(spark, path)
    assert quarantine_of(rows).first()["value"] == "  1,10,five  "


def test_roles_aliases_quotes_and_unknown_columns(spark, folder, rows):
    path = folder(
        r_csv="user,movie,score,time\n1,10,4,99\n1,10,4,99\n2,10,3.5,98\n",
        s_tsv="movieId\tuserId\trate\trating\n10\t3\t9\t5\n",
        m_csv='movie_id,title,genres,year\n10,"Good, the Bad (1966)",Western| War,1966\n'
              '11,"She said ""hi""",,\n',
        u_csv="user_id,gender,age,occupation,zip_code\n1,M,17,writer,x\n2,F,,artist,y\n",
    )
    data = load_dataset(spark, path).frames
    assert rows(data.ratings) == [(1, 10, 4.0, 99), (2, 10, 3.5, 98), (3, 10, 5.0, 0)]
    assert rows(data.movies) == [
        (10, "Good, the Bad (1966)", "Good, the Bad (1966)", "Western| War"),
        (11, 'She said "hi"', 'She said "hi"', "")]
    assert rows(data.movie_genres, "genre") == [("War",), ("Western",)]
    assert rows(data.users, "user_id", "gender", "age", "age_group", "occupation") == [
        (1, "M", 17, "Under18", "writer"), (2, "F", None, None, "artist")]
    parsed, _ = parse(spark, path)
    assert rows(usable(parsed, "movies"), "extra") == [({"year": "1966"},), ({"year": None},)]


def test_double_colon_files_know_no_quotes(spark, folder, rows):
    path = folder(m_dat='MovieID::Title::Genres\n1::"Great" Cats (1998)::Musical\n', r_csv=RATINGS)
    tables, _ = parse_lines(scan_lines(spark, path), sniff_dialect(scan_lines(spark, path)))
    assert rows(tables["movies"], "title") == [('"Great" Cats (1998)',)]


def test_repeated_column_names(spark, folder, rows):
    path = folder(a_csv="user_id,movie_id,rating,note,note,,\n1,2,3,a,b,c,d\n")
    parsed, _ = parse(spark, path)
    assert rows(usable(parsed, "ratings"), "extra") == [({"note": "a", "": "c"},)]


def test_rows_add_up(spark, folder):
    path = folder(a_csv="user_id,movie_id,rating\n1,1,1\n\n2,2,x\n3\nuser_id,movie_id,rating\n4,4,4\n")
    rows, dialects = parse(spark, path)
    counts = line_counts(rows, dialects).first()
    lines = dialects.first()["n_lines"]
    assert counts["valid"] + counts["quarantined"] + counts["repeated_headers"] + 1 == lines


@pytest.mark.parametrize("files", [
    {"a_csv": "user_id,movie_id,rating\n"},
    {"a_csv": "user_id,movie_id,rating\n1,2,x\n"},
    {"a_csv": "movie_id,title\n1,x\n"},
    {"a_txt": "prose\n"},
    {"a_csv": ""},
])
def test_datasets_without_ratings_are_rejected(spark, folder, files):
    with pytest.raises(DatasetRejected):
        load_dataset(spark, folder(**files))


def test_rows_with_header_words_are_rows(spark, folder, rows):
    where = folder(movies_csv="movie_id,title,genres\n1,\"Lights, Camera, Movie\",Drama\n"
                              "2,Score,Drama\nMovie_ID,Title,Genres\n3,Heat,title\n")
    dataset, _ = parse(spark, where)
    assert rows(dataset.where("reason = 'ok'"), "movie_id", "title") == [
        (1, "Lights, Camera, Movie"), (2, "Score"), (3, "Heat")]
    assert dataset.where("reason = 'header'").count() == 2


def told(spark, path):
    """File name -> role and the column at each position, or the reason for its rejection."""
    lines = scan_lines(spark, path)
    dialects = with_profiles(lines, sniff_dialect(lines))
    reasons = {r["file_path"].rsplit("/", 1)[1]: r["reason"] for r in admission_report(
        list_files(spark, path), dialects).collect()}
    found = {}
    for row in dialects.collect():
        name, at = row["file_path"].rsplit("/", 1)[1], row["at"].asDict()
        placed = {p: c for c, p in at.items() if p is not None}
        found[name] = reasons[name] or (row["role"], *[placed[p] for p in sorted(placed)])
    return found


def lines_of(n, sep, *columns):
    return "".join(sep.join(str(c(i)) for c in columns) + "\n" for i in range(n))


def test_headerless_columns_are_told_by_their_values(spark, folder):
    def user(i):
        return 40 + i * 7

    def movie(i):
        return 1000 + i % 13

    def score(i):
        return (i % 10 + 1) / 2

    def time(i):
        return 978_300_000 + i

    path = folder(
        one_csv="1,2,4.0\n",
        a_csv=lines_of(30, ",", user, movie, score, time),
        b_tsv=lines_of(30, "\t", time, score, user, movie),
        c_dat=lines_of(30, "::", user, movie, score),
        d_csv=lines_of(20, ",", movie, lambda i: f'"Film, the {i}th"', lambda i: "Drama|War"),
        e_tsv=lines_of(20, "\t", lambda i: "Comedy|War", movie, lambda i: f"Film {i}"),
        f_csv=lines_of(20, ",", movie, lambda i: f"Film {i}", lambda i: "Drama"),
        g_dat=lines_of(40, "::", user, lambda i: "MF"[i % 2], lambda i: 15 + i, lambda i: i % 5,
                       lambda i: "48067"),
        h_csv=lines_of(40, ",", lambda i: "fm"[i % 2], user, lambda i: 15 + i % 30),
        # Two columns of scores and none of them where scores are.
        i_csv=lines_of(30, ",", user, score, movie, score),
        # Three keys beside a score, none at the customary places.
        j_csv=lines_of(30, ",", score, user, movie, user),
        k_csv=lines_of(30, ",", lambda i: "x", lambda i: "y"),
        l_csv=lines_of(30, ",", lambda i: f"a {i}", lambda i: f"b {i}", movie),
    )
    assert told(spark, path) == {
        "one.csv": ("ratings", "user_id", "movie_id", "rating"),
        "a.csv": ("ratings", "user_id", "movie_id", "rating", "time"),
        "b.tsv": ("ratings", "time", "rating", "user_id", "movie_id"),
        "c.dat": ("ratings", "user_id", "movie_id", "rating"),
        "d.csv": ("movies", "movie_id", "title", "genres"),
        "e.tsv": ("movies", "genres", "movie_id", "title"),
        "f.csv": ("movies", "movie_id", "title", "genres"),
        "g.dat": ("users", "user_id", "gender", "age", "occupation", "zipcode"),
        "h.csv": ("users", "gender", "user_id", "age"),
        "i.csv": "ambiguous_columns",
        "j.csv": "ambiguous_columns",
        "k.csv": "no_known_column",
        "l.csv": ("movies", "title", "movie_id"),
    }


def test_headerless_files_become_canonical_tables(spark, folder, rows):
    path = folder(
        r_csv="1,20,4.5,978300760\n2,21,five,978300761\n\n3,20\n2,20,3,978300762,9\n",
        s_csv="movie,userId,score\n21,7,2\n",
        m_tsv='20\tFilm (1990)\tDrama|War\n21\tOther\tWar\n',
        u_dat="1::F::30::writer::1\n2::M::41::artist::2\n",
    )
    dataset = load_dataset(spark, path)
    assert rows(dataset.frames.ratings) == [
        (1, 20, 4.5, 978300760), (2, 20, 3.0, 978300762), (7, 21, 2.0, 0)]
    assert rows(dataset.frames.movies, "movie_id", "title") == [(20, "Film (1990)"), (21, "Other")]
    assert rows(dataset.frames.users, "user_id", "gender", "age", "occupation") == [
        (1, "F", 30, "writer"), (2, "M", 41, "artist")]
    assert rows(dataset.frames.movie_genres, "movie_id", "genre") == [
        (20, "Drama"), (20, "War"), (21, "War")]
    assert rows(dataset.quarantine, "value", "reason") == [
        ("2,21,five,978300761", "invalid_rating"), ("3,20", "invalid_rating")]
    assert {r["repeated_headers"] for r in dataset.lines.collect()} == {0}


def test_joins_of_profiles_and_broadcasts_of_them_agree(spark, folder, monkeypatch):
    path = folder(a_csv="1,20,4.5\n", b_tsv="1\tM\t33\n", c_csv="7,Film,War\n")
    broadcast = told(spark, path)
    monkeypatch.setattr(sizes, "BROADCAST_BYTES", 0)
    assert told(spark, path) == broadcast


@pytest.mark.parametrize("most", [0, 1000])
def test_only_headerless_files_are_read_again(spark, tmp_path, most, monkeypatch):
    path = tmp_path / "names"
    path.mkdir()
    for name in ("plain", "two words", "a[b]c", "x{y,z}", "50%20 é"):
        (path / f"{name}.csv").write_text("1,20,4.5\n2,21,3.0\n")
    (path / "headed.csv").write_text(RATINGS)
    monkeypatch.setattr(profiles, "MOST_PATHS", most)
    lines, asked = scan_lines(spark, str(path)), []

    def reread(paths):
        asked.extend(scan_lines(spark, paths).select("file_path").distinct().collect())
        return scan_lines(spark, paths)

    dialects = with_profiles(lines, sniff_dialect(lines), reread)
    assert {r["role"] for r in dialects.collect()} == {"ratings"} and dialects.count() == 6
    assert len(asked) == (5 if most else 0)
    assert load_dataset(spark, str(path)).frames.ratings.count() == 4
