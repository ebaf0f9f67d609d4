"""The queries as SQL for DuckDB, over the same whole tables."""

from __future__ import annotations

from checks.bindings import SQL, age_case, with_tables


def half_up(x: str, digits: int) -> str:
    """Rounding half up, as Spark rounds; the detour by a decimal evens out binary noise."""
    return f"cast(round(cast({x} as decimal(38,12)), {digits}) as double)"


def pct(part: str, whole: str) -> str:
    return half_up(f"cast({part} as double) * 100.0 / {whole}", 2)


AVG2 = half_up("avg(r.rating)", 2)
AVG3 = half_up("avg(r.rating)", 3)


def distribution(bucket: str = "trunc(rating)", total: str = "sum(count(*)) over ()") -> str:
    return with_tables("ratings", sql=f"""
select cast({bucket} as integer) as score, count(*) as count,
       {pct("count(*)", total)} as percentage
from ratings group by 1""")


def top_movies(minimum: int, order: str = "avg_rating", key: str = "m.title") -> str:
    shown = "r.movie_id, " if key != "m.title" else ""
    tie = ", r.movie_id" if shown else ""
    return with_tables("ratings", "movies", sql=f"""
select {shown}m.title as movie_name, {AVG2} as avg_rating, count(*) as rating_count
from movies m join ratings r using (movie_id)
group by {key} having count(*) >= {minimum}
order by {order} desc, rating_count desc, movie_name{tie} limit 20""")


def genre_stats(extra: str = "") -> str:
    return f"""
select g.genre as genre_name, count(distinct g.movie_id) as movie_count,
       {AVG2} as avg_rating, count(r.rating) as rating_count
from ratings r join genres g using (movie_id) group by g.genre{extra}"""


GENRE_STATS_ALL = f"""
select s.genre_name, a.movie_count, s.avg_rating, s.rating_count
from ({genre_stats()}) s
join (select genre, count(distinct movie_id) as movie_count from genres group by genre) a
  on s.genre_name = a.genre"""

ACTIVE_USERS = f"""
select r.user_id, u.gender, u.age, u.occupation, count(*) as rating_count, {AVG2} as avg_rating
from users u join ratings r using (user_id)
group by r.user_id, u.gender, u.age, u.occupation
order by rating_count desc, r.user_id limit 20"""

HIGH_RATE = half_up("cast(count(*) filter (r.rating >= 4) as double) * 100.0 / count(*)", 2)
PER_USER = half_up("cast(count(r.rating) as double) / count(distinct u.user_id)", 1)


def by_group(key: str, more: str = "") -> str:
    return f"""
select u.{key}, count(distinct u.user_id) as user_count, count(r.rating) as rating_count,
       {AVG3} as avg_rating{more}
from ratings r join users u using (user_id) group by u.{key}"""


GENDER = by_group("gender", f", {HIGH_RATE} as high_rate_pct")
OCCUPATION = by_group("occupation", f", {PER_USER} as rating_per_user")
TOP_OCCUPATION = OCCUPATION + " order by rating_count desc, occupation limit 20"


def all_users(key: str, grouped: str, columns: str) -> str:
    """A grouped report with the user count taken from the whole users table."""
    return f"""
select s.{key}, a.user_count, {columns}
from ({grouped}) s
join (select {key}, count(distinct user_id) as user_count from users group by {key}) a
  on s.{key} = a.{key}"""


SUMMARY = f"""
select total_movies, total_ratings, total_users, avg_rating
from (select count(distinct movie_id) as total_movies from movies),
     (select count(*) as total_ratings, {half_up("avg(rating)", 3)} as avg_rating from ratings),
     (select count(distinct user_id) as total_users from users)"""

AGE_GENRE = """
from (
  select age_group, genre, count(*) as genre_rating_count
  from genres join ratings using (movie_id) join users using (user_id) group by all)
qualify row_number() over (partition by age_group order by genre_rating_count desc, genre) <= 3"""


def _rollup() -> str:
    pieces = [
        f"""
select '{key}' as dimension, u.{key} as label, count(distinct u.user_id) as user_count,
       count(*) as n_rows, count(r.rating) as rating_count, sum(r.rating) as rating_sum,
       count(*) filter (r.rating >= 4) as high_count
from ratings r join users u using (user_id) group by u.{key}"""
        for key in ("gender", "age_group", "occupation")
    ]
    return with_tables("ratings", "users", sql="\nunion all".join(pieces))


# ---- all marts -------------------------------------------------------------------------------

SCORES = f"""
select cast(trunc(rating) as integer) as score, count(*) as count,
       {pct("count(*)", "sum(count(*)) over ()")} as percentage
from ratings group by 1"""

TOP_MOVIES = f"""
select m.title as movie_name, {AVG2} as avg_rating, count(*) as rating_count
from movies m join ratings r using (movie_id)
group by m.title having count(*) >= 50
order by avg_rating desc, rating_count desc, movie_name limit 20"""

ALL = ("ratings", "movies", "genres", "users")


def long_marts(top_movies: str = TOP_MOVIES) -> str:
    def piece(mart: str, sql: str, label: str, count: str, value: str) -> str:
        return (f"select '{mart}' as mart, cast({label} as varchar) as label, "
                f"cast({count} as bigint) as ratings, cast({value} as double) as value from ({sql})")

    return "\nunion all ".join([
        piece("rating_distribution", SCORES, "score", "count", "percentage"),
        piece("top_movies", top_movies, "movie_name", "rating_count", "avg_rating"),
        piece("genre_stats", genre_stats(), "genre_name", "rating_count", "avg_rating"),
        piece("active_users", ACTIVE_USERS, "user_id", "rating_count", "avg_rating"),
        piece("gender_comparison", GENDER, "gender", "rating_count", "avg_rating"),
        piece("age_group_stats", by_group("age_group"), "age_group", "rating_count", "avg_rating"),
        piece("occupation_stats", TOP_OCCUPATION, "occupation", "rating_count", "avg_rating"),
        piece("dashboard_summary", SUMMARY, "total_users", "total_ratings", "avg_rating"),
    ])


def analyze_all() -> str:
    return with_tables(*ALL, sql=long_marts())


def raw_marts() -> str:
    """All marts of the headerless files, from the cleaned tables as SQL."""
    cleaned = {kind: ORACLE[f"S3_scan_coloncolon_{kind}"] for kind in ("ratings", "movies", "users")}
    tables = [f"{kind} as ({sql})" for kind, sql in cleaned.items()] + [f"genres as ({SQL['genres']})"]
    top = TOP_MOVIES.replace("count(*) >= 50", "count(*) >= 3")
    return f"with {', '.join(tables)} {long_marts(top)}"


def uploaded_marts() -> str:
    """All marts of the messy folder; users count by their ratings."""
    tables = [
        f"ratings as ({ORACLE['S2_ingested_ratings']})",
        f"movies as ({ORACLE['C3_ingested_movies']})",
        f"genres as ({SQL['genres']})",
        "users as (select * replace (nullif(age_group, '?') as age_group) "
        f"from ({ORACLE['C3_ingested_users']}))",
    ]
    top = TOP_MOVIES.replace("count(*) >= 50", "count(*) >= 3")
    marts = long_marts(top).replace(SUMMARY, SUMMARY.replace("from users)", "from ratings)"))
    return f"with {', '.join(tables)} {marts}"


def _views() -> dict[str, str]:
    def dec(name: str, precision: int, scale: int) -> str:
        return f"cast({name} as decimal({precision},{scale})) as {name}"

    a2, a3 = dec("avg_rating", 4, 2), dec("avg_rating", 5, 3)
    shown = {
        "rating_distribution": (SCORES, f"score, count, {dec('percentage', 5, 2)}"),
        "top_movies": (TOP_MOVIES, f"movie_name, {a2}, rating_count"),
        "genre_stats": (genre_stats(), f"genre_name, movie_count, {a2}, rating_count"),
        "active_users": (
            ACTIVE_USERS,
            "cast(user_id as bigint) as user_id, gender, cast(age as varchar) as age, "
            f"occupation, rating_count, {a2}",
        ),
        "gender_comparison": (
            GENDER, f"gender, user_count, rating_count, {a3}, {dec('high_rate_pct', 5, 2)}"),
        "age_group_stats": (
            by_group("age_group"), f"age_group, user_count, rating_count, {a3}"),
        "occupation_stats": (
            TOP_OCCUPATION,
            f"occupation, user_count, rating_count, {a3}, {dec('rating_per_user', 20, 1)}"),
        "dashboard_summary": (SUMMARY, f"total_movies, total_ratings, total_users, {a3}"),
    }
    return {name: f"select {columns} from ({sql})" for name, (sql, columns) in shown.items()}


VIEWS = _views()


def plain(name: str) -> str:
    """A view with its decimals as doubles."""
    decimals = ("percentage", "avg_rating", "high_rate_pct", "rating_per_user")
    casts = ", ".join(f"cast({c} as double) as {c}" for c in decimals if f" as {c}" in VIEWS[name])
    return f"select * replace ({casts}) from ({VIEWS[name]})"


def briefing() -> str:
    """The sections as JSON text. Decimals print with their scale, as in the marts."""
    def section(name: str, columns: str, limit: str = "") -> str:
        fields = []
        for column in columns.split():
            text = f"cast({column} as varchar)"
            quoted = column in ("genre_name", "movie_name", "gender", "age_group", "occupation")
            value = f"'\"' || {text} || '\"'" if quoted else text
            fields.append(f"'\"{column}\":' || {value}")
        content = "'{' || " + " || ',' || ".join(fields) + " || '}'"
        return (f"select '{name}' as name, {content} as content "
                f"from (select * from ({VIEWS[name]}) {limit})")

    return with_tables(*ALL, sql="\nunion all ".join([
        section("dashboard_summary", "total_movies total_ratings total_users avg_rating"),
        section("rating_distribution", "score count percentage"),
        section("genre_stats", "genre_name movie_count avg_rating rating_count",
                "order by movie_count desc, genre_name limit 10"),
        section("top_movies", "movie_name avg_rating rating_count",
                "order by avg_rating desc, rating_count desc, movie_name limit 10"),
        section("gender_comparison", "gender user_count rating_count avg_rating high_rate_pct"),
        section("age_group_stats", "age_group user_count rating_count avg_rating"),
        section("occupation_stats", "occupation user_count rating_count avg_rating",
                "order by rating_count desc, occupation limit 10"),
    ]))


# ---- cleaning --------------------------------------------------------------------------------

SHIPPED = "cast(floor(epoch(l_shipdate)) as bigint)"
HALF_STAR = "(cast(trunc(l_quantity) as integer) % 10 + 1) / 2.0::double"

# The rows of checks.queries.dirty_ratings: key present, rating as a number where it is one.
DIRTY = f"""dirty as (
  select case when l_tax > 0.07 then null else cast(l_orderkey as bigint) end as user_id,
         cast(l_partkey as bigint) as movie_id,
         case l_linenumber when 1 then null when 2 then null when 3 then -1.0 when 4 then 100.0
              when 5 then 4.0 when 6 then 7.5 else {HALF_STAR} end::double as rating,
         case when l_returnflag = 'R' then null else {SHIPPED} end as ts
  from lineitem)"""

CUSTOMER_LETTER = "case c_custkey % 4 when 0 then 'M' when 1 then 'm' when 2 then 'F' else 'x' end"
# Occupation labels by code, 0 to 20.
OCCUPATIONS = (
    "other", "academic/educator", "artist", "clerical/admin", "college/grad student",
    "customer service", "doctor/health care", "executive/managerial", "farmer", "homemaker",
    "K-12 student", "lawyer", "programmer", "retired", "sales/marketing", "scientist",
    "self-employed", "technician/engineer", "tradesman/craftsman", "unemployed", "writer",
)
_LABELS = "[" + ", ".join("'" + label + "'" for label in OCCUPATIONS) + "]"
CUSTOMER_JOB = f"coalesce(list_extract({_LABELS}, cast(c_custkey % 25 as integer) + 1), 'unknown')"


# ---- derived files ---------------------------------------------------------------------------

# Usable ratings of the messy folder, before duplicates go.
MESSY_RATINGS = f"""
  select cast(l_orderkey as bigint) as user_id, cast(l_partkey as bigint) as movie_id,
         {HALF_STAR} as rating, {SHIPPED} as ts from lineitem where l_linenumber in (1, 7)
  union all
  select cast(user_id as bigint), cast(event_id as bigint),
         (cast(trunc(value) as integer) % 10 + 1) / 2.0::double,
         cast(floor(epoch(ts)) as bigint) from events
  union all
  select cast(o_custkey as bigint), cast(o_orderkey as bigint),
         cast(cast(floor(o_totalprice) as bigint) % 12 as double),
         cast(floor(epoch(o_orderdate)) as bigint)
  from orders where cast(floor(o_totalprice) as bigint) % 12 <= 10"""

MESSY_AGE = "case when c_custkey % 11 = 5 then null else cast(c_custkey % 70 as integer) end"

# Lines of the damaged rating file by what becomes of them.
DAMAGE = """
  select case l_linenumber when 3 then 'header' when 4 then 'invalid_rating'
              when 5 then 'too_few_fields' when 6 then 'rating_out_of_range' else 'ok' end as reason
  from lineitem where l_linenumber <> 2
  union all
  select case when cast(floor(o_totalprice) as bigint) % 12 <= 10 then 'ok'
              else 'rating_out_of_range' end from orders
  union all select 'ok' from events"""


# Usable ratings of the headerless folder, before duplicates go.
HEADERLESS_RATINGS = f"""
  select cast(l_orderkey as bigint) as user_id, cast(l_partkey as bigint) as movie_id,
         {HALF_STAR} as rating, {SHIPPED} as ts from lineitem where l_linenumber not in (4, 6)
  union all
  select cast(user_id as bigint), cast(event_id as bigint),
         (cast(trunc(value) as integer) % 10 + 1) / 2.0::double,
         cast(floor(epoch(ts)) as bigint) from events"""


def headerless_marts() -> str:
    """All marts of the headerless folder; users count by their ratings."""
    tables = [
        f"ratings as ({ORACLE['V5_headerless_ratings']})",
        f"movies as ({ORACLE['V5_headerless_movies']})",
        f"genres as ({SQL['genres']})",
        "users as (select * replace (nullif(age_group, '?') as age_group) "
        f"from ({ORACLE['V5_headerless_users']}))",
    ]
    top = TOP_MOVIES.replace("count(*) >= 50", "count(*) >= 3")
    marts = long_marts(top).replace(SUMMARY, SUMMARY.replace("from users)", "from ratings)"))
    return f"with {', '.join(tables)} {marts}"


def _dialects() -> str:
    rows = [
        ("user_id,movie_id,rating,timestamp", ",", "ratings", "lineitem where l_linenumber <> 2"),
        ("userId\tmovie\tscore\ttime", "\t", "ratings", "events"),
        ("UserID::MovieID::Rating::Timestamp", "::", "ratings", "orders"),
        ("movieId,title,genre,shelf", ",", "movies",
         "(select p_partkey from part union all select n_nationkey from nation)"),
        ("user_id\tgender\tage\toccupation\tzip_code", "\t", "users", "customer"),
        ("user_id,movie_id,timestamp", ",", None, "supplier"),
    ]
    pieces = [
        "select 'alpha,beta' as head, ',' as sep, false as has_header, 'none' as role, "
        "'_c0|_c1' as fields, count(*) + 1 as n_lines from region",
        "select 'prose', 'none', false, 'none', 'none', count(*) from region",
    ]
    for head, sep, role, source in rows:
        shown = "tab" if sep == "\t" else sep
        pieces.append(f"select '{head}' as head, '{shown}' as sep, true as has_header, "
                      f"'{role or 'none'}' as role, '{head.lower().replace(sep, '|')}' as fields, "
                      f"count(*) as n_lines from {source}")
    return "\nunion all ".join(pieces)


ORACLE: dict[str, str] = {
    "Q1_rating_distribution": distribution(),
    "Q1a_rating_distribution_rounded": distribution("floor(rating + 0.5)"),
    "Q1b_pct_of_constant": distribution(total="1000209"),
    "Q2_top_movies": top_movies(50),
    "Q2_top_movies_uploads": top_movies(3),
    "Q2_top_movies_by_id": top_movies(20, key="r.movie_id, m.title"),
    "Q2a_top_movies_unrounded": top_movies(50, "avg(r.rating)"),
    "Q3_genre_stats": with_tables("ratings", "genres", sql=genre_stats()),
    "Q3_genre_stats_all_movies": with_tables("ratings", "genres", sql=GENRE_STATS_ALL),
    "Q4_active_users": with_tables("ratings", "users", sql=ACTIVE_USERS),
    "Q4a_active_users_no_profile": with_tables("ratings", sql=f"""
select user_id, '?' as gender, 0 as age, '?' as occupation, count(*) as rating_count,
       {half_up("avg(rating)", 2)} as avg_rating
from ratings group by user_id order by rating_count desc, user_id limit 20"""),
    "Q5_gender_comparison": with_tables("ratings", "users", sql=GENDER),
    "Q5_gender_comparison_all_users": with_tables("ratings", "users", sql=all_users(
        "gender", GENDER, "s.rating_count, s.avg_rating, s.high_rate_pct")),
    "Q5a_gender_rating_share": with_tables("ratings", "users", sql=all_users(
        "gender", by_group("gender", ", " + half_up(
            "cast(count(*) as double) * 100.0 / (select count(*) from ratings)", 2)
            + " as rating_share_pct"),
        "s.rating_count, s.avg_rating, s.rating_share_pct")),
    "Q6_age_group_stats": with_tables("ratings", "users", sql=by_group("age_group")),
    "Q6_age_group_stats_all_users": with_tables("ratings", "users", sql=all_users(
        "age_group", by_group("age_group"), "s.rating_count, s.avg_rating")),
    "Q7_age_genre_top3": with_tables("ratings", "users", "genres", sql=AGE_GENRE),
    "Q8_occupation_stats": with_tables("ratings", "users", sql=TOP_OCCUPATION),
    "Q8_occupation_stats_all_users": with_tables("ratings", "users", sql=f"""
select s.occupation, a.user_count, s.rating_count, s.avg_rating,
       {half_up("cast(s.rating_count as double) / a.user_count", 1)} as rating_per_user
from ({by_group("occupation")}) s
join (select occupation, count(distinct user_id) as user_count from users group by occupation) a
  on s.occupation = a.occupation"""),
    "Q9_dashboard_summary": with_tables("ratings", "movies", "users", sql=SUMMARY),
    "Q9_dashboard_summary_raters": with_tables("ratings", "movies", sql=f"""
select (select count(distinct movie_id) from movies) as total_movies, count(*) as total_ratings,
       count(distinct user_id) as total_users, {half_up("avg(rating)", 3)} as avg_rating
from ratings"""),
    "Q9a_genre_count": with_tables(
        "genres", sql="select count(distinct genre) as genre_count from genres"),
    "Q10_upload_summary_fallback": with_tables("ratings", sql="""
select count(distinct movie_id) as movie_count, count(*) as rating_count,
       count(distinct user_id) as user_count from ratings"""),
    **{
        f"Q11_user_counts_{key}": with_tables("users", sql=f"""
select {key}, count(distinct user_id) as user_count from users group by {key}""")
        for key in ("gender", "age_group", "occupation")
    },
    "Q12_movie_counts_all": with_tables("genres", sql="""
select genre as genre_name, count(distinct movie_id) as movie_count from genres group by genre"""),
    "Q14_analyze_all": analyze_all(),
    "demographic_rollup": _rollup(),
    "T1_strip_title_year": with_tables("movies", sql=r"""
select movie_id, title_full, trim(regexp_replace(title_full, '\s*\(\d{4}\)\s*$', '')) as title
from movies"""),
    "T2_explode_genres": with_tables("movies", sql="""
select movie_id, title, trim(piece) as genre
from (select movie_id, title, unnest(string_split(genres_raw, '|')) as piece from movies)
where trim(piece) <> ''"""),
    "T3_strict_rating_filter": f"""with {DIRTY}
select * from dirty where user_id is not null and ts is not null and rating between 1 and 5""",
    "T4_lenient_rating_filter": f"""with {DIRTY}
select user_id, movie_id, rating, coalesce(ts, 0) as ts
from dirty where user_id is not null and rating between 0 and 10""",
    "T5_quality_counts": f"""with {DIRTY}
select count(*) as rows_before,
       count(*) filter (user_id is not null and rating between 0 and 10) as rows_after,
       count(*) - rows_after as rows_removed,
       count(*) filter (user_id is null) as missing_key,
       cast(0 as bigint) as invalid_timestamp,
       count(*) filter (user_id is not null and rating is null) as invalid_rating,
       count(*) filter (user_id is not null and rating not between 0 and 10)
         as rating_out_of_range
from dirty""",
    "T5_quarantine_reasons": f"""with {DIRTY}
select reason, count(*) as n from (
  select case when user_id is null then 'missing_key' when ts is null then 'invalid_timestamp'
              when rating is null then 'invalid_rating'
              when rating not between 1 and 5 then 'rating_out_of_range' end as reason from dirty)
where reason is not null group by reason""",
    "T6_decode_gender": f"""
select c_custkey as user_id,
       case when upper({CUSTOMER_LETTER}) = 'M' then 'Male' else 'Female' end as gender
from customer""",
    "T7_age_bucket": with_tables("users", sql="select user_id, age, age_group from users"),
    "T8_decode_occupation": f"select c_custkey as user_id, {CUSTOMER_JOB} as occupation from customer",
    "T9_distinct_rows": with_tables("ratings", sql="select distinct * from ratings"),
    "T10_require_keys": with_tables("ratings", sql="select * from ratings where user_id >= 0"),
    "T11_trim_fields": "select c_custkey as user_id, c_mktsegment as occupation from customer",
    "T12_table_counts": with_tables(*ALL, sql="""
select 'movies' as tbl, count(*) as cnt from movies union all
select 'ratings', count(*) from ratings union all
select 'users', count(*) from users union all
select 'movie_genres', count(*) from genres"""),
    "T13_gender_tally": with_tables("users", sql="""
select count(*) filter (gender = 'Male') as male_users,
       count(*) filter (gender = 'Female') as female_users from users"""),
    "C2_map_aliases": """
select cast(l_orderkey as varchar) as user_id, cast(l_partkey as varchar) as movie_id,
       cast(l_quantity as varchar) as rating, cast(l_linenumber as varchar) as shelf
from lineitem""",
    "C4_merge_role_files": """
select rating, ts, count(*) as n, min(user_id) as least_user from (
  select cast(l_orderkey as bigint) as user_id, l_quantity as rating, cast(0 as bigint) as ts
  from lineitem
  union all select cast(user_id as bigint), 3.0, 7 from events) group by rating, ts""",
    "C5_typed_cast": """
select cast(l_orderkey as bigint) as user_id, cast(l_partkey as bigint) as movie_id,
       l_quantity as rating, cast(0 as bigint) as ts from lineitem""",
    "C6_default_fill": with_tables("ratings", "users", sql="""
select r.user_id, coalesce(u.gender, '?') as gender, coalesce(u.age, 0) as age,
       coalesce(u.occupation, '?') as occupation
from (select distinct user_id from ratings) r left join users u on r.user_id = u.user_id"""),
    "C7_title_full_fallback": """
select cast(p_partkey as bigint) as movie_id, p_name as title, p_name as title_full,
       '' as genres_raw from part""",
    "S1_scan_two_headers": f"""
select cast(l_orderkey as bigint) as user_id, cast(l_partkey as bigint) as movie_id,
       {HALF_STAR} as rating, {SHIPPED} as ts from lineitem
union all
select cast(user_id as bigint), cast(event_id as bigint),
       (cast(trunc(value) as integer) % 10 + 1) / 2.0::double,
       cast(floor(epoch(ts)) as bigint) from events""",
    "S2_read_dialect": f"""
select cast(l_orderkey as varchar) as user_id, cast(l_partkey as varchar) as movie_id,
       cast({HALF_STAR} as varchar) as rating, cast({SHIPPED} as varchar) as time, null as note
from lineitem
union all
select cast(user_id as varchar), cast(event_id as varchar),
       cast((cast(trunc(value) as integer) % 10 + 1) / 2.0::double as varchar),
       cast(cast(floor(epoch(ts)) as bigint) as varchar),
       'by ' || cast(event_id as varchar) || ', later' from events""",
    "S1_scan_csv": with_tables("movies", sql="""
select cast(movie_id as bigint) as movie_id, title, title_full, trim(genres_raw) as genres_raw
from movies"""),
    "S3_scan_coloncolon_ratings": f"""
select distinct cast(l_orderkey as bigint) as user_id, cast(l_partkey as bigint) as movie_id,
       {HALF_STAR} as rating, {SHIPPED} as ts
from lineitem where l_linenumber not in (4, 5, 6) and {HALF_STAR} between 1 and 5""",
    "S3_scan_coloncolon_movies": with_tables("movies", sql=r"""
select distinct cast(movie_id as bigint) as movie_id,
       trim(regexp_replace(title_full, '\s*\(\d{4}\)\s*$', '')) as title, title_full,
       trim(genres_raw) as genres_raw from movies"""),
    "S3_scan_coloncolon_users": f"""
select cast(c_custkey as bigint) as user_id,
       case when upper({CUSTOMER_LETTER}) = 'M' then 'Male' else 'Female' end as gender,
       cast(c_custkey % 70 as integer) as age, {age_case("(c_custkey % 70)")} as age_group,
       cast(c_custkey % 25 as integer) as occupation_id, {CUSTOMER_JOB} as occupation,
       '48067' as zipcode from customer""",
    "V5_headerless_admission": """
select true as accepted, 'ratings' as role, 'none' as reason,
       'user_id:0 movie_id:1 rating:2 time:3' as places, count(*) as n_lines from lineitem
union all select true, 'ratings', 'none', 'time:0 rating:1 user_id:2 movie_id:3', count(*)
  from events
union all select true, 'users', 'none', 'user_id:0 gender:1 age:2 occupation:3 zipcode:4', count(*)
  from customer
union all select true, 'movies', 'none', 'movie_id:0 title:1 genres:2', count(*)
  from (select p_partkey from part union all select n_nationkey from nation)
union all select false, 'none', 'ambiguous_columns', '', count(*) from supplier
union all select false, 'none', 'no_known_column', '', count(*) from region""",
    "V5_headerless_ratings": f"select distinct * from ({HEADERLESS_RATINGS})",
    "V5_headerless_movies": with_tables("movies", sql="""
select distinct cast(movie_id as bigint) as movie_id, title || ', the ' || title_full as title,
       title || ', the ' || title_full as title_full, trim(genres_raw) as genres_raw from movies"""),
    "V5_headerless_users": f"""
select cast(c_custkey as bigint) as user_id,
       case when c_custkey % 3 = 0 then 'F' else 'M' end as gender,
       coalesce({MESSY_AGE}, -1) as age,
       coalesce({age_case(f"({MESSY_AGE})")}, '?') as age_group,
       c_mktsegment as occupation, '12345' as zipcode from customer""",
    "S6_sniff_dialect": _dialects(),
    "S3_undecodable_titles": r"""
select distinct cast(p_partkey as bigint) as movie_id, p_name || ' é' as title,
       p_type as genres_raw from part""",
    "S7_strip_bom": """
select cast(user_id as bigint) as user_id, cast(event_id as bigint) as movie_id,
       (cast(trunc(value) as integer) % 10 + 1) / 2.0::double as rating,
       cast(floor(epoch(ts)) as bigint) as ts from events""",
    "M5_managed_tables": with_tables(*ALL, sql=f"""
select 'canonical_ratings' as tbl, count(*) as cnt from ratings
union all select 'canonical_movies', count(*) from movies
union all select 'canonical_users', count(*) from users
union all select 'canonical_movie_genres', count(*) from genres
union all select 'rating_distribution', count(*) from ({SCORES})
union all select 'top_movies', count(*) from ({TOP_MOVIES})
union all select 'genre_stats', count(*) from ({genre_stats()})
union all select 'active_users', count(*) from ({ACTIVE_USERS})
union all select 'gender_comparison', count(*) from ({GENDER})
union all select 'age_group_stats', count(*) from ({by_group("age_group")})
union all select 'occupation_stats', count(*) from ({TOP_OCCUPATION})
union all select 'dashboard_summary', count(*) from ({SUMMARY})"""),
    "V9_V10_gates": """
select 'prose' as folder, 'no acceptable file' as reason, count(*) as n_lines from region
union all select 'movies', 'no usable rating',
       (select count(*) from part) + (select count(*) from nation)
union all select 'words', 'no usable rating', count(*) from supplier""",
    "T5_ingest_quality": f"""with outcomes as ({DAMAGE})
select 'ratings' as role, reason, count(*) as n from outcomes where reason <> 'header' group by reason
union all select 'movies', 'ok', (select count(*) from part) + (select count(*) from nation)
union all select 'users', 'ok', count(*) from customer""",
    "Q13_marts_without_users": with_tables("ratings", "movies", "genres", sql=f"""
select 'rating_distribution' as mart, count(*) as n from ({SCORES})
union all select 'top_movies', count(*) from ({TOP_MOVIES})
union all select 'genre_stats', count(*) from ({genre_stats()})
union all select 'active_users', least(20, count(distinct user_id)) from ratings
union all select 'dashboard_summary', 1"""),
    "G12_G13_positions": with_tables(*ALL, sql="\nunion all ".join(
        f"select '{mart}' as mart, cast({label} as varchar) as label, "
        f"row_number() over (order by {order}) as position from ({sql})"
        for mart, label, order, sql in (
            ("rating_distribution", "score", "score", SCORES),
            ("top_movies", "movie_name", "avg_rating desc, rating_count desc, movie_name", TOP_MOVIES),
            ("genre_stats", "genre_name", "movie_count desc, genre_name", genre_stats()),
            ("active_users", "user_id", "rating_count desc, user_id", ACTIVE_USERS),
            ("gender_comparison", "gender", "gender", GENDER),
            ("age_group_stats", "age_group", "list_position(['Under18', '19-25', '26-35', '36-45', "
             "'46-55', '56+'], age_group)", by_group("age_group")),
            ("occupation_stats", "occupation", "rating_count desc, occupation", TOP_OCCUPATION)))),
    "G7_approximate_distinct": with_tables("ratings", "genres", sql=f"""
select genre_name, movie_count, true as is_close, rating_count from ({genre_stats()})"""),
    "G7_united_sketches": with_tables("ratings", "movies", sql="""
select 'raters' as measure, count(distinct user_id) as n, true as is_close from ratings
union all select 'rated_movies', count(distinct movie_id), true from ratings
union all select 'movies', count(distinct movie_id), true from movies"""),
    "K1_append": with_tables("ratings", sql=f"""
select score, count, percentage from ({SCORES}), range(2)"""),
    "K5_inserted_ratings": with_tables("ratings", sql="""
select cast(user_id as bigint) as user_id, cast(movie_id as bigint) as movie_id, rating, ts
from ratings"""),
    "K5_inserted_movies": with_tables("movies", sql="select * from movies"),
    "K5_inserted_users": with_tables("users", sql="""
select cast(user_id as bigint) as user_id, gender, age, age_group, occupation from users"""),
    "K5_inserted_genres": with_tables("genres", sql="select * from genres"),
    "S9_scan_catalog": with_tables("ratings", "movies", "users", sql="""
select 'bound_movies' as tbl, count(*) as cnt from movies union all
select 'bound_ratings', count(*) from ratings union all
select 'bound_users', count(*) from users"""),
    "V1_V3_admission_report": f"""
select role <> 'none' as accepted, role,
       case when role <> 'none' then 'none' when sep = 'none' then 'no_delimiter'
            when head = 'alpha,beta' then 'no_known_column' else 'no_role' end as reason,
       cast(sum(n_lines) as bigint) as n_lines
from ({_dialects()}) group by all
union all select false, 'none', 'empty_file', 0""",
    "V6_V8_line_outcomes": f"""with outcomes as ({DAMAGE}), parts as (
  select count(*) as n from part), nations as (select count(*) as n from nation)
select 'ratings' as role, cast(count(*) filter (reason = 'ok') as bigint) as valid,
       cast(count(*) filter (reason not in ('ok', 'header')) as bigint) as quarantined,
       cast(count(*) filter (reason = 'header') as bigint) as repeated_headers from outcomes
union all select 'movies', parts.n + nations.n, 0, 0 from parts, nations
union all select 'users', count(*), 0, 0 from customer""",
    "V8_ingest_quarantine": f"""with outcomes as ({DAMAGE})
select 'ratings' as role, reason, count(*) as n from outcomes
where reason not in ('ok', 'header') group by reason""",
    "S2_ingested_ratings": f"select distinct * from ({MESSY_RATINGS})",
    "C3_ingested_movies": with_tables("movies", sql="""
select distinct cast(movie_id as bigint) as movie_id, title || ', the ' || title_full as title,
       title || ', the ' || title_full as title_full, trim(genres_raw) as genres_raw
from movies"""),
    "C3_ingested_users": f"""
select cast(c_custkey as bigint) as user_id,
       case when c_custkey % 3 = 0 then 'F' else 'M' end as gender,
       coalesce({MESSY_AGE}, -1) as age, coalesce({age_case(MESSY_AGE)}, '?') as age_group,
       c_mktsegment as occupation from customer""",
    "K3_export_delimited": top_movies(50),
    "K5_insert_canonical": with_tables(*ALL, sql="""
select 'movies' as tbl, count(*) as cnt, cast(sum(movie_id) as bigint) as ids,
       cast(sum(length(title) + length(genres_raw)) as bigint) as total from movies union all
select 'ratings', count(*), cast(sum(movie_id) as bigint),
       cast(sum(ts + cast(2 * rating as bigint)) as bigint) from ratings union all
select 'users', count(*), cast(sum(user_id) as bigint),
       cast(sum(age + length(gender) + length(occupation)) as bigint) from users union all
select 'movie_genres', count(*), cast(sum(movie_id) as bigint),
       cast(sum(length(title) + length(genre)) as bigint) from genres"""),
    "K6_update_registry_fallback": with_tables("ratings", sql="""
select 7 as id, 'from ratings' as name, count(distinct movie_id) as movie_count,
       count(*) as rating_count, count(distinct user_id) as user_count from ratings"""),
    "K8_json_rows": with_tables("ratings", sql=f"""
select '{{"score":' || score || ',"count":' || count || ',"percentage":' || percentage || '}}'
       as json from ({VIEWS["rating_distribution"]})"""),
    **{f"P1_view_{name}": with_tables(*ALL, sql=plain(name)) for name in VIEWS},
    "P2_list_datasets": with_tables(*ALL, sql=f"""
select d.id, d.name, s.total_movies as movie_count, s.total_ratings as rating_count,
       s.total_users as user_count
from ({SUMMARY}) s, (values (0, 'default'), (1, 'orders and events')) d(id, name)
union all select 2, 'waiting', 0, 0, 0"""),
    "P3_dataset_status": """
select 0 as id, 'ready' as status union all select 1, 'ready' union all select 2, 'analyzing'""",
    "P4_dataset_badge": """
select 0 as id, 'default' as badge union all select 1, 'analysed'
union all select 2, 'not_analysed'""",
    "P5_delete_dataset": with_tables(*ALL, sql=f"""
select s.*, d.dataset_id from ({plain("dashboard_summary")}) s,
       (values (0), (1)) d(dataset_id)"""),
    "P6_dataset_briefing": briefing(),
    "P7_top_genres_slice": with_tables("ratings", "genres", sql=genre_stats(
        " order by movie_count desc, genre_name limit 10")),
    "P7_top_occupations_slice": with_tables(
        "ratings", "users", sql=OCCUPATION + " order by rating_count desc, occupation limit 15"),
    "P8_share_of_slice": with_tables("ratings", "genres", sql=f"""
select *, {pct("movie_count", "sum(movie_count) over ()")} as share_pct from (
{genre_stats(" order by movie_count desc, genre_name limit 10")})"""),
    "P9_mean_line": with_tables("ratings", sql="""
select score, count, avg(count) over () as mean_value from (
  select cast(trunc(rating) as integer) as score, count(*) as count from ratings group by 1)"""),
    "X1_stream_ingest": f"""
select 'ok' as reason, rating, count(*) as n from (
  select distinct l_orderkey, l_partkey, {HALF_STAR} as rating, {SHIPPED} as ts
  from lineitem where l_linenumber in (1, 7)) group by rating
union all
select case l_linenumber when 4 then 'invalid_rating' when 5 then 'too_few_fields'
            else 'rating_out_of_range' end, -1, count(*)
from lineitem where l_linenumber in (4, 5, 6) group by 1""",
    "X1_stream_uploads": f"""
select distinct cast(l_orderkey as bigint) as user_id, cast(l_partkey as bigint) as movie_id,
       {HALF_STAR} as rating, {SHIPPED} as ts from lineitem where l_linenumber <> 4
union
select cast(user_id as bigint), cast(event_id as bigint),
       (cast(trunc(value) as integer) % 10 + 1) / 2.0::double,
       cast(floor(epoch(ts)) as bigint) from events
union
select cast(o_custkey as bigint), cast(o_orderkey as bigint),
       (cast(trunc(o_totalprice) as integer) % 10 + 1) / 2.0::double,
       cast(floor(epoch(o_orderdate)) as bigint) from orders""",
    "X1_stream_upload_movies": with_tables("movies", sql="""
select distinct cast(movie_id as bigint) as movie_id,
       case when movie_id % 2 = 0 then 'Score' else title end as title,
       case when movie_id % 2 = 0 then 'Score' else title end as title_full,
       trim(genres_raw) as genres_raw from movies"""),
    "X1_stream_upload_outcomes": """
select 'ratings' as role, 'ok' as reason,
       (select count(*) from lineitem where l_linenumber <> 4)
       + (select count(*) from lineitem where l_linenumber < 4)
       + (select count(*) from events) + (select count(*) from orders) as n
union all select 'ratings', 'invalid_rating', 2 * count(*) from lineitem where l_linenumber = 4
union all select 'movies', 'ok',
       (select count(*) from part) + (select count(*) from nation)""",
    "X2_stream_distribution": f"""
select cast(trunc({HALF_STAR}) as integer) as score, count(*) as count from lineitem group by 1""",
    "X2_stream_distribution_updated": f"""
select cast(trunc({HALF_STAR}) as integer) as score, count(*) as count from lineitem group by 1""",
    "X3_stream_daily_activity": """
select strftime(ts, '%Y-%m-%d') as day, count(*) as count
from events group by 1""",
}
ORACLE["E4_marts_from_raw_files"] = raw_marts()
ORACLE["K2_uploaded_marts"] = uploaded_marts()
ORACLE["V5_headerless_marts"] = headerless_marts()
