"""From a folder of files to canonical tables, and from there to marts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starboard.operators.cleaning import REASONS, ROW_OK, movie_genres
from starboard.operators.mapping import ROLES
from starboard.plans import marts as M
from starboard.plans.analysis import Frames, analyze_all
from starboard.schemas import EXTENSIONS
from starboard.session import sized_shuffles, stage
from starboard.sources.dialects import admission_report, sniff_dialect
from starboard.sources.lines import list_files, scan_lines
from starboard.sources.parsing import (
    HEADER,
    TOO_FEW_FIELDS,
    canonical_movies,
    canonical_ratings,
    canonical_users,
    line_counts,
    measure,
    parse_rows,
    quarantine_of,
)
from starboard.sources.profiles import with_profiles
from starboard.sources.tables import read_raw_dat


# What can become of a line.
OUTCOMES = (ROW_OK, HEADER, TOO_FEW_FIELDS, *REASONS)


class DatasetRejected(ValueError):
    """Nothing in the folder can be analysed."""


@dataclass(frozen=True)
class Dataset:
    frames: Frames
    admission: DataFrame
    quarantine: DataFrame
    lines: DataFrame
    # Role -> outcome -> rows, counted while the rows were written.
    quality: Mapping[str, Mapping[str, int]] = field(default_factory=dict)


def load_dataset(
    spark: SparkSession,
    path: str,
    lo: float = 0,
    hi: float = 10,
    exts: tuple[str, ...] = EXTENSIONS,
) -> Dataset:
    """Read a folder of rating files of any dialect.

    The files are read twice: once for the dialects, once for the rows, which are written
    as one staged table that every later step reads with its own columns and filters. Files
    without a header are read once more for the profiles of their columns.
    Raises ``DatasetRejected`` if no file is acceptable or no rating is usable.
    """
    lines = scan_lines(spark, path, exts)
    with sized_shuffles(lines):
        return _load(spark, path, exts, lines, lo, hi)


def _load(
    spark: SparkSession, path: str, exts: tuple[str, ...], lines: DataFrame, lo: float, hi: float
) -> Dataset:
    files = list_files(spark, path, exts)
    sniffed = stage(sniff_dialect(lines), "dialects")
    bare = not sniffed.where("not has_header and sep is not null").isEmpty()

    def reread(paths: list[str]) -> DataFrame:
        return scan_lines(spark, paths, exts)

    dialects = stage(with_profiles(lines, sniffed, reread), "profiled") if bare else sniffed
    admission = admission_report(files, dialects)
    size = measure(dialects)
    if size.files == 0:
        raise DatasetRejected(f"no acceptable file in {path}")
    parsed = parse_rows(lines, dialects, lo, hi, size)
    counted = Observation("rows")
    outcomes = [F.count_if((F.col("role") == role) & (F.col("reason") == reason)).alias(
        f"{role}:{reason}") for role in ROLES for reason in OUTCOMES]
    rows = stage(parsed.observe(counted, *outcomes), "rows")
    quality = counted.get
    found = _found(quality, dialects)
    if "rating" not in found.get("ratings", {}):
        raise DatasetRejected(f"no usable rating in {path}")
    return Dataset(
        frames=_frames(rows, found),
        admission=admission,
        quarantine=quarantine_of(rows),
        lines=line_counts(rows, dialects),
        quality=_by_role(quality),
    )


def _by_role(counts: dict[str, int]) -> dict[str, dict[str, int]]:
    """Role -> outcome -> rows, without those that are none."""
    quality: dict[str, dict[str, int]] = {}
    for name, n in counts.items():
        role, reason = name.split(":")
        if n:
            quality.setdefault(role, {})[reason] = n
    return quality


def _found(counts: dict[str, int], dialects: DataFrame) -> dict[str, set[str]]:
    """Role -> canonical columns any of its files has, for roles with a usable row.

    At most three rows come to the driver.
    """
    names = dialects.schema["at"].dataType.names
    present = dialects.where("role is not null").groupBy("role").agg(
        *[F.max(F.col("at")[name].isNotNull()).alias(name) for name in names]
    )
    return {row["role"]: {name for name in names if row[name]} for row in present.collect()
            if counts[f"{row['role']}:{ROW_OK}"]}


def _frames(rows: DataFrame, found: dict[str, set[str]]) -> Frames:
    movies = users = genres = None
    if "movies" in found:
        movies = canonical_movies(rows)
        if "genres" in found["movies"]:
            genres = movie_genres(movies)
    if "users" in found:
        users = canonical_users(rows)
        absent = [name for name in ("gender", "age", "occupation") if name not in found["users"]]
        if "age" in absent and "age_group" not in found["users"]:
            absent.append("age_group")
        users = users.drop(*absent)
    return Frames(canonical_ratings(rows), movies, users, genres)


def analyze_dataset(
    spark: SparkSession,
    path: str,
    root: str,
    dataset_id: int,
    name: str | None = None,
    lo: float = 0,
    hi: float = 10,
    min_count: int = 3,
    **options,
) -> Dataset:
    """Load a folder, write its canonical tables, marts and registry row."""
    dataset = load_dataset(spark, path, lo, hi)
    options.setdefault("movie_scope", "all")
    options.setdefault("user_scope", "all")
    options.setdefault("users_from", "ratings")
    frames = _analyze(dataset.frames, root, dataset_id, name, min_count, options)
    return replace(dataset, frames=frames)


def load_raw_dataset(spark: SparkSession, path: str) -> Frames:
    """Canonical tables of a folder with headerless '::' files ``ratings``, ``movies``, ``users``.

    The names may go on, as in ``ratings.dat``, and each may be a folder. Cleaning is strict:
    ratings from 1 to 5 with a time; coded users are decoded.
    """
    ratings, movies, users = [
        read_raw_dat(spark, f"{path.rstrip('/')}/{kind}*", kind)
        for kind in ("ratings", "movies", "users")
    ]
    return Frames(ratings, movies, users, movie_genres(movies))


def analyze_raw_dataset(
    spark: SparkSession,
    path: str,
    root: str,
    dataset_id: int,
    name: str | None = None,
    min_count: int = 50,
    **options,
) -> Frames:
    """Load a folder of headerless '::' files, write canonical tables, marts and registry row."""
    frames = load_raw_dataset(spark, path)
    return _analyze(frames, root, dataset_id, name, min_count, options)


def _analyze(
    frames: Frames, root: str, dataset_id: int, name: str | None, min_count: int, options: dict,
) -> Frames:
    def analyze(written: Frames) -> dict[str, DataFrame]:
        return analyze_all(written, min_count=min_count, stage=stage, **options)

    tables = [frame for frame in vars(frames).values() if frame is not None]
    with sized_shuffles(*tables):
        return M.rewrite_dataset(frames, analyze, root, dataset_id, name)
