import pytest

from starboard.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in chosen.collect()), key=repr)

    return collect


@pytest.fixture
def folder(tmp_path):
    """Write files by name and return their folder."""

    target = tmp_path / "files"
    target.mkdir()

    def write(**files):
        for name, content in files.items():
            stem, _, ending = name.rpartition("_")
            data = content if isinstance(content, bytes) else content.encode()
            (target / f"{stem}.{ending}").write_bytes(data)
        return str(target)

    return write
