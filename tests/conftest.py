import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakeweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="4",
                            spark__sql__warehouse__dir=str(root / "warehouse"),
                            spark__checkpoint__dir=str(root / "shared"),
                            spark__driver__memory="8g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    def collect(df, *columns):
        picked = df.select(*[f"`{c}`" for c in columns]) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)
    return collect
