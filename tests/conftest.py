import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidyforge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(cores=8, shuffle_partitions=4, memory="6g",
                            **{"spark.checkpoint.dir": folder})
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows as sorted tuples, missing values first."""
    def collect(df, *columns):
        found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(found, key=lambda r: [(v is not None, str(v)) for v in r])
    return collect
