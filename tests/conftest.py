import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from termcluster.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(4, shuffle_partitions=4, app="termcluster-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    yield s


def rows(df, *cols):
    """Collected rows as a sorted list of tuples (order-insensitive compare)."""
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
