import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from logsift.config import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="logsift-tests")
    yield s


def lines_df(spark, sessions):
    """sessions: {source_file_id: [line, ...]} -> log_lines DataFrame."""
    rows = [(sid, i + 1, line) for sid, ls in sessions.items() for i, line in enumerate(ls)]
    return spark.createDataFrame(rows, "source_file_id string, line_number int, line string")
