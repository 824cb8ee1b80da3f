import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwheel.config import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="cartwheel-tests", shuffle_partitions=8)
    yield s
    s.stop()


def write_lines(path, lines, name="part-0.json"):
    os.makedirs(path, exist_ok=True)
    full = os.path.join(path, name)
    with open(full, "w", encoding="utf-8", newline="") as f:
        f.write("".join(lines))
    return full


@pytest.fixture
def lines_writer():
    return write_lines
