import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from qtrbars.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's shared checkpoint folder."""
    from qtrbars.session import scratch_path
    return scratch_path(spark, "test")


def local(path: str) -> str:
    """Local file-system form of a ``file:`` URI."""
    return path[len("file:"):] if path.startswith("file:") else path


def write_files(base: str, files: dict) -> str:
    os.makedirs(local(base), exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(local(base), name), "w") as f:
            f.write(text)
    return base
