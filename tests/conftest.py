from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    s = build_session("local[4]", app="tidemark-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tidemark-test-", dir="/tmp")


def ms(s: str) -> int:
    """'2024-01-01 00:00:05.250' -> epoch ms (UTC)."""
    from datetime import datetime, timezone

    return int(datetime.fromisoformat(s).replace(tzinfo=timezone.utc).timestamp() * 1000)
