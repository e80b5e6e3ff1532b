from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import build_session

    scratch = tempfile.mkdtemp(prefix="ledgerlake-tests-")
    session = build_session(
        master="local[*]",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": f"{scratch}/ckpt", "spark.sql.warehouse.dir": f"{scratch}/warehouse"},
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir(tmp_path) -> str:
    return str(tmp_path)
