from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture(autouse=True)
def _ready(spark):
    from knownby.llm.tables import prepare

    prepare(spark)
