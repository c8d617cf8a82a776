"""The queries that SQL can express, against DuckDB on whole test tables."""

from __future__ import annotations

import pytest
from parity import connect, differences
from support import SF_DIR

from tripmill.llm.oracles import ORACLES
from tripmill.llm.queries import REGISTRY


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    connection = connect(SF_DIR)
    assert differences(REGISTRY[name](spark, SF_DIR), connection, ORACLES[name]) == ""
