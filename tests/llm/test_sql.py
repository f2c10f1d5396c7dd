"""Corpus queries against their SQL."""

import pytest
from compare import connect, differences

from canvass.llm import queries


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, name, sf):
    assert differences(connect(sf), queries.QUERIES[name](spark, sf), queries.SQL[name]) == ""
