"""Registered queries against their SQL on the smallest tables."""

import os

import pytest
from compare import differences, tables

from telewarden.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    assert differences(QUERIES[name](spark, SF), tables(SF), ORACLE[name]) == ""
