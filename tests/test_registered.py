"""Every registered query against its SQL on the smallest driver tables."""

from pathlib import Path

import pytest
from compare import connect, differences

from runatlas.plans import catalog

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables absent")


@pytest.fixture(scope="module")
def sql_engine():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, sql_engine, name):
    df = catalog.QUERIES[name](spark, SF_DIR)
    if name in catalog.ORACLE:
        assert differences(df, sql_engine, catalog.ORACLE[name]) == []
    else:
        assert df.count() > 0
