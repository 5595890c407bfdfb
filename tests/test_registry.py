import oracle
import pytest

from skyledger.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    df = registry.QUERIES[name](spark, SF)
    if name in registry.ORACLE_SQL:
        assert oracle.compare(df, registry.ORACLE_SQL[name], SF) is None
    else:
        assert df.count() > 0
