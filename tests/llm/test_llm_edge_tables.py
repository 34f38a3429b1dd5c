import pytest

from geoweave.llm import queries
from tests import edge

pytestmark = pytest.mark.skipif(not edge.DATA.exists(), reason="needs the small test tables")


@pytest.mark.parametrize("kind", ["empty", "nulls", "repeated"])
def test_queries_on_edge_tables(spark, tmp_path, kind):
    got = edge.run(spark, edge.write(spark, tmp_path, kind), queries.QUERIES)
    if kind == "empty":
        assert not any(got.values()), got
    if kind == "nulls":
        # A mention without text means no place; documents stay as they are.
        assert {q: n for q, n in got.items() if n} == {"p6_found": 1, "p9_redacted": 3}
