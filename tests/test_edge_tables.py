import pytest

from geoweave.plans import base, graph_queries, problems, relation_queries, source_queries  # noqa: F401
from tests import edge

pytestmark = pytest.mark.skipif(not edge.DATA.exists(), reason="needs the small test tables")
#: One query per family; all of them run on full tables elsewhere.
SOME = ["gaz_cleanse", "coord_validate_swap", "upsert_node", "upsert_edge", "array_predicates", "hier_part_of", "hier_paths", "hier_closure", "confidence_canada", "hgis_top5", "recon_smart", "agent_rollup", "shared_place_groups", "migration_flows", "coverage_stats", "active_in_year", "cosine_topk", "src_dry_run", "src_entity_places", "src_turtle_persons", "stream_ingest", "hier_located_in", "hier_path_names", "collect_maps_by_size", "fulltext_search"]


@pytest.mark.parametrize("kind", ["empty", "nulls", "repeated"])
def test_queries_on_edge_tables(spark, tmp_path, kind):
    d = edge.write(spark, tmp_path, kind)
    got = edge.run(spark, d, problems.QUERIES | {n: base.QUERIES[n] for n in SOME})
    if kind == "empty":
        assert all(n == 0 for q, n in got.items() if q not in ("null_orders", "src_dry_run")), got
    if kind == "nulls":
        assert all(got[q] == 0 for q in ("p2_found", "p3_found", "p4_found"))
