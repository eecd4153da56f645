"""Registered queries against their check SQL on the smallest data set."""

import importlib.util
import os

import duckdb
import pytest

from evidara.plans import load_all
from evidara.plans.registry import ORACLES, QUERIES

HERE = os.path.dirname(os.path.abspath(__file__))
spec = importlib.util.spec_from_file_location("check", os.path.join(HERE, "..", "tools", "check.py"))
check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check)
SF = "/root/testdata/sf0.001"
NAMES = [
    "candidate_rank_table", "rho_statistic", "fair_rank_score", "og_vote", "gate_loo", "consensus_three_way", "adjusted_rand_index",
    "v_measure", "evidence_funnel", "benjamini_hochberg", "mann_whitney", "roc_youden", "weight_sensitivity", "select_batch",
    "interval_loci", "tandem_clusters", "interval_overlap_join", "placement_cascade", "conserved_regions", "selection_score",
    "cds_splice", "identifier_recovery", "positive_control_lookup", "best_assembly", "tissue_enrichment", "family_expansion",
    "weighted_ref_proximity", "monophyly_check", "column_conservation", "near_duplicate_clusters", "knn_novelty", "swe_pooling",
    "rra_score", "tied_block_size", "inventory_append", "quota_subsample", "balanced_sample", "merge_evidence_channels", "structure_mapping",
    "anchor_set_build", "signal_groups", "scan_hmm_tblout", "identity_separation",
    "scan_paf", "scan_branch_json", "scan_newick", "sink_atomic_table", "two_sample_tests", "hit_graph_clustering",
    "nearest_ref_distance", "landmark_nearest", "placement_distance", "best_and_margin", "concordant_placement",
    "permuted_votes", "enrichment_null", "anchor_verdict_lists",
    "condition_compare", "clade_consensus", "anchor_infiltration", "edge_family_map",
    "read_hmm_tblout", "read_paf", "read_gff", "read_quant_tree", "read_anchor_blocks", "read_cluster_dump", "read_hhr", "read_structure_alignment",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in check.TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    load_all()
    df = QUERIES[name](spark, SF)
    rel = con.execute(ORACLES[name])
    cols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(cols)
    assert check.rows_of(df.columns, [tuple(r) for r in df.collect()]) == check.rows_of(cols, rel.fetchall())


def test_every_check_belongs_to_a_query():
    load_all()
    assert set(ORACLES) <= set(QUERIES)
