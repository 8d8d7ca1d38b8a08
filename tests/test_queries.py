"""Registered queries against their DuckDB SQL on the smallest data set; ``compare.py`` does all, at any scale."""

from __future__ import annotations

import pytest
from compare import differences, duck

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
CHECKED = ("union_sources phone_clean eid_valid weighted_confidence det_best det_links block_candidates prob_scored "
           "components method_attribution review_queue dim_customer dim_customer_hold_review run_stats name_clean phone_strict "
           "email_clean sql_functions jw_scores first_value_contact sectioned_json json_export empty_source prob_scored_all "
           "det_best_tiled dim_customer_tiled name_forms phone_forms json_export_all published_results sectioned_export sectioned_lines "
           "catalog_dim_customer prob_scored_every dim_customer_merged").split()


def test_every_query_has_sql():
    assert QUERIES.keys() - entry.LLM_QUERIES.keys() == ORACLE.keys() - entry.LLM_SQL.keys()


@pytest.mark.parametrize("name", CHECKED)
def test_query(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLE[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 13 and df.count() > 0
