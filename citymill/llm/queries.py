"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, forest, markov, mixing, near, pages, private, repeats, rules, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_site_template": pages.op1_site_template,
    "op2_hidden_markov": markov.op2_hidden_markov,
    "op3_rule_ledger": rules.op3_rule_ledger,
    "op4_projection_forest": forest.op4_projection_forest,
    "op5_toxic_neighbours": toxicity.op5_toxic_neighbours,
    "op6_byte_bpe": bpe.op6_byte_bpe,
    "op7_minhash_join": near.op7_minhash_join,
    "op8_pivotal_mix": mixing.op8_pivotal_mix,
    "op9_suffix_repeats": repeats.op9_suffix_repeats,
    "op10_surrogates": private.op10_surrogates,
}

#: DuckDB SQL for the queries that SQL can express over whole tables.
ORACLE_SQL: dict[str, str] = {
    "op3_rule_ledger": rules.OP3_SQL,
    "op7_minhash_join": near.OP7_SQL,
}
