"""The queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from listenlake.llm import (
    exact_dedup,
    jaccard_join,
    language_id,
    license_scan,
    mixing,
    packing,
    periodic_runs,
    prefix_trie,
    simhash,
    sketches,
    suffix_dedup,
    toxicity,
    warc,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
        "op2_packing": packing.op2_packing,
        "op3_exact_dedup": exact_dedup.op3_exact_dedup,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_simhash": simhash.op5_simhash,
        "op6_license_scan": license_scan.op6_license_scan,
        "op7_fingerprints": sketches.op7_fingerprints,
        "op8_mixing": mixing.op8_mixing,
        "op9_warc": warc.op9_warc,
        "op10_language_id": language_id.op10_language_id,
        "op11_periodic_runs": periodic_runs.op11_periodic_runs,
        "op12_jaccard_join": jaccard_join.op12_jaccard_join,
        "op13_prefix_trie": prefix_trie.op13_prefix_trie,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": exact_dedup.ORACLE_SQL,
        "op11_periodic_runs": periodic_runs.ORACLE_SQL,
        "op12_jaccard_join": jaccard_join.ORACLE_SQL,
        "op13_prefix_trie": prefix_trie.ORACLE_SQL,
    }
