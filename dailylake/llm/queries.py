"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dailylake.llm import bpe, decontaminate, htmltext, langid, lm, pii, prefixtrie, quality, runs, sharding, simhash, suffixdedup, topk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": topk.vector_search,
    "op2_simhash": simhash.simhash,
    "op3_sharding": sharding.shards,
    "op4_lm_score": lm.lm_score,
    "op5_byte_bpe": bpe.byte_bpe,
    "op6_decontamination": decontaminate.contamination,
    "op7_suffix_dedup": suffixdedup.suffix_dedup,
    "op8_quality": quality.quality,
    "op9_langid": langid.language_id,
    "op10_pii": pii.personal_data,
    "op11_html_text": htmltext.main_text,
    "op12_periodic_runs": runs.periodic_runs,
    "op13_prefix_trie": prefixtrie.prefix_trie,
}

ORACLE: dict[str, str] = {
    "op1_topk": topk.VECTOR_SEARCH_SQL,
    "op3_sharding": sharding.SHARDS_SQL,
    "op6_decontamination": decontaminate.CONTAMINATION_SQL,
    "op13_prefix_trie": prefixtrie.PREFIX_TRIE_SQL,
}
