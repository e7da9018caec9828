"""The queries of this package, and the SQL that gives the same rows where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from satloom.llm import dedup, fingerprint, lloyd, mixing, packing, pii, quality, secrets, sharding, simhash, toxicity, trie, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": pii.op1,
    "op2_warc": warc.op2,
    "op3_quality": quality.op3,
    "op4_toxicity": toxicity.op4,
    "op5_packing": packing.op5,
    "op6_sharding": sharding.op6,
    "op7_exact_dedup": dedup.op7,
    "op8_mixing": mixing.op8,
    "op9_secrets": secrets.op9,
    "op10_simhash": simhash.op10,
    "op11_prefix_trie": trie.op11,
    "op12_fingerprints": fingerprint.op12,
    "op13_vector_codes": lloyd.op13,
}

ORACLES: dict[str, str] = {
    "op1_pii": pii.OP1_SQL,
    "op2_warc": warc.OP2_SQL,
    "op7_exact_dedup": dedup.OP7_SQL,
    "op9_secrets": secrets.OP9_SQL,
    "op11_prefix_trie": trie.OP11_SQL,
    "op12_fingerprints": fingerprint.OP12_SQL,
    "op13_vector_codes": lloyd.OP13_SQL,
}
