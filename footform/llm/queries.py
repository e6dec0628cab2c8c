"""The subpackage's queries and their SQL, by name."""

from __future__ import annotations

from . import byte_bpe, decontaminate, exact_dedup, jaccard_join, language_id, merkle, packing, pii, prefix_trie, rans, suffix_dedup, toxicity, warc

QUERIES = {
    "op1_rans_tokens": rans.op1,
    "op2_decontamination": decontaminate.op2,
    "op3_language_id": language_id.op3,
    "op4_suffix_dedup": suffix_dedup.op4,
    "op5_packing": packing.op5,
    "op6_warc": warc.op6,
    "op7_toxicity": toxicity.op7,
    "op8_jaccard_join": jaccard_join.op8,
    "op9_pii": pii.op9,
    "op10_exact_dedup": exact_dedup.op10,
    "op11_merkle_manifest": merkle.op11,
    "op12_prefix_trie": prefix_trie.op12,
    "op13_byte_bpe": byte_bpe.op13,
}

ORACLE_SQL = {
    "op2_decontamination": decontaminate.ORACLE,
    "op6_warc": warc.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
}
