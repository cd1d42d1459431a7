"""The queries of this subpackage by name, and SQL where SQL can express them."""

from __future__ import annotations

from barpath.llm import bpe, decontaminate, embeddings, extract, katz, packing, pii, quality, search, sharding, simhash, tokens, whitening

QUERIES = {
    "op1_katz": katz.op1_katz,
    "op2_packing": packing.op2_packing,
    "op3_extract": extract.op3_extract,
    "op4_embeddings": embeddings.op4_embeddings,
    "op5_pii": pii.op5_pii,
    "op6_sharding": sharding.op6_sharding,
    "op7_quality": quality.op7_quality,
    "op8_simhash": simhash.op8_simhash,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_tokens": tokens.op10_tokens,
    "op11_search": search.op11_search,
    "op12_whitening": whitening.op12_whitening,
    "op13_bpe": bpe.op13_bpe,
}
ORACLE_SQL: dict[str, str] = {"op6_sharding": sharding.oracle_sql(), "op11_search": search.oracle_sql()}
