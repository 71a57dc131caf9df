"""Queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

from revlens.llm import byte_bpe, collocations, embedding_dedup, exact_dedup, language_id, license_scan, line_dedup, merkle_manifest, minhash_dedup, packing, quality, topk_search, url_filter

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_byte_bpe": byte_bpe.op2_byte_bpe,
    "op3_minhash_dedup": minhash_dedup.op3_minhash_dedup,
    "op4_embedding_dedup": embedding_dedup.op4_embedding_dedup,
    "op5_license_scan": license_scan.op5_license_scan,
    "op6_url_filter": url_filter.op6_url_filter,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_quality": quality.op8_quality,
    "op9_packing": packing.op9_packing,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_merkle_manifest": merkle_manifest.op11_merkle_manifest,
    "op12_collocations": collocations.op12_collocations,
    "op13_topk_search": topk_search.op13_topk_search,
}

ORACLE_SQL = {
    "op6_url_filter": url_filter.op6_sql(),
    "op7_exact_dedup": exact_dedup.OP7_SQL,
    "op10_line_dedup": line_dedup.OP10_SQL,
    "op11_merkle_manifest": merkle_manifest.OP11_SQL,
    "op12_collocations": collocations.OP12_SQL,
    "op13_topk_search": topk_search.OP13_SQL,
}
