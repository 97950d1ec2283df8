"""Queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from sonarloom.llm import best_fit_packing, hnsw, line_dedup, minhash_dedup, piece_transducer, pseudonyms, quality_rules, sentence_spans, token_counts, warc_zip

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_best_fit_packing": best_fit_packing.op2_best_fit_packing,
    "op3_pseudonyms": pseudonyms.op3_pseudonyms,
    "op4_warc": warc_zip.op4_warc,
    "op5_minhash_dedup": minhash_dedup.op5_minhash_dedup,
    "op6_sentence_spans": sentence_spans.op6_sentence_spans,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op10_hnsw": hnsw.op10_hnsw,
    "op8_piece_transducer": piece_transducer.op8_piece_transducer,
    "op9_quality_rules": quality_rules.op9_quality_rules,
}

SQL = {
    "op4_warc": warc_zip.ORACLE,
    "op5_minhash_dedup": minhash_dedup.ORACLE,
    "op7_line_dedup": line_dedup.ORACLE,
    "op9_quality_rules": quality_rules.ORACLE,
}
