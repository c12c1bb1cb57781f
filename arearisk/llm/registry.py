"""Queries of the pipeline operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import chunkdedup, collocations, divergence, fmindex, hostpaths, huffman, langid, packing, ring, secret_scan, segjoin, toxicity, warc

QUERIES = {
    "op1_token_files": huffman.op1_token_files,
    "op2_sharding": ring.op2_sharding,
    "op3_packing": packing.op3_packing,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_html_extraction": hostpaths.op5_html_extraction,
    "op6_secrets": secret_scan.op6_secrets,
    "op7_language": langid.op7_language,
    "op8_exact_dedup": chunkdedup.op8_exact_dedup,
    "op9_ngram_join": segjoin.op9_ngram_join,
    "op10_decontamination": fmindex.op10_decontamination,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_warc": warc.op12_warc,
    "op13_collocations": collocations.op13_collocations,
}

ORACLE = {
    "op8_exact_dedup": chunkdedup.ORACLE_SQL,
    "op9_ngram_join": segjoin.ORACLE_SQL,
    "op10_decontamination": fmindex.ORACLE_SQL,
    "op11_source_divergence": divergence.ORACLE_SQL,
    "op12_warc": warc.ORACLE_SQL,
    "op13_collocations": collocations.ORACLE_SQL,
}
