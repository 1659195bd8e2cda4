"""Queries of the dealt operators, one each over its whole table, and their SQL."""

from marginalia.llm import collocations, exact_dedup, jaccard_join, lm_score, mixing, near_vectors, packing, quality, repeated_passages, secret_scan, token_records, toxicity, vector_codes

QUERIES = {
    "op9_exact_dedup": exact_dedup.query,
    "op7_jaccard_join": jaccard_join.query,
    "op8_near_vectors": near_vectors.query,
    "op10_lm_score": lm_score.query,
    "op2_secret_scan": secret_scan.query,
    "op5_repeated_passages": repeated_passages.query,
    "op6_mixing": mixing.query,
    "op4_quality": quality.query,
    "op3_toxicity": toxicity.query,
    "op1_best_fit_packing": packing.query,
    "op11_vector_codes": vector_codes.query,
    "op12_token_records": token_records.query,
    "op13_collocations": collocations.query,
}

SQL = {
    "op9_exact_dedup": exact_dedup.SQL,
    "op2_secret_scan": secret_scan.SQL,
    "op11_vector_codes": vector_codes.SQL,
    "op13_collocations": collocations.SQL,
}
