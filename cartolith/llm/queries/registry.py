"""Names of the queries, and SQL where it can express them."""

from __future__ import annotations

from cartolith.llm.queries import dedup, licenses, models, pairs, substrings, tokens

QUERIES = {
    "op1_near_dedup": pairs.near,
    "op2_bpe_round_trip": tokens.bpe_round_trip,
    "op3_toxicity": models.toxicity,
    "op4_license_scan": licenses.licenses,
    "op5_exact_dedup": dedup.exact,
    "op6_decontamination": pairs.leaks,
    "op7_line_dedup": dedup.lines,
    "op8_token_counts": tokens.token_counts,
    "op9_quality": models.quality,
    "op10_substring_dedup": substrings.substrings,
}
SQL = {"op1_near_dedup": pairs.NEAR_SQL, "op5_exact_dedup": dedup.EXACT_SQL, "op7_line_dedup": dedup.LINES_SQL, "op10_substring_dedup": substrings.SQL}
