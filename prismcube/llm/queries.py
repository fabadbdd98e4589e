"""The operators' queries and their SQL, by name."""

from __future__ import annotations

from . import chat, decontaminate, embedding_dup, html_text, lexical, license_scan, mixing, near_dup, quality, secret_scan, spelling, token_counts, token_files

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_license_scan": license_scan.op2_license_scan,
    "op3_near_dup": near_dup.op3_near_dup,
    "op4_html_text": html_text.op4_html_text,
    "op5_quality": quality.op5_quality,
    "op6_token_files": token_files.op6_token_files,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_embedding_dup": embedding_dup.op8_embedding_dup,
    "op9_mix": mixing.op9_mix,
    "op10_chat": chat.op10_chat,
    "op11_lexical_search": lexical.op11_lexical_search,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_secret_scan": secret_scan.op13_secret_scan,
}

ORACLES = {
    "op3_near_dup": near_dup.OP3_SQL,
    "op4_html_text": html_text.OP4_SQL,
    "op7_decontaminate": decontaminate.OP7_SQL,
    "op8_embedding_dup": embedding_dup.OP8_SQL,
    "op9_mix": mixing.OP9_SQL,
    "op10_chat": chat.OP10_SQL,
    "op11_lexical_search": lexical.OP11_SQL,
    "op12_spelling_variants": spelling.OP12_SQL,
}
