"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from tidemark.llm import (
    chat,
    decontaminate,
    fingerprints,
    hard_negatives,
    html_text,
    langid,
    license_scan,
    mixing,
    quality,
    secret_scan,
    simhash,
    substring_dedup,
    token_alignment,
)

QUERIES = {
    "op1_html": html_text.op1_html,
    "op2_quality": quality.op2_quality,
    "op3_simhash": simhash.op3_simhash,
    "op4_mixing": mixing.op4_mixing,
    "op5_fingerprints": fingerprints.op5_fingerprints,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_language": langid.op7_language,
    "op8_secrets": secret_scan.op8_secrets,
    "op9_licenses": license_scan.op9_licenses,
    "op10_chat": chat.op10_chat,
    "op11_alignment": token_alignment.op11_alignment,
    "op12_substrings": substring_dedup.op12_substrings,
    "op13_negatives": hard_negatives.op13_negatives,
}

ORACLES = {
    "op4_mixing": mixing.OP4_SQL,
    "op10_chat": chat.OP10_SQL,
    "op12_substrings": substring_dedup.OP12_SQL,
    "op13_negatives": hard_negatives.OP13_SQL,
}
