"""The subpackage's registered queries."""

from pairforge.llm import decontaminate, html_text, lines, manifest, mixing, near_dups, quality, resampling, simhash, substrings, tokens, toxicity, warc

QUERIES = {
    "op1_html_text": html_text.query,
    "op2_quality_ledger": quality.query,
    "op3_mixing": mixing.query,
    "op4_toxicity": toxicity.query,
    "op5_line_dedup": lines.query,
    "op6_decontaminate": decontaminate.query,
    "op7_substring_dedup": substrings.query,
    "op8_near_dups": near_dups.query,
    "op9_warc": warc.query,
    "op10_token_files": tokens.query,
    "op11_simhash_dups": simhash.query,
    "op12_importance_resample": resampling.query,
    "op13_merkle_manifest": manifest.query,
}
