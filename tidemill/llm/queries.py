"""The corpus operators' queries and, where SQL can express them, their oracles in DuckDB SQL."""

from __future__ import annotations

from tidemill.llm import bpe, fingerprint, jaccard, mixing, pages, pii, quality, secrets, suffix, toxicity

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_jaccard": jaccard.op3_jaccard,
    "op4_pages": pages.op4_pages,
    "op5_secrets": secrets.op5_secrets,
    "op6_mixing": mixing.op6_mixing,
    "op7_bpe": bpe.op7_bpe,
    "op8_fingerprint": fingerprint.op8_fingerprint,
    "op9_quality": quality.op9_quality,
    "op10_suffix": suffix.op10_suffix,
}

ORACLES: dict[str, str] = {}
