"""The operators as queries over the given tables, with the SQL of those that SQL can express."""

from __future__ import annotations

from stocklens.llm import (chat, decontaminate, fill_middle, fingerprint, language_model, manifest, mixing, neardup, packing, quality, rules,
                           toxicity, warc)

QUERIES = {
    "op1_mixing": mixing.query,
    "op2_quality": quality.query,
    "op3_warc": warc.query,
    "op4_near_duplicates": neardup.query,
    "op5_language_model": language_model.query,
    "op6_chat": chat.query,
    "op7_toxicity": toxicity.query,
    "op8_decontamination": decontaminate.query,
    "op9_packing": packing.query,
    "op10_fingerprint": fingerprint.query,
    "op11_manifest": manifest.query,
    "op12_quality_rules": rules.query,
    "op13_fill_middle": fill_middle.query,
}

ORACLE = {
    "op3_warc": warc.SQL,
    "op4_near_duplicates": neardup.SQL,
    "op6_chat": chat.SQL,
    "op8_decontamination": decontaminate.SQL,
    "op11_manifest": manifest.SQL,
    "op12_quality_rules": rules.SQL,
    "op13_fill_middle": fill_middle.SQL,
}
