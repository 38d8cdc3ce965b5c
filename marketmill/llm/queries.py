"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from marketmill.llm import binary, decontam, merkle, neardup, periods, pii, quality, secret_scan, sentencepiece, substring, suffixes, toxicity, warc

QUERIES = {
    "op6_personal_data": pii.op6_personal_data,
    "op7_toxicity": toxicity.op7_toxicity,
    "op3_substring": substring.op3_substring,
    "op9_suffix_array": suffixes.op9_suffix_array,
    "op2_neardup": neardup.op2_neardup,
    "op4_token_ids": binary.op4_token_ids,
    "op1_sentencepiece": sentencepiece.op1_sentencepiece,
    "op5_decontamination": decontam.op5_decontamination,
    "op8_quality": quality.op8_quality,
    "op10_warc": warc.op10_warc,
    "op11_secret_scan": secret_scan.op11_secret_scan,
    "op12_period_runs": periods.op12_period_runs,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

SQL = {
    "op8_quality": quality.OP8_SQL,
    "op10_warc": warc.OP10_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}
