"""Names of the corpus queries, what runs them and their SQL where SQL can say it."""

from __future__ import annotations

from . import bpe, decontam, exact_dedup, language_model, license_scan, line_dedup, near_dedup, periodic, quality, token_files, toxicity, vector_codes, warc

QUERIES = {
    "op1_decontaminate": decontam.op1_decontaminate,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_language_model": language_model.op3_language_model,
    "op4_quality": quality.op4_quality,
    "op5_bpe": bpe.op5_bpe,
    "op6_near_dedup": near_dedup.op6_near_dedup,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_warc": warc.op8_warc,
    "op9_token_files": token_files.op9_token_files,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_license_scan": license_scan.op12_license_scan,
    "op13_periodic_runs": periodic.op13_periodic_runs,
}
SQL = {
    "op1_decontaminate": decontam.SQL,
    "op2_line_dedup": line_dedup.SQL,
    "op8_warc": warc.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
    "op11_vector_codes": vector_codes.SQL,
    "op12_license_scan": license_scan.SQL,
}
