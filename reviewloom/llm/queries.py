"""Queries of this subpackage, and the same results in SQL where SQL can express them."""

from __future__ import annotations

from reviewloom.llm import (
    bpe, chat_format, decontaminate, exact_dedup, fill_middle, near_dedup, periodic_runs, quality, repeated_spans, secrets, token_files, toxicity, warc,
)

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_near_dedup": near_dedup.op2_near_dedup,
    "op3_repeated_spans": repeated_spans.op3_repeated_spans,
    "op4_secrets": secrets.op4_secrets,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_token_files": token_files.op6_token_files,
    "op7_warc": warc.op7_warc,
    "op8_decontamination": decontaminate.op8_decontamination,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_bpe": bpe.op10_bpe,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_fill_in_middle": fill_middle.op12_fill_in_middle,
    "op13_chat_format": chat_format.op13_chat_format,
}

SQL = {
    "op2_near_dedup": near_dedup.OP2_SQL,
    "op7_warc": warc.OP7_SQL,
    "op8_decontamination": decontaminate.OP8_SQL,
    "op9_exact_dedup": exact_dedup.OP9_SQL,
    "op12_fill_in_middle": fill_middle.OP12_SQL,
    "op13_chat_format": chat_format.OP13_SQL,
}
