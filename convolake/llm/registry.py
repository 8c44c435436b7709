"""The queries of this folder and their SQL."""

from __future__ import annotations

from convolake.llm import infill, licenses, quality
from convolake.llm.decontaminate import op4_decontamination
from convolake.llm.infill import op13_fill_in_middle
from convolake.llm.languages import op11_language_mixtures
from convolake.llm.licenses import op10_license_scans
from convolake.llm.line_dups import op7_line_dedup
from convolake.llm.near_dups import op8_near_duplicates
from convolake.llm.pieces import op5_sentence_pieces
from convolake.llm.pii import op1_pii
from convolake.llm.quality import op6_quality_rules
from convolake.llm.records import op3_token_records
from convolake.llm.repeats import op9_repeated_passages
from convolake.llm.toxicity import op2_toxicity
from convolake.llm.whitening import op12_embedding_whitening


def queries() -> dict:
    return {f.__name__: f for f in (op1_pii, op2_toxicity, op3_token_records, op4_decontamination, op5_sentence_pieces, op6_quality_rules, op7_line_dedup, op8_near_duplicates, op9_repeated_passages, op10_license_scans, op11_language_mixtures, op12_embedding_whitening, op13_fill_in_middle)}


def oracle_sql() -> dict[str, str]:
    return {"op6_quality_rules": quality.ORACLE, "op10_license_scans": licenses.ORACLE, "op13_fill_in_middle": infill.ORACLE}
