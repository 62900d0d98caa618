"""The training-data queries, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from utterlake.llm.byte_bpe import op10_byte_bpe
from utterlake.llm import collocations, filter_audit, license_scan
from utterlake.llm.html_text import op8_html_text
from utterlake.llm.media_store import op3_media_columns
from utterlake.llm.near_dup import op1_near_dup
from utterlake.llm.packing import op5_best_fit_packing
from utterlake.llm.pii import op7_pii
from utterlake.llm.quality_crf import op6_quality_crf
from utterlake.llm.quality_rules import op9_quality_rules
from utterlake.llm.toxicity import op2_toxicity
from utterlake.llm.warc import op12_warc

QUERIES = {
    "op1_near_dup": op1_near_dup,
    "op2_toxicity": op2_toxicity,
    "op3_media_columns": op3_media_columns,
    "op4_license_scan": license_scan.op4_license_scan,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_quality_crf": op6_quality_crf,
    "op7_pii": op7_pii,
    "op8_html_text": op8_html_text,
    "op9_quality_rules": op9_quality_rules,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_collocations": collocations.op11_collocations,
    "op12_warc": op12_warc,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

ORACLES: dict[str, str] = {
    "op4_license_scan": license_scan.ORACLE_SQL,
    "op11_collocations": collocations.ORACLE_SQL,
    "op13_filter_audit": filter_audit.ORACLE_SQL,
}
