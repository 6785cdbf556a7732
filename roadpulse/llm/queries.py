"""Registered queries of the subpackage, and SQL for those SQL can state."""

from __future__ import annotations

from roadpulse.llm.audit import OP13_SQL, op13_filter_audit
from roadpulse.llm.language import op10_language_id
from roadpulse.llm.leaks import OP3_SQL, op3_decontamination
from roadpulse.llm.licenses import op8_license_scan
from roadpulse.llm.lines import OP4_SQL, op4_line_dedup
from roadpulse.llm.lm import op11_lm_score
from roadpulse.llm.neardup import op1_near_dedup
from roadpulse.llm.neighbours import OP9_SQL, op9_nearest
from roadpulse.llm.packing import op5_packing
from roadpulse.llm.resample import OP12_SQL, op12_resample
from roadpulse.llm.substrings import op6_substring_dedup
from roadpulse.llm.toxicity import op7_toxicity
from roadpulse.llm.urls import OP2_SQL, op2_url_filter

QUERIES = {
    f.__name__: f
    for f in (
        op1_near_dedup,
        op2_url_filter,
        op3_decontamination,
        op4_line_dedup,
        op5_packing,
        op6_substring_dedup,
        op7_toxicity,
        op8_license_scan,
        op9_nearest,
        op10_language_id,
        op11_lm_score,
        op12_resample,
        op13_filter_audit,
    )
}
ORACLE = {
    "op2_url_filter": OP2_SQL,
    "op3_decontamination": OP3_SQL,
    "op4_line_dedup": OP4_SQL,
    "op9_nearest": OP9_SQL,
    "op12_resample": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
