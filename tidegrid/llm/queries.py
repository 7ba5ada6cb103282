"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

import corpus_pipeline
from tidegrid.llm import (
    bpe,
    decontaminate,
    dialogue,
    htmltext,
    neardup,
    pseudolm,
    quality,
    runs,
    sharding,
    tokencount,
    toxicity,
    urlfilter,
    warc,
)

QUERIES = {
    "op1_quality_rules": quality.op1,
    "op2_warc_salvage": warc.op2,
    "op3_near_dedup": neardup.op3,
    "op4_token_counts": tokencount.op4,
    "op5_toxicity": toxicity.op5,
    "op6_sharding": sharding.op6,
    "op7_lm_scoring": pseudolm.op7,
    "op8_decontaminate": decontaminate.op8,
    "op9_byte_bpe": bpe.op9,
    "op10_url_filters": urlfilter.op10,
    "op11_html_extraction": htmltext.op11,
    "op12_conversation_repair": dialogue.op12,
    "op13_periodic_runs": runs.op13,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_quality_rules": quality.op1_sql(),
    "op2_warc_salvage": warc.OP2_SQL,
    "op10_url_filters": urlfilter.OP10_SQL,
    "op11_html_extraction": htmltext.OP11_SQL,
}
