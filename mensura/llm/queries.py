"""What this package registers: queries by name, and their DuckDB SQL."""

from __future__ import annotations

from . import chat, decontaminate, language, licenses, packing, pii, quality, repair, resample, setjoin, toxicity, warc, winnow

QUERIES = {
    "op1_jaccard_join": setjoin.op1_jaccard_join,
    "op2_pii": pii.op2_pii,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_chat_format": chat.op4_chat_format,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_quality": quality.op6_quality,
    "op7_warc": warc.op7_warc,
    "op8_pack": packing.op8_pack,
    "op9_licenses": licenses.op9_licenses,
    "op10_fingerprints": winnow.op10_fingerprints,
    "op11_language": language.op11_language,
    "op12_repair": repair.op12_repair,
    "op13_resample": resample.op13_resample,
}

ORACLE = {
    "op1_jaccard_join": setjoin.OP1_SQL,
    "op5_decontaminate": decontaminate.OP5_SQL,
    "op4_chat_format": chat.OP4_SQL,
    "op7_warc": warc.OP7_SQL,
    "op12_repair": repair.OP12_SQL,
    "op13_resample": resample.OP13_SQL,
}
