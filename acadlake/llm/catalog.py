"""Registered queries of the training-data operators (name -> builder) and their DuckDB statements."""

from acadlake.llm import (
    chat, codes, decontam, exact_dedup, fim, language, lm, mixing, secrets, simhash, topk, toxicity, urls,
)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_language_id": language.op2_language_id,
    "op3_topk_search": topk.op3_topk_search,
    "op4_decontamination": decontam.op4_decontamination,
    "op5_simhash_dedup": simhash.op5_simhash_dedup,
    "op6_lm_scoring": lm.op6_lm_scoring,
    "op7_secret_scans": secrets.op7_secret_scans,
    "op8_url_filters": urls.op8_url_filters,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_chat_formatting": chat.op10_chat_formatting,
    "op11_fill_in_middle": fim.op11_fill_in_middle,
    "op12_vector_codes": codes.op12_vector_codes,
    "op13_exact_dedup": exact_dedup.op13_exact_dedup,
}

ORACLES = {
    "op3_topk_search": topk.ORACLE,
    "op4_decontamination": decontam.ORACLE,
    "op7_secret_scans": secrets.ORACLE,
    "op8_url_filters": urls.ORACLE,
    "op10_chat_formatting": chat.ORACLE,
    "op11_fill_in_middle": fim.ORACLE,
    "op12_vector_codes": codes.ORACLE,
    "op13_exact_dedup": exact_dedup.ORACLE,
}
