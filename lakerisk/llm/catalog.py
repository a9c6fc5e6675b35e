"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from lakerisk.llm import collocations, decontamination, hmm, html, language, line_rules, mixing, ngram_join, passages, quality, repair, superminhash, toxicity

QUERIES = {
    "op1_quality": quality.query,
    "op2_language": language.query,
    "op3_decontamination": decontamination.query,
    "op4_mixing": mixing.query,
    "op5_ngram_join": ngram_join.query,
    "op6_hmm": hmm.query,
    "op7_html": html.query,
    "op8_line_rules": line_rules.query,
    "op9_toxicity": toxicity.query,
    "op10_passages": passages.query,
    "op11_collocations": collocations.query,
    "op12_repair": repair.query,
    "op13_superminhash": superminhash.query,
}

ORACLE = {
    "op5_ngram_join": ngram_join.SQL,
    "op8_line_rules": line_rules.SQL,
    "op11_collocations": collocations.SQL,
    "op12_repair": repair.SQL,
    "op13_superminhash": superminhash.SQL,
}
