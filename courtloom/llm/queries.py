"""One query per operator over the whole sample tables."""

from __future__ import annotations

from courtloom.llm import collocations, html, language_model, lines, manifest, packing, quality, sharding, sketches, templates, toxicity, urls, warc
from courtloom.llm.common import table

QUERIES = {
    "op1_tree_scoring": lambda spark, folder: html.op1_tree_scoring(table(spark, folder, "pages")),
    "op2_threshold_table": lambda spark, folder: quality.op2_threshold_table(table(spark, folder, "documents")),
    "op3_setsketch": lambda spark, folder: sketches.op3_setsketch(table(spark, folder, "documents")),
    "op4_pitman_yor": lambda spark, folder: language_model.op4_pitman_yor(table(spark, folder, "documents")),
    "op5_index_first": lambda spark, folder: warc.op5_index_first(spark, table(spark, folder, "pages")),
    "op6_templates": lambda spark, folder: templates.op6_templates(table(spark, folder, "documents"), table(spark, folder, "benchmark")),
    "op7_hash_tree": lambda spark, folder: sharding.op7_hash_tree(table(spark, folder, "documents")),
    "op8_best_fit": lambda spark, folder: packing.op8_best_fit(table(spark, folder, "documents")),
    "op9_fuzzy_lines": lambda spark, folder: lines.op9_fuzzy_lines(table(spark, folder, "documents")),
    "op10_windows": lambda spark, folder: toxicity.op10_windows(table(spark, folder, "documents"), table(spark, folder, "labels")),
    "op11_checkpoint_merkle": lambda spark, folder: manifest.op11_checkpoint_merkle(table(spark, folder, "documents")),
    "op12_phrase_automata": lambda spark, folder: collocations.op12_phrase_automata(table(spark, folder, "documents")),
    "op13_link_propagation": lambda spark, folder: urls.op13_link_propagation(table(spark, folder, "pages")),
}

ORACLE_SQL: dict[str, str] = {"op12_phrase_automata": collocations.ORACLE_SQL}
