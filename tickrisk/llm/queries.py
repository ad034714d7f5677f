"""Registered queries of this subpackage: opN_<name> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from tickrisk.llm.bitpack import op8_token_bitpack
from tickrisk.llm.byte_bpe import op9_byte_bpe
from tickrisk.llm.chunks import op3_substring_dedup
from tickrisk.llm.collisions import ORACLE as LINKS_SQL
from tickrisk.llm.collisions import op2_collision_neardup
from tickrisk.llm.decontaminate import ORACLE as DECONTAMINATION_SQL
from tickrisk.llm.decontaminate import op11_winnowing_decontamination
from tickrisk.llm.packing import op10_best_fit_packing
from tickrisk.llm.quality import op1_quality_rules
from tickrisk.llm.runs import op13_periodic_runs
from tickrisk.llm.secrets import op7_secret_scan
from tickrisk.llm.setsketch import ORACLE as NEAR_DUPLICATES_SQL
from tickrisk.llm.setsketch import op5_setsketch_neardup
from tickrisk.llm.spelling import op12_gram_spelling
from tickrisk.llm.suffixes import ORACLE as REPEATS_SQL
from tickrisk.llm.suffixes import op6_induced_suffix_dedup
from tickrisk.llm.urls import op4_url_filter

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_collision_neardup": op2_collision_neardup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_setsketch_neardup": op5_setsketch_neardup,
    "op6_induced_suffix_dedup": op6_induced_suffix_dedup,
    "op7_secret_scan": op7_secret_scan,
    "op8_token_bitpack": op8_token_bitpack,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_winnowing_decontamination": op11_winnowing_decontamination,
    "op12_gram_spelling": op12_gram_spelling,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op2_collision_neardup": LINKS_SQL,
    "op5_setsketch_neardup": NEAR_DUPLICATES_SQL,
    "op6_induced_suffix_dedup": REPEATS_SQL,
    "op11_winnowing_decontamination": DECONTAMINATION_SQL,
}
