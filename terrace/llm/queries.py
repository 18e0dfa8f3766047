"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import op3_host_reputation, op4_substring_dedup, op5_license_scan, op6_decontaminate, op7_quality_rules, op13_rolling_windows
from .op1_kd_shards import op1_kd_shards
from .op2_suffix_tree import op2_suffix_tree_score
from .op8_mixing import op8_mixing
from .op9_simhash import op9_simhash_near_dedup
from .op10_wrappers import op10_main_text
from .op11_lsh_forest import op11_lsh_forest
from .op12_periodic_runs import op12_periodic_runs

QUERIES = {
    "op1_kd_shards": op1_kd_shards,
    "op2_suffix_tree_score": op2_suffix_tree_score,
    "op3_host_reputation": op3_host_reputation.op3_host_reputation,
    "op3b_planted_reputation": op3_host_reputation.op3b_planted_reputation,
    "op4_substring_dedup": op4_substring_dedup.op4_substring_dedup,
    "op5_license_scan": op5_license_scan.op5_license_scan,
    "op5b_planted_licences": op5_license_scan.op5b_planted_licences,
    "op6_decontaminate": op6_decontaminate.op6_decontaminate,
    "op6b_proximity": op6_decontaminate.op6b_proximity,
    "op7_quality_rules": op7_quality_rules.op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_main_text": op10_main_text,
    "op11_lsh_forest": op11_lsh_forest,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_rolling_windows": op13_rolling_windows.op13_rolling_windows,
}

#: The others aren't expressible in SQL; their tests hold them against brute force.
ORACLES = {
    "op3_host_reputation": op3_host_reputation.SQL,
    "op3b_planted_reputation": op3_host_reputation.PLANTED_SQL,
    "op4_substring_dedup": op4_substring_dedup.SQL,
    "op5_license_scan": op5_license_scan.SQL,
    "op5b_planted_licences": op5_license_scan.PLANTED_SQL,
    "op6_decontaminate": op6_decontaminate.SQL,
    "op6b_proximity": op6_decontaminate.PROXIMITY_SQL,
    "op7_quality_rules": op7_quality_rules.SQL,
    "op13_rolling_windows": op13_rolling_windows.SQL,
}
