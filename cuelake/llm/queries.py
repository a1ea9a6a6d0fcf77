"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

from cuelake.llm import decontaminate, forest, hardneg, language, licenses, mixing, passes, preference, recompression, rindex, runs, secrets, simhash

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_preference": preference.op2_preference,
    "op3_licenses": licenses.op3_licenses,
    "op4_mixing": mixing.op4_mixing,
    "op5_language": language.op5_language,
    "op6_recompression": recompression.op6_recompression,
    "op7_rindex": rindex.op7_rindex,
    "op8_secrets": secrets.op8_secrets,
    "op9_simhash": simhash.op9_simhash,
    "op10_forest": forest.op10_forest,
    "op11_hard_negatives": hardneg.op11_hard_negatives,
    "op12_passes": passes.op12_passes,
    "op13_runs": runs.op13_runs,
}
CHECKS = {"op2_preference": preference.SQL, "op3_licenses": licenses.SQL, "op11_hard_negatives": hardneg.SQL, "op12_passes": passes.SQL}
