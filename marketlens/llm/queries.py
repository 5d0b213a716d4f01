"""Registered queries of this folder and their SQL."""

from __future__ import annotations

from . import (
    fingerprints,
    fixity,
    host_rules,
    jaccard,
    line_dedup,
    minhash,
    mixing,
    negatives,
    personal_data,
    pieces,
    spelling,
    substrings,
    toxicity,
)

QUERIES = {
    "op1_jaccard": jaccard.op1_jaccard,
    "op2_fixity": fixity.op2_fixity,
    "op3_mixing": mixing.op3_mixing,
    "op4_host_rules": host_rules.op4_host_rules,
    "op5_lines": line_dedup.op5_lines,
    "op6_fingerprints": fingerprints.op6_fingerprints,
    "op7_pieces": pieces.op7_pieces,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_substrings": substrings.op9_substrings,
    "op10_personal_data": personal_data.op10_personal_data,
    "op11_hard_negatives": negatives.op11_hard_negatives,
    "op12_spelling": spelling.op12_spelling,
    "op13_near_dedup": minhash.op13_near_dedup,
}
ORACLE = {"op2_fixity": fixity.SQL, "op9_substrings": substrings.SQL, "op1_jaccard": jaccard.SQL, "op3_mixing": mixing.SQL, "op4_host_rules": host_rules.SQL, "op11_hard_negatives": negatives.SQL, "op12_spelling": spelling.SQL, "op13_near_dedup": minhash.SQL}
