"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

from . import bpe, digest, filter_audit, hard_negatives, jaccard_join, language, mixing, neighbours, repeats, secret_scan, sentence_pieces, sharding, toxicity

QUERIES = {
    "op1_bpe": bpe.op1,
    "op2_repeats": repeats.op2,
    "op3_sharding": sharding.op3,
    "op4_secret_scan": secret_scan.op4,
    "op5_mixing": mixing.op5,
    "op6_language": language.op6,
    "op7_jaccard_join": jaccard_join.op7,
    "op8_toxicity": toxicity.op8,
    "op9_neighbours": neighbours.op9,
    "op10_fingerprints": digest.op10,
    "op11_hard_negatives": hard_negatives.op11,
    "op12_filter_audit": filter_audit.op12,
    "op13_sentence_pieces": sentence_pieces.op13,
}
ORACLE_SQL = {"op11_hard_negatives": hard_negatives.OP11_SQL, "op12_filter_audit": filter_audit.OP12_SQL, "op5_mixing": mixing.OP5_SQL, "op7_jaccard_join": jaccard_join.OP7_SQL}
