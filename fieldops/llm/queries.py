"""Queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from fieldops.llm import (
    adaptive_quality, collision_ann, host_consensus, license_scan, line_chunks, markov_secrets, mixture_packing, periodic_runs, spelling_variants,
    tensor_minhash, unigram_codec, warc_salvage, weak_toxicity,
)

QUERIES = {
    "op1_host_consensus": host_consensus.op1_host_consensus,
    "op2_collision_ann": collision_ann.op2_collision_ann,
    "op3_markov_secrets": markov_secrets.op3_markov_secrets,
    "op4_unigram_codec": unigram_codec.op4_unigram_codec,
    "op5_line_chunks": line_chunks.op5_line_chunks,
    "op6_warc_salvage": warc_salvage.op6_warc_salvage,
    "op7_tensor_minhash": tensor_minhash.op7_tensor_minhash,
    "op8_adaptive_quality": adaptive_quality.op8_adaptive_quality,
    "op9_weak_toxicity": weak_toxicity.op9_weak_toxicity,
    "op10_mixture_packing": mixture_packing.op10_mixture_packing,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_license_scan": license_scan.op12_license_scan,
    "op13_spelling_variants": spelling_variants.op13_spelling_variants,
}

#: Operators that SQL can express; the others are tested against brute force, round trips or held-out labels.
ORACLE = {
    "op5_line_chunks": line_chunks.ORACLE,
    "op6_warc_salvage": warc_salvage.ORACLE,
    "op7_tensor_minhash": tensor_minhash.ORACLE,
    "op8_adaptive_quality": adaptive_quality.ORACLE,
    "op12_license_scan": license_scan.ORACLE,
}
