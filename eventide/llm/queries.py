"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from . import (bpe, decontam, exact_dedup, minhash, periodic, pii, quality, sharding, suffix, superkmer, tokens, trie,
               warc)

QUERIES = {
    "op1_suffix_dedup": suffix.op1_suffix_dedup,
    "op2_minhash": minhash.op2_minhash,
    "op3_decontamination": decontam.op3_decontamination,
    "op4_shard_shuffle": sharding.op4_shard_shuffle,
    "op5_token_counts": tokens.op5_token_counts,
    "op6_warc": warc.op6_warc,
    "op7_pii": pii.op7_pii,
    "op8_bpe_round_trip": bpe.op8_bpe_round_trip,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_quality": quality.op10_quality,
    "op11_superkmer_dedup": superkmer.op11_superkmer_dedup,
    "op12_prefix_trie": trie.op12_prefix_trie,
    "op13_periodic_runs": periodic.op13_periodic_runs,
}

SQL = {
    "op3_decontamination": decontam.SQL,
    "op6_warc": warc.SQL,
    "op9_exact_dedup": exact_dedup.SQL,
    "op11_superkmer_dedup": superkmer.SQL,
    "op12_prefix_trie": trie.SQL,
}
