"""Queries of the corpus operators: name to function and, where SQL can express one, to DuckDB SQL."""

from __future__ import annotations

from . import codes, decontamination, embeddings, jaccard, language, mixing, pii, ppm, secrets, sharding, suffixes, toxicity, whitening

QUERIES = {
    "op1_pii_surrogates": pii.op1,
    "op2_language_id": language.op2,
    "op3_ppm_scores": ppm.op3,
    "op4_toxicity": toxicity.op4,
    "op5_decontaminate": decontamination.op5,
    "op6_mix_sources": mixing.op6,
    "op7_shard_documents": sharding.op7,
    "op8_jaccard_join": jaccard.op8,
    "op9_secret_scan": secrets.op9,
    "op10_embedding_dedup": embeddings.op10,
    "op11_repeated_windows": suffixes.op11,
    "op12_whitening": whitening.op12,
    "op13_vector_codes": codes.op13,
}

SQL = {
    "op6_mix_sources": mixing.OP6_SQL,
    "op7_shard_documents": sharding.OP7_SQL,
    "op13_vector_codes": codes.OP13_SQL,
}
