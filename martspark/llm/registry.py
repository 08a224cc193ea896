"""Queries of the training-data operators and their DuckDB SQL, by name."""

import corpus_pipeline
from martspark.llm import (centroids, ctw, decontaminate, exact_dedup, hilbert, jaccard_join, line_dedup,
                           mixing, odd_sketch, quality, token_files, url_filter, whitening)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_quality_classifier": quality.op2_quality_classifier,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_hilbert_shards": hilbert.op5_hilbert_shards,
    "op6_mix_sources": mixing.op6_mix_sources,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_token_files": token_files.op8_token_files,
    "op9_lm_scores": ctw.op9_lm_scores,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_whitening": whitening.op11_whitening,
    "op12_centroid_clusters": centroids.op12_centroid_clusters,
    "op13_odd_sketches": odd_sketch.op13_odd_sketches,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op1_line_dedup": line_dedup.SQL,
    "op3_jaccard_join": jaccard_join.SQL,
    "op4_exact_dedup": exact_dedup.SQL,
    "op5_hilbert_shards": hilbert.SQL,
    "op6_mix_sources": mixing.SQL,
    "op10_url_filter": url_filter.SQL,
    "op12_centroid_clusters": centroids.SQL,
    "op13_odd_sketches": odd_sketch.SQL,
}
