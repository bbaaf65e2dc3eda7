"""Queries of the operators and their DuckDB SQL (where SQL can express them)."""

from __future__ import annotations

from .centroids import OP12_SQL, op12_centroids
from .exact_topk import OP10_SQL, op10_exact_topk
from .jaccard_join import op5_jaccard_join
from .kmeans_tree import op7_kmeans_tree
from .lattice_scores import op13_lattice_scores
from .merkle import OP11_SQL, op11_merkle_manifest
from .mixing import op2_soft_mixing
from .packing import op3_pattern_packing
from .quality import op9_quality
from .sharding import op8_best_fit_shards
from .suffix_dedup import op1_suffix_dedup
from .token_counts import op4_token_counts
from .token_files import op6_token_files

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_soft_mixing": op2_soft_mixing,
    "op3_pattern_packing": op3_pattern_packing,
    "op4_token_counts": op4_token_counts,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_token_files": op6_token_files,
    "op7_kmeans_tree": op7_kmeans_tree,
    "op8_best_fit_shards": op8_best_fit_shards,
    "op9_quality": op9_quality,
    "op10_exact_topk": op10_exact_topk,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_centroids": op12_centroids,
    "op13_lattice_scores": op13_lattice_scores,
}

ORACLE: dict[str, str] = {
    "op10_exact_topk": OP10_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_centroids": OP12_SQL,
}
