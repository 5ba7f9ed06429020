"""Registered queries of this subpackage: one per operator, each over its whole
table with production parameters, and DuckDB statements where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op10_chunk_bpe
from .divergence import ORACLE_OP9, op9_divergence
from .feistel import op3_feistel_pii
from .hard_negatives import ORACLE_OP11, op11_hard_negatives
from .html_paths import op1_tag_path_ratios
from .lines import op8_line_dedup
from .maxscore import ORACLE_OP2, op2_maxscore
from .minhash import op12_minhash
from .packing import op5_best_fit_packing
from .runs import op13_periodic_runs
from .sharding import op4_external_shuffle
from .simhash import op7_simhash_pivots
from .urlfilter import op6_host_words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tag_path_ratios": op1_tag_path_ratios,
    "op2_maxscore": op2_maxscore,
    "op3_feistel_pii": op3_feistel_pii,
    "op4_external_shuffle": op4_external_shuffle,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_host_words": op6_host_words,
    "op7_simhash_pivots": op7_simhash_pivots,
    "op8_line_dedup": op8_line_dedup,
    "op9_divergence": op9_divergence,
    "op10_chunk_bpe": op10_chunk_bpe,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_minhash": op12_minhash,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op2_maxscore": ORACLE_OP2,
    "op9_divergence": ORACLE_OP9,
    "op11_hard_negatives": ORACLE_OP11,
}
