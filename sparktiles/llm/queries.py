"""The queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from .fingerprints import op1_fingerprints
from .graph_dedup import OP9_SQL, op9_graph_dedup
from .hard_negatives import OP13_SQL, op13_hard_negatives
from .langid import op7_language_id
from .lexical_search import OP11_SQL, op11_lexical_search
from .merge_automaton import op12_merge_automaton
from .mixing import OP6_SQL, op6_source_mix
from .neardup import op8_near_duplicates
from .pieces import op4_sampled_pieces
from .quality import op5_quality_rules
from .suffix_dedup import OP2_SQL, op2_suffix_dedup
from .toxicity import op3_toxicity
from .token_files import op10_token_files

QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [op1_fingerprints, op2_suffix_dedup, op3_toxicity, op4_sampled_pieces, op5_quality_rules, op6_source_mix, op7_language_id, op8_near_duplicates, op9_graph_dedup, op10_token_files, op11_lexical_search, op12_merge_automaton, op13_hard_negatives]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {run.__name__: run for run in QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op2_suffix_dedup": OP2_SQL, "op6_source_mix": OP6_SQL, "op9_graph_dedup": OP9_SQL, "op11_lexical_search": OP11_SQL, "op13_hard_negatives": OP13_SQL}
