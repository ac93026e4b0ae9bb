"""The queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm.best_fit import op12_best_fit_packing
from tidewell.llm.bpe import op9_bpe_round_trip
from tidewell.llm.chunk_store import op4_chunk_store
from tidewell.llm.jaccard_join import op1_jaccard_join
from tidewell.llm.oracles import OP1_SQL, OP2_SQL, OP7_SQL
from tidewell.llm.packing import op10_packing
from tidewell.llm.quality import op6_quality_rules
from tidewell.llm.secrets import op3_secret_scans
from tidewell.llm.suffix_dedup import op2_suffix_dedup
from tidewell.llm.substring_dedup import op7_substring_dedup
from tidewell.llm.toxicity import op5_toxicity
from tidewell.llm.top_k import OP8_SQL, op8_exact_top_k
from tidewell.llm.turn_repair import op13_conversation_repair
from tidewell.llm.whitening import op11_embedding_whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_jaccard_join, op2_suffix_dedup, op3_secret_scans, op4_chunk_store, op5_toxicity, op6_quality_rules, op7_substring_dedup, op8_exact_top_k, op9_bpe_round_trip, op10_packing, op11_embedding_whitening, op12_best_fit_packing, op13_conversation_repair)}


def oracle_sql() -> dict[str, str]:
    return {"op1_jaccard_join": OP1_SQL, "op2_suffix_dedup": OP2_SQL, "op7_substring_dedup": OP7_SQL, "op8_exact_top_k": OP8_SQL}
