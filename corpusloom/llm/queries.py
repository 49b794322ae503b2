"""The operators' queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontaminate import OP9_SQL, op9_decontamination
from .language import op4_language
from .mixing import op5_entropy_mix
from .neighbours import OP6_SQL, op6_block_neighbours
from .pii import op2_skip_chain_pii
from .quality import op8_quality
from .runindex import op7_run_index_dedup
from .secrets import OP10_SQL, op10_secret_ledger
from .setsketch import OP3_SQL, op3_setsketch_dedup
from .toxicity import op1_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_skip_chain_pii": op2_skip_chain_pii,
    "op3_setsketch_dedup": op3_setsketch_dedup,
    "op4_language": op4_language,
    "op5_entropy_mix": op5_entropy_mix,
    "op6_block_neighbours": op6_block_neighbours,
    "op7_run_index_dedup": op7_run_index_dedup,
    "op8_quality": op8_quality,
    "op9_decontamination": op9_decontamination,
    "op10_secret_ledger": op10_secret_ledger,
}
ORACLES: dict[str, str] = {"op3_setsketch_dedup": OP3_SQL, "op6_block_neighbours": OP6_SQL, "op9_decontamination": OP9_SQL, "op10_secret_ledger": OP10_SQL}
