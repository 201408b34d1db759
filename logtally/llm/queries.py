"""The operators over their whole tables, and the SQL that must give the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logtally.llm.centroids import OP11_SQL, op11_centroid_clustering
from logtally.llm.chat import OP2_SQL, op2_chat_formatting
from logtally.llm.conversation_repair import OP12_SQL, op12_conversation_repair
from logtally.llm.decontamination import op7_benchmark_decontamination
from logtally.llm.exact_dedup import OP1_SQL, op1_exact_dedup
from logtally.llm.html_text import op10_html_extraction
from logtally.llm.lm_scoring import op8_lm_scoring
from logtally.llm.ngram_join import OP9_SQL, op9_ngram_jaccard_join
from logtally.llm.packing import op5_packing
from logtally.llm.private_data import op6_pii
from logtally.llm.quality import op3_quality_classifier
from logtally.llm.secrets import op4_secret_scans
from logtally.llm.toxicity import op13_toxicity

_ALL = (
    op1_exact_dedup,
    op2_chat_formatting,
    op3_quality_classifier,
    op4_secret_scans,
    op5_packing,
    op6_pii,
    op7_benchmark_decontamination,
    op8_lm_scoring,
    op9_ngram_jaccard_join,
    op10_html_extraction,
    op11_centroid_clustering,
    op12_conversation_repair,
    op13_toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _ALL}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": OP1_SQL,
        "op2_chat_formatting": OP2_SQL,
        "op9_ngram_jaccard_join": OP9_SQL,
        "op11_centroid_clustering": OP11_SQL,
        "op12_conversation_repair": OP12_SQL,
    }
