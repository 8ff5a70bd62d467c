"""Queries of this folder by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftmart.llm.decontaminate import op1_decontaminate
from weftmart.llm.minhash import op6_minhash
from weftmart.llm.suffix_dedup import op9_suffix_dedup
from weftmart.llm.imatch import op10_imatch
from weftmart.llm.mixing import op3_mixing
from weftmart.llm.pages import op8_page_text
from weftmart.llm.toxicity import op2_toxicity
from weftmart.llm.cotrain import op5_cotraining
from weftmart.llm.pii import op7_pii
from weftmart.llm.alignment import op11_alignment
from weftmart.llm.chat import op4_chat
from weftmart.llm.language_model import op12_language_model
from weftmart.llm.spelling import op13_spelling
from weftmart.session import configure

BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op6_minhash": op6_minhash,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_imatch": op10_imatch,
    "op3_mixing": op3_mixing,
    "op8_page_text": op8_page_text,
    "op2_toxicity": op2_toxicity,
    "op5_cotraining": op5_cotraining,
    "op7_pii": op7_pii,
    "op4_chat": op4_chat,
    "op11_alignment": op11_alignment,
    "op12_language_model": op12_language_model,
    "op13_spelling": op13_spelling,
}

ORACLES: dict[str, str] = {}


def _configured(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(configure(spark), sf_dir.rstrip("/"))


LLM_QUERIES = {name: _configured(build) for name, build in BUILDERS.items()}
