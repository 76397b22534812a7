"""Queries of this subpackage and, where SQL can state them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sliceforge.llm.ann import op1
from sliceforge.llm.bpe import op5
from sliceforge.llm.media import op8
from sliceforge.llm.packing import op10
from sliceforge.llm.preference import OP6_SQL, op6
from sliceforge.llm.quality import op3
from sliceforge.llm.secrets import op4
from sliceforge.llm.simhash import op9
from sliceforge.llm.substring import op7
from sliceforge.llm.toxicity import op2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": op1,
    "op2_toxicity": op2,
    "op3_quality": op3,
    "op4_secrets": op4,
    "op5_bpe": op5,
    "op6_preference": op6,
    "op7_substring_dedup": op7,
    "op8_media": op8,
    "op9_simhash": op9,
    "op10_packing": op10,
}

ORACLES: dict[str, str] = {
    "op6_preference": OP6_SQL,
}
