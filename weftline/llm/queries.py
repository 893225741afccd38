"""The training-data queries and, where SQL can express one, its DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftline.llm.chat import OP1_SQL, op1_chat
from weftline.llm.jaccard import op9_jaccard
from weftline.llm.language import op7_language
from weftline.llm.media import op4_media
from weftline.llm.mixing import OP5_SQL, op5_mix
from weftline.llm.packing import op3_pack
from weftline.llm.scoring import op2_lm
from weftline.llm.search import OP10_SQL, op10_search
from weftline.llm.suffixes import op6_suffix
from weftline.llm.token_orc import op8_token_orc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat": op1_chat,
        "op2_lm": op2_lm,
        "op3_pack": op3_pack,
        "op4_media": op4_media,
        "op5_mix": op5_mix,
        "op6_suffix": op6_suffix,
        "op7_language": op7_language,
        "op8_token_orc": op8_token_orc,
        "op9_jaccard": op9_jaccard,
        "op10_search": op10_search,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_chat": OP1_SQL, "op5_mix": OP5_SQL, "op10_search": OP10_SQL}
