"""The scalar functions and the parse for SQL users: temporary functions and views of a session.

`weft_normalize(name)` and `weft_price(text)` are SQL expressions, which Catalyst inlines; the four ratios are Arrow
functions. A parse has many columns, so it is a view of a view: components_view(); verdict_view() judges pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import SparkSession

from weftline.functions import similarity, vocab as V
from weftline.functions.names import with_components
from weftline.functions.pricing import DIGITS_FROM, DIGITS_TO

RATIOS = {"weft_ratio": "ratio_udf", "weft_token_sort_ratio": "token_sort_udf", "weft_token_set_ratio": "token_set_udf", "weft_partial_token_sort_ratio": "partial_token_sort_udf"}


def _raw(text: str) -> str:
    return "r'" + text + "'"


def normalize_sql(name: str) -> str:
    """names.normalized() as SQL text."""
    start = f"upper(regexp_replace(coalesce({name}, ''), {_raw(r'(?U)^\s+|\s+$')}, ''))"
    return reduce(lambda sql, rule: f"regexp_replace({sql}, {_raw(rule[0])}, {_raw(rule[1])})", V.NORMAL_RULES, start)


def price_sql(text: str) -> str:
    """pricing.parsed_price() as SQL text."""
    number = f"try_cast(regexp_replace(translate({text}, '{DIGITS_FROM}', '{DIGITS_TO}'), '[^0-9.]', '') AS DOUBLE)"
    return f"CASE WHEN {number} > 0 THEN {number} END"


def register(spark: SparkSession) -> None:
    """The functions, for this session."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION weft_normalize(name STRING) RETURNS STRING RETURN {normalize_sql('name')}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION weft_price(value STRING) RETURNS DOUBLE RETURN {price_sql('value')}")
    for name, function in RATIOS.items():
        spark.udf.register(name, getattr(similarity, function))


def components_view(spark: SparkSession, table: str, name: str, view: str, prefix: str = "") -> None:
    """`view`: the rows of `table` with the components of column `name`."""
    with_components(spark.table(table), name, prefix).createOrReplaceTempView(view)


def verdict_view(spark: SparkSession, table: str, view: str, left: str = "d_", right: str = "m_") -> None:
    """`view`: pairs with components on both sides, and `reason`: 'ok' or what speaks against the pair."""
    from weftline.operators.compat import verdict

    verdict(spark.table(table), left, right).createOrReplaceTempView(view)
