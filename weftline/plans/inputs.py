"""Inputs of the registered queries: the driver's tables dressed as inventories, results, endpoints and traces.

Every expression here is SQL that Spark and DuckDB read alike, so a query and its oracle start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _letter(divisor: int) -> str:
    return f"chr(CAST(97 + CAST(floor(p_partkey / {divisor}) AS BIGINT) % 26 AS INT))"


S, N = "CAST(p_size AS STRING)", "CAST(p_partkey % 30 + 1 AS STRING)"
CODE = f"{_letter(4)} || {_letter(104)} || {_letter(2704)}"
#: Parts come in fours that share CODE; in each RULED + FUZZY + PLAIN of them the first are are pairs made to meet one rule each, by their number.
PLAIN = 24
#: (catalog name, inventory name) after CODE; # is the part's size, ~ a digit that differs between the parts of a four.
RULED = (
    ("AGEON KIDS 100 MG SYRUP 60 ML", "AGEON ADULT 100mg syrup 60ml"),  # age group
    ("CLASSIA SHAMPOO 100 ML", "CLASSIA STRIP 100 ml"),  # product class
    ("ROUTEX I V # MG 10 AMP", "ROUTEX IM # mg 10 amp"),  # route
    ("QUANTOL # MG 10 TAB", "QUANTOL # mg 1~ tab"),  # quantity
    ("POWDREX POWDER 10 SACHETS", "POWDREX powder 1~ sachet"),  # quantity of a powder
    ("SYRUPEX SYRUP # ML", "SYRUPEX syrup 1~ ml"),  # volume of a syrup
    ("VOLUMIN # MG LOTION 100 ML", "VOLUMIN # mg lotion 12~ ml"),  # volume
    ("WEIGHTA CREAM 30 GM", "WEIGHTA cream 3~ gm"),  # weight
    (" INSULINAGYPT N 100 IU VIAL", " INSULINAGYPT R 100 iu vial"),  # insulin
    (" INSULINAGYPT 70/30 100 IU VIAL", " INSULINAGYPT 100 iu vial"),  # insulin mix
    ("FLAVORIN ORANGE 5 SACHETS", "FLAVORIN mint orange 5 sachet"),  # flavor, as a component
    ("COLORIN ORANGE 5 SACHETS", "COLORIN lemon 5 sachet"),  # flavor, as words
    ("OZOLAMINE # MG 10 TAB", "OZOLAMIN # mg 10tab"),  # brand by prefix
    ("BRANDOMIX # MG 10 TAB", "BRANDALOT # mg 10 tab"),  # brand
    ("DOSAMOL # MG 10 TAB", "DOSAMOL 9# mg 10 tab"),  # dosage
    ("SUMMIDOL 5/10 MG 10 TAB", "SUMMIDOL 15 mg 10 tab"),  # dosage as a sum
    ("RATEDOL 250 MG / 5 ML SYRUP 60 ML", "RATEDOL 250mg syrup 60 ml"),  # dosage per dose
    ("FORMIX # MG 10 TAB", "FORMIX # mg 10 supp"),  # form
    ("MODIFOL EXTRA # MG 10 TAB", "MODIFOL # mg 10 tab"),  # modifier
    ("INFANTOL INF DROPS 30 ML", "INFANTOL drops 30 ml"),  # pediatric INF
)
FUZZY = (
    ("ULTRAMEDICAL # MG 10 TAB", "ULTRAMEDICAL # mg 10tab"),
    ("SETTIMEDICAL # MG 10 TAB", "SETTIMEDICAL # mg 10 tab made in a new local factory"),  # token set
    ("PARTIMEDICAL # MG 10 TAB", "PARTIMEDICA # mg zz 10 tab"),
    ("SINGULARDOL", "SINGULARDOL"),  # partial token sort
    ("NOTHINGLIKE # MG 10 TAB", "ELSEWHERE 7 mg"),
)
_FOUR = f"CAST(floor(p_partkey / 4) AS BIGINT) % {len(RULED) + len(FUZZY) + PLAIN}"


def _of_four(which: int, plain: str) -> str:
    """A name by the four's number: a case's, or else `plain`."""
    shown = lambda text: "'" + text.replace("#", f"' || {S} || '").replace("~", "' || CAST(p_partkey % 4 AS STRING) || '") + "'"
    out = "CASE"
    for k, pair in enumerate((*RULED, *FUZZY)):
        # a fuzzy case's inventory name begins with another letter, so that no block holds both
        first = "'Q' || " if which and k >= len(RULED) else ""
        out += f" WHEN {_FOUR} = {k} THEN {first}{CODE} || {shown(pair[which])}"
    return f"{out} ELSE {plain} END"


PRODUCT = _of_four(0, f"""upper({CODE} || ' ' || p_name) || CASE p_partkey % 8
  WHEN 0 THEN ' ' || {S} || ' MG ' || {N} || ' TAB'
  WHEN 1 THEN ' ' || {S} || '.5MG ' || {N} || ' F.C.TABS'
  WHEN 2 THEN ' ' || {S} || ' MG / 5 ML SYRUP ' || {N} || '0 ML'
  WHEN 3 THEN ' CREAM ' || {S} || ' GM'
  WHEN 4 THEN ' PLUS ' || {S} || '/' || {N} || ' MG ' || {N} || ' CAPS'
  WHEN 5 THEN ' VAG. SUPP ' || {N} || ' SUPPS'
  WHEN 6 THEN ' ORANGE 1.000 IU ' || {N} || ' SACHETS'
  ELSE ' .5% EYE DROPS ' || {S} || 'ML' END""")
SPELLED = "CASE WHEN p_partkey % 5 = 0 THEN substr(p_name, 1, length(p_name) - 1) WHEN p_partkey % 13 = 0 THEN p_name || 'x' ELSE p_name END"
WANTED = _of_four(1, f"""CASE WHEN p_partkey % 35 = 0 THEN '+***IMP ' WHEN p_partkey % 77 = 0 THEN 'x' ELSE '' END || {CODE} || ' ' || {SPELLED} || CASE p_partkey % 8
  WHEN 0 THEN {S} || 'mg ' || {N} || 'tabs'
  WHEN 1 THEN ' ' || {S} || '.5 MG' || {N} || 'Tab'
  WHEN 2 THEN ' ' || {S} || 'MG/5ML syrup ' || {N} || '0ml'
  WHEN 3 THEN '-cream (' || {S} || 'gm)'
  WHEN 4 THEN ' plus ' || {S} || ' / ' || {N} || 'mg ' || {N} || ' cap'
  WHEN 5 THEN ' vaginal ' || {N} || ' supp'
  WHEN 6 THEN ' orange 1000iu ' || {N} || ' sachet'
  ELSE ' 0.5% eye drops ' || {S} || ' ml' END""")
PRICE_TEXT = "CASE WHEN p_partkey % 9 = 0 THEN '-' ELSE 'EGP ' || CAST(CAST(floor(p_retailprice * (1 + (p_partkey % 4) * 0.02)) AS BIGINT) AS STRING) END"

CATALOG = {"idx": "p_partkey", "product_name_ar": "p_brand", "product_name_en": PRODUCT, "store_product_id": "CAST(p_partkey AS STRING)", "price": "p_retailprice"}
INVENTORY = {"row_index": "p_partkey", "code": "CAST(p_partkey AS STRING)", "drug_name": WANTED, "drug_price": PRICE_TEXT}

#: Results of a run, made from orders.
SCORE = "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(60 + o_orderkey % 41 AS DOUBLE) END"
RESULTS = {
    "row_index": "o_orderkey",
    "code": "CAST(o_orderkey AS STRING)",
    "drug_name": "o_orderpriority",
    "matched_product_name_en": "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority || ' ' || o_orderstatus END",
    "matched_store_product_id": "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END",
    "match_score": SCORE,
    "verified": "CASE o_custkey % 6 WHEN 0 THEN 'ai_confirmed' WHEN 1 THEN 'ai_corrected' WHEN 2 THEN 'ai_found' WHEN 3 THEN 'ai_rejected' WHEN 4 THEN 'algo_match' ELSE NULL END",
    "match_method": "CASE WHEN o_orderkey % 5 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'no_match' ELSE 'too_short' END ELSE CASE o_orderkey % 4 WHEN 0 THEN 'component_index' WHEN 1 THEN 'brand_index' WHEN 2 THEN 'token_set_ratio' ELSE 'token_sort_ratio' END END",
    "ai_confidence": "CASE WHEN o_custkey % 6 < 4 THEN CAST((o_orderkey % 11) AS DOUBLE) / 10 END",
    "_ai_component_reason": "CASE WHEN o_orderkey % 17 = 0 THEN 'different_brand' WHEN o_orderkey % 19 = 0 THEN 'nan' ELSE '' END",
}
#: A later run of the same: some codes gone, some matches changed.
AFTER = RESULTS | {
    "matched_product_name_en": "CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE o_orderpriority || ' ' || o_orderstatus END",
    "matched_store_product_id": "CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE CAST(o_custkey + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS STRING) END",
}
AFTER_WHERE = "o_orderkey % 10 <> 3"

#: Endpoint attempts and their health, made from suppliers.
ATTEMPTS = {
    "provider": "CASE s_nationkey % 4 WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' WHEN 2 THEN 'gamma' ELSE 'delta' END",
    "key_suffix": "CAST(s_suppkey % 3 AS STRING)",
    "model": "s_name",
    "quality_rank": "CAST(s_suppkey % 9 + 1 AS INT)",
    "rotation_tier": "CAST(s_suppkey % 4 + 1 AS INT)",
    "latency": "s_acctbal / 100",
    "quota_remaining": "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal END",
    "eligible": "s_suppkey % 7 <> 0",
    "disabled_until": "CASE WHEN s_suppkey % 8 = 0 THEN '2030-01-01' ELSE '' END",
    "place": "CAST(s_suppkey + 1 AS INT)",
}
HEALTH = {
    "seq": "s_suppkey",
    "provider": ATTEMPTS["provider"],
    "key_suffix": ATTEMPTS["key_suffix"],
    "model": "s_name",
    "mode": "CASE WHEN s_suppkey % 10 = 9 THEN 'text' ELSE 'json' END",
    "ok": "s_suppkey % 3 = 0",
    "rotation_tier": ATTEMPTS["rotation_tier"],
    "quality_rank": ATTEMPTS["quality_rank"],
    "elapsed_s": "CAST(s_suppkey % 25 AS DOUBLE)",
    "http_status": "CASE s_suppkey % 11 WHEN 1 THEN '429' WHEN 2 THEN '403' WHEN 4 THEN '404' ELSE '200' END",
    "error_type": "CASE s_suppkey % 11 WHEN 5 THEN 'TimeoutError' WHEN 7 THEN 'invalid_json' WHEN 8 THEN 'missing_fields:reason' WHEN 10 THEN '' ELSE 'other' END",
    "error_message": "CASE WHEN s_suppkey % 13 = 0 THEN 'Model DOES NOT exist' ELSE '' END",
    "rate_remaining_requests": "CASE WHEN s_suppkey % 2 = 0 THEN CAST(CAST(floor(s_acctbal) AS BIGINT) AS STRING) ELSE '' END",
    "quota_remaining_day": "CASE WHEN s_suppkey % 5 = 1 THEN '1.5K' WHEN s_suppkey % 5 = 2 THEN 'n/a' ELSE NULL END",
    "quota_remaining_minute": "CASE WHEN s_suppkey % 4 = 1 THEN '1,200' ELSE NULL END",
    "rate_remaining_tokens": "CASE WHEN s_suppkey % 4 = 3 THEN '2M' ELSE NULL END",
}
TESTED = "s_suppkey % 6 <> 5"

#: Trace events, made from events: a drug is a user.
EVENTS = {
    "seq": "event_id",
    "drug_code": "CASE WHEN user_id % 50 = 7 THEN '' ELSE CAST(user_id AS STRING) END",
    "drug_name": "CASE WHEN user_id % 50 = 7 THEN '' ELSE 'drug ' || CAST(user_id AS STRING) END",
    "step": "CASE event_id % 6 WHEN 0 THEN 'final' WHEN 1 THEN 'ai_verify_result' WHEN 2 THEN 'ai_search_result' WHEN 3 THEN 'component_check' WHEN 4 THEN 'ai_review_result' ELSE 'brand_lookup' END",
    "decision": "CASE WHEN event_id % 6 = 3 AND event_id % 4 = 1 THEN 'rejected' ELSE event_type END",
    "reject_rule": "CASE WHEN event_id % 6 = 3 AND event_id % 5 = 0 THEN 'different_form' ELSE NULL END",
    "error_stage": "CASE WHEN event_id % 12 = 3 THEN 'component' ELSE '' END",
    "error_code": "CASE WHEN event_id % 18 = 3 THEN 'different_dosage' ELSE NULL END",
    "selection_reason": "event_type",
    "candidate_name": "CASE WHEN event_id % 4 = 3 THEN 'candidate ' || CAST(event_id % 100 AS STRING) ELSE '' END",
    "final_match": "CASE WHEN event_id % 6 = 0 THEN CASE WHEN event_id % 4 = 0 THEN 'NONE' ELSE 'product ' || CAST(event_id % 50 AS STRING) END ELSE '' END",
    "ai_result": "CASE event_id % 6 WHEN 1 THEN CASE event_id % 5 WHEN 0 THEN 'ai_rejected' WHEN 1 THEN 'ai_corrected' ELSE 'ai_confirmed' END WHEN 2 THEN CASE event_id % 3 WHEN 0 THEN 'not_found' ELSE 'ai_found' END WHEN 4 THEN CASE event_id % 4 WHEN 0 THEN 'ai_found_reviewed' WHEN 1 THEN 'ai_rejected_kept_low_confidence_review' WHEN 2 THEN 'ai_rejected_reviewed' ELSE 'ai_review_corrected' END ELSE '' END",
    "provider_used": "CASE WHEN event_id % 9 = 4 THEN 'alpha' ELSE '' END",
    "model_used": "CASE WHEN event_id % 9 = 4 THEN 'm' || CAST(event_id % 3 AS STRING) ELSE NULL END",
    "ai_model": "CASE WHEN event_id % 9 = 5 THEN 'first' ELSE '' END",
}

#: Verdicts of models on labelled cases, made from labels.
CASES = {"model": "'m' || CAST(doc_id % 5 AS STRING)", "expected": "quality = 1", "got": "(quality + CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END) % 2 = 1", "api_failed": "doc_id % 11 = 0"}

#: Replies of a model, made from events.
REPLY = """CASE event_id % 8
  WHEN 0 THEN '{"is_correct": true, "reason": "same", "confidence": 0.9}'
  WHEN 1 THEN 'Sure: ```json {"is_correct": false, "reason": "form", "confidence": 0.8} ``` done'
  WHEN 2 THEN 'I think {"is_correct": true, "reason": "r' || CAST(event_id % 10 AS STRING) || '", "confidence": 0.5} is right'
  WHEN 3 THEN '{"is_correct": true, "reason": "cut", "confidence": 0.7'
  WHEN 4 THEN '{"is_correct": false, "confidence": 0.6, "reason": "cut off he'
  WHEN 5 THEN 'no json here'
  WHEN 6 THEN '12'
  ELSE '{"is_correct": TRUE, "reason": "loud", "confidence": .3, oops' END"""


def columns(named: dict[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in named.items()]


def select(named: dict[str, str], source: str, where: str | None = None) -> str:
    return f"SELECT {', '.join(columns(named))} FROM {source}" + (f" WHERE {where}" if where else "")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*columns(CATALOG))


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*columns(INVENTORY))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*columns(RESULTS))


def later_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(AFTER_WHERE).selectExpr(*columns(AFTER))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(*columns(ATTEMPTS))


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").where(TESTED).selectExpr(*columns(HEALTH))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*columns(EVENTS))
