"""Registered queries over the driver's tables and, where SQL can express one, its DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import replies as R
from weftline.functions.names import normalized, normalized_arabic
from weftline.functions.pricing import formatted_price, parsed_price, price_bonus, price_delta_text
from weftline.functions.similarity import partial_token_sort_udf, ratio_udf, token_set_udf, token_sort_udf
from weftline.operators import audit, decide, endpoints, matching, review, rotation, trace
from weftline.operators.blocking import component_pairs, prefix_pairs
from weftline.operators.compat import verdict
from weftline.operators.config import Matching
from weftline.plans import inputs as I
from weftline.plans import oracle_names as O
from weftline.sources.tables import REVIEW_BLANKS, manual_review, public, row_slice, scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
CFG = Matching()
LISTS = ("dosage_nums", "brand_keys", "words")


def query(oracle: str | None = None):
    """Register a function under its name, with its oracle."""

    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return keep


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parsed inventory and catalog, written: a parse is built once, however often its columns are used."""
    left, right = matching.spread(I.inventory(spark, sf_dir)), matching.spread(I.catalog(spark, sf_dir))
    return scratch(matching.parsed_inventory(left), "inventory"), scratch(matching.parsed_catalog(right), "catalog")


def _piped(c: str) -> Column:
    return F.array_join(c, "|")


# ---- names, prices, similarity --------------------------------------------------------------------


@query(f"SELECT idx, {O.normalized('product_name_en')} AS normalized FROM ({I.select(I.CATALOG, 'part')}) UNION ALL SELECT -1 - row_index, {O.normalized('drug_name')} FROM ({I.select(I.INVENTORY, 'part')})")
def q_normalize(spark, sf_dir):
    cat, inv = I.catalog(spark, sf_dir), I.inventory(spark, sf_dir)
    return cat.select("idx", normalized(F.col("product_name_en")).alias("normalized")).unionByName(inv.select((-1 - F.col("row_index")).alias("idx"), normalized(F.col("drug_name")).alias("normalized")))


ARABIC = "'  أَدوية إِلى-' || CAST(p_partkey AS STRING) || ' (مؤسسة) ة ئ' || p_brand"


@query(
    f"SELECT p_partkey, trim(regexp_replace(regexp_replace(translate(regexp_replace(trim({ARABIC}), '[ً-ٰٟ]', '', 'g'), 'إأآٱىؤئة', 'اااايويه'), '[^\\w\\s\\x{{0600}}-\\x{{06FF}}]', ' ', 'g'), '\\s+', ' ', 'g')) AS name_ar FROM part"
)
def q_normalize_arabic(spark, sf_dir):
    return I.table(spark, sf_dir, "part").select("p_partkey", normalized_arabic(F.expr(ARABIC)).alias("name_ar"))


_PARSED = "norm AS normalized, imported, array_to_string(words, '|') AS words, brand, array_to_string(nums, '|') AS dosage_nums, qty, volume, weight, form, flavor, product_class, array_to_string(keys, '|') AS brand_keys"


@query(f"WITH inv AS ({I.select(I.INVENTORY, 'part')}), cat AS ({I.select(I.CATALOG, 'part')}), {O.parsed('a', 'inv', 'drug_name')}, {O.parsed('b', 'cat', 'product_name_en')} SELECT 'd' AS side, row_index AS id, {_PARSED} FROM a UNION ALL SELECT 'm', idx, {_PARSED} FROM b")
def q_parse_components(spark, sf_dir):
    keep = ["normalized", "imported", "words", "brand", "dosage_nums", "qty", "volume", "weight", "form", "flavor", "product_class", "brand_keys"]
    show = lambda p: [(_piped(p + c) if c in LISTS else F.col(p + c)).alias(c) for c in keep]
    left, right = _sides(spark, sf_dir)
    return left.select(F.lit("d").alias("side"), F.col("row_index").alias("id"), *show("d_")).unionByName(right.select(F.lit("m").alias("side"), F.col("idx").alias("id"), *show("m_")))


@query(f"SELECT p_partkey, {O.PRICE} AS price FROM part")
def q_price_parse(spark, sf_dir):
    return I.table(spark, sf_dir, "part").select("p_partkey", parsed_price(F.expr(I.PRICE_TEXT)).alias("price"))


@query(f"SELECT p_partkey, CAST({O.BONUS} AS DOUBLE) AS bonus FROM (SELECT p_partkey, {O.PRICE} AS d_price, p_retailprice AS m_price FROM part)")
def q_price_bonus(spark, sf_dir):
    return I.table(spark, sf_dir, "part").select("p_partkey", price_bonus(parsed_price(F.expr(I.PRICE_TEXT)), F.col("p_retailprice")).alias("bonus"))


@query(f"SELECT p_partkey, CASE WHEN price IS NULL THEN '-' ELSE CAST(CAST(floor(price) AS BIGINT) AS VARCHAR) END AS shown, CASE WHEN price IS NULL THEN '-' ELSE printf('%.1f%%', abs(price - p_retailprice) / greatest(price, p_retailprice) * 100) END AS delta FROM (SELECT *, {O.PRICE} AS price FROM part)")
def q_price_text(spark, sf_dir):
    text = F.expr(I.PRICE_TEXT)
    return I.table(spark, sf_dir, "part").select("p_partkey", formatted_price(text).alias("shown"), price_delta_text(text, F.col("p_retailprice").cast("string")).alias("delta"))


_PAIRED = f"WITH p AS (SELECT p_partkey, {O.normalized(I.WANTED)} AS a, {O.normalized(I.PRODUCT)} AS b FROM part), w AS (SELECT *, string_split(a, ' ') AS x, string_split(b, ' ') AS y FROM p)"


@query(f"{_PAIRED} SELECT p_partkey, {O.ratio('a', 'b')} AS ratio, {O.token_sort('x', 'y')} AS token_sort, {O.token_set('x', 'y')} AS token_set FROM w")
def q_similarity(spark, sf_dir):
    pairs = I.table(spark, sf_dir, "part").select("p_partkey", normalized(F.expr(I.WANTED)).alias("a"), normalized(F.expr(I.PRODUCT)).alias("b"))
    return pairs.select("p_partkey", ratio_udf("a", "b").alias("ratio"), token_sort_udf("a", "b").alias("token_sort"), token_set_udf("a", "b").alias("token_set"))


@query()
def q_similarity_partial(spark, sf_dir):
    pairs = I.table(spark, sf_dir, "part").select("p_partkey", normalized(F.expr(I.WANTED)).alias("a"), normalized(F.expr(I.PRODUCT)).alias("b"))
    return pairs.select("p_partkey", partial_token_sort_udf("a", "b").alias("partial_token_sort"))


# ---- candidates, verdicts, matches ----------------------------------------------------------------


@query(f"WITH {O.sides()}, {O.COMPONENT_PAIRS} SELECT row_index, idx, CAST(pos AS INT) AS pos FROM cp")
def q_component_candidates(spark, sf_dir):
    return component_pairs(*_sides(spark, sf_dir)).select("row_index", "idx", F.col("hit.pos").alias("pos"))


@query(f"WITH {O.sides()}, {O.PREFIX_PAIRS} SELECT row_index, idx, CAST(hit.pos AS INT) AS pos, CAST(-hit.far AS INT) AS common FROM pp")
def q_prefix_candidates(spark, sf_dir):
    return prefix_pairs(*_sides(spark, sf_dir)).select("row_index", "idx", F.col("hit.pos").alias("pos"), (-F.col("hit.far")).alias("common"))


@query(f"WITH {O.sides()}, {O.PREFIX_PAIRS}, pairs AS (SELECT * FROM pp JOIN d USING (row_index) JOIN m USING (idx)), {O.verdict('v', 'pairs')} SELECT row_index, idx, reason FROM v")
def q_component_verdict(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return verdict(matching.joined(prefix_pairs(left, right), left, right)).select("row_index", "idx", "reason")


_BEST = f"""WITH {O.sides()}, open AS (SELECT * FROM d WHERE length(d_norm) >= 3 AND d_brand <> ''),
{O.COMPONENT_PAIRS.replace('FROM d)', 'FROM open)')}, cpairs AS (SELECT * FROM cp JOIN open USING (row_index) JOIN m USING (idx)), {O.verdict('cv', 'cpairs')},
cs AS (SELECT row_index, idx, pos, {O.token_set('d_words', 'm_words')} + CASE WHEN d_volume <> '' AND d_volume = m_volume THEN 10.0 ELSE 0.0 END + CASE WHEN d_qty <> '' AND d_qty = m_qty THEN 8.0 ELSE 0.0 END
  + CASE WHEN d_form <> '' AND (d_form = m_form OR (d_form IN ({O.quoted(matching.V.OCULAR)[1:-1]}) AND m_form IN ({O.quoted(matching.V.OCULAR)[1:-1]}))) THEN 10.0 ELSE 0.0 END
  + CASE WHEN d_flavor <> '' AND d_flavor = m_flavor THEN 8.0 ELSE 0.0 END + CASE WHEN len(d_nums) > 0 AND d_nums = m_nums THEN 8.0 ELSE 0.0 END + {O.BONUS} AS score FROM cv WHERE reason = 'ok'),
first AS (SELECT row_index, idx, score FROM cs QUALIFY row_number() OVER (PARTITION BY row_index ORDER BY score DESC, pos, idx) = 1),
won AS (SELECT *, 'component_index' AS match_method FROM first WHERE score >= 65)"""
_SHOW = "CAST(least(round(score, 6), 100.0) AS DOUBLE) AS match_score"


@query(f"{_BEST} SELECT row_index, idx, match_method, {_SHOW} FROM won")
def q_match_component(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    left = left.where(matching.gate(left, CFG).isNull())
    best = matching._stage(component_pairs(left, right), left, right, matching.component_score, "component_index", CFG)
    return best.select("row_index", "idx", "match_method", F.least(F.round("score", 6), F.lit(100.0)).alias("match_score"))


@query(
    f"""{_BEST}, rest AS (SELECT * FROM open WHERE row_index NOT IN (SELECT row_index FROM won)),
{O.PREFIX_PAIRS.replace('FROM d)', 'FROM rest)').replace('ck AS', 'ck2 AS').replace('mk AS', 'mk2 AS').replace('ck JOIN mk', 'ck2 JOIN mk2')}, ppairs AS (SELECT * FROM pp JOIN rest USING (row_index) JOIN m USING (idx)), {O.verdict('pv', 'ppairs')},
ps AS (SELECT row_index, idx, hit, {O.token_sort('d_words', 'm_words')} + {O.BONUS} AS score FROM pv WHERE reason = 'ok'),
second AS (SELECT row_index, idx, score FROM ps QUALIFY row_number() OVER (PARTITION BY row_index ORDER BY score DESC, hit, idx) = 1)
SELECT row_index, idx, match_method, {_SHOW} FROM won UNION ALL SELECT row_index, idx, 'brand_index', {_SHOW} FROM second WHERE score >= 65"""
)
def q_match_cascade(spark, sf_dir):
    found = matching.match(I.inventory(spark, sf_dir), I.catalog(spark, sf_dir), CFG, fuzzy=False).where("_idx IS NOT NULL")
    return found.select("row_index", F.col("_idx").alias("idx"), "match_method", F.round("match_score", 6).alias("match_score"))


@query()
def q_match_full(spark, sf_dir):
    return public(matching.match(I.inventory(spark, sf_dir), I.catalog(spark, sf_dir), CFG))


@query()
def q_search_candidates(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return matching.search_candidates(left, right, CFG).select("row_index", "idx", "score", "reason", "stage", "ord")


def _assisted(spark, sf_dir):
    return scratch(matching.match(I.inventory(spark, sf_dir), I.catalog(spark, sf_dir), CFG), "matched")


@query()
def q_stage_verify(spark, sf_dir):
    return public(decide.verify(_assisted(spark, sf_dir), I.catalog(spark, sf_dir)))


@query()
def q_stage_search(spark, sf_dir):
    return public(decide.search(_assisted(spark, sf_dir), I.catalog(spark, sf_dir)))


@query()
def q_stage_review(spark, sf_dir):
    done = scratch(decide.verify(_assisted(spark, sf_dir), I.catalog(spark, sf_dir)), "verified")
    unsure = done.withColumn("ai_confidence", F.when(F.col("row_index") % 2 == 0, 0.0).otherwise(F.col("ai_confidence")))
    return public(decide.review(unsure, I.catalog(spark, sf_dir)))


# ---- trace events of a real run -----------------------------------------------------------------------

_CASCADE = f"""{_BEST}, rest AS (SELECT * FROM open WHERE row_index NOT IN (SELECT row_index FROM won)),
{O.PREFIX_PAIRS.replace('FROM d)', 'FROM rest)').replace('ck AS', 'ck2 AS').replace('mk AS', 'mk2 AS').replace('ck JOIN mk', 'ck2 JOIN mk2')}, ppairs AS (SELECT * FROM pp JOIN rest USING (row_index) JOIN m USING (idx)), {O.verdict('pv', 'ppairs')},
ps AS (SELECT row_index, idx, hit, {O.token_sort('d_words', 'm_words')} + {O.BONUS} AS score FROM pv WHERE reason = 'ok'),
second AS (SELECT row_index, idx, score FROM ps QUALIFY row_number() OVER (PARTITION BY row_index ORDER BY score DESC, hit, idx) = 1),
took AS (SELECT row_index, idx FROM won UNION ALL SELECT row_index, idx FROM second WHERE score >= 65)"""


def _run_events(spark, sf_dir) -> DataFrame:
    return trace.traced_match(I.inventory(spark, sf_dir), I.catalog(spark, sf_dir), CFG, fuzzy=False)[1]


@query(f"{_CASCADE} SELECT code, CASE WHEN idx IS NULL THEN 'no_match' ELSE 'matched' END AS final_status, coalesce(product_name_en, 'NONE') AS final_match FROM d LEFT JOIN took USING (row_index) LEFT JOIN m USING (idx)")
def q_trace_run(spark, sf_dir):
    return audit.trace_summary(_run_events(spark, sf_dir)).select("code", "final_status", "final_match")


@query(
    f"""{_CASCADE} SELECT step, decision, reject_rule, count(*) AS n FROM (
  SELECT 'normalize' AS step, 'parsed' AS decision, '' AS reject_rule FROM d
  UNION ALL SELECT 'candidate_generated', 'generated', '' FROM cv UNION ALL SELECT 'score_breakdown', 'score_calculated', '' FROM cv WHERE reason = 'ok'
  UNION ALL SELECT 'component_check', CASE WHEN reason = 'ok' THEN 'accepted' ELSE 'rejected' END, CASE WHEN reason = 'ok' THEN '' ELSE reason END FROM (SELECT reason FROM cv UNION ALL SELECT reason FROM pv)
  UNION ALL SELECT 'brand_lookup', 'generated', '' FROM pv UNION ALL SELECT 'brand_lookup', 'no_candidates', '' FROM rest WHERE row_index NOT IN (SELECT row_index FROM pv)
  UNION ALL SELECT 'final', CASE WHEN idx IS NULL THEN 'no_match' ELSE 'matched' END, '' FROM d LEFT JOIN took USING (row_index)) GROUP BY ALL"""
)
def q_trace_steps(spark, sf_dir):
    return _run_events(spark, sf_dir).groupBy("step", "decision", "reject_rule").agg(F.count("*").alias("n"))


_MODEL_TEXT = "CASE WHEN ai_model <> '' THEN '  model=' || ai_model ELSE '' END"
_LINE = f"""CASE step WHEN 'final' THEN '  >> FINAL: match=' || final_match || '  score=  method=  AI=  reason: ' || selection_reason
  WHEN 'component_check' THEN '  [component_check] ' || candidate_name || '  brand=  ok=  reason=  reject_rule=' || coalesce(reject_rule, '')
  WHEN 'brand_lookup' THEN '  [brand_lookup] ' || candidate_name || '  brand=  score='
  WHEN 'ai_verify_result' THEN '  [AI VERIFY] result=' || ai_result || '  verifying=' || chr(39) || candidate_name || chr(39) || '  confidence=' || {_MODEL_TEXT} || '  ' || selection_reason
  WHEN 'ai_search_result' THEN CASE WHEN ai_result = 'ai_found' THEN '  [AI SEARCH] FOUND: ' || candidate_name || '  confidence=' || {_MODEL_TEXT} ELSE '  [AI SEARCH] not found  ' || selection_reason END
  ELSE '  [AI REVIEW] result=' || ai_result || '  review_confidence=  ' || selection_reason END"""


@query(f"WITH e AS ({I.select(I.EVENTS, 'events')}) SELECT seq, {_LINE} AS value FROM e")
def q_trace_lines(spark, sf_dir):
    rows = I.events(spark, sf_dir)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit("")
    return rows.select("seq", F.concat(F.lit("  "), trace.line(text)).alias("value"))


# ---- selections and reports over results ----------------------------------------------------------

_RESULTS = f"WITH r AS ({I.select(I.RESULTS, 'orders')})"
_MATCHED = "matched_product_name_en <> ''"
_FUZZY = "match_method IN ('token_set_ratio', 'token_sort_ratio', 'partial_token_sort_ratio')"


def _selected(policy: str) -> Query:
    return lambda spark, sf_dir: review.verify_selection(I.results(spark, sf_dir), Matching(verify_policy=policy)).select("row_index", "match_method", "match_score")


for _policy, _cond in (("score", "match_score < 95"), ("fuzzy", f"(match_score < 95 OR {_FUZZY})"), ("all-non-exact", "NOT (match_method = 'component_index' AND match_score >= 100)"), ("all", "true")):
    _name = f"q_verify_{_policy.replace('-', '')}"
    QUERIES[_name] = _selected(_policy)
    ORACLES[_name] = f"{_RESULTS} SELECT row_index, match_method, match_score FROM r WHERE {_MATCHED} AND {_cond}"


@query(f"{_RESULTS} SELECT row_index, match_score FROM r WHERE {_MATCHED} AND match_score < 95 ORDER BY row_index LIMIT 25")
def q_verify_limit(spark, sf_dir):
    return review.verify_selection(I.results(spark, sf_dir), Matching(verify_limit=25)).select("row_index", "match_score")


@query(f"{_RESULTS} SELECT row_index, match_method FROM r WHERE NOT {_MATCHED} ORDER BY row_index LIMIT 40")
def q_unmatched(spark, sf_dir):
    return review.unmatched(I.results(spark, sf_dir), 40).select("row_index", "match_method")


@query(f"{_RESULTS} SELECT row_index, verified, ai_confidence FROM r WHERE verified IN ('ai_confirmed', 'ai_corrected', 'ai_found', 'ai_rejected') AND (ai_confidence = 0 OR (ai_confidence > 0 AND ai_confidence < 0.8) OR _ai_component_reason NOT IN ('', 'nan'))")
def q_review_selection(spark, sf_dir):
    return review.review_selection(I.results(spark, sf_dir), CFG).select("row_index", "verified", "ai_confidence")


@query(f"{_RESULTS} SELECT row_index FROM r WHERE verified IN ('ai_confirmed', 'ai_corrected', 'ai_found', 'ai_rejected') AND ai_confidence = 0 UNION SELECT row_index FROM r WHERE verified IN ('ai_confirmed', 'ai_corrected', 'ai_found', 'ai_rejected') AND _ai_component_reason NOT IN ('', 'nan')")
def q_union_review(spark, sf_dir):
    rows = I.results(spark, sf_dir).where(F.col("verified").isin(*review.DECIDED))
    return rows.where("ai_confidence = 0").select("row_index").unionByName(rows.where("_ai_component_reason NOT IN ('', 'nan')").select("row_index")).distinct()


@query(f"{_RESULTS} SELECT row_index, CASE WHEN {_MATCHED} THEN CASE WHEN match_score < 95 THEN 'verify' ELSE 'none' END WHEN match_method IN ('too_short', 'invalid_name') THEN 'none' ELSE 'search' END AS ai_stage FROM r")
def q_eligibility(spark, sf_dir):
    return review.eligibility(I.results(spark, sf_dir), CFG).select("row_index", "ai_stage")


@query(f"{_RESULTS} SELECT row_index, match_score, '' AS manual_decision, '' AS manual_reason, '' AS correct_store_product_id FROM r WHERE NOT {_MATCHED} OR match_score < 95 OR _ai_component_reason <> ''")
def q_manual_review(spark, sf_dir):
    return manual_review(I.results(spark, sf_dir), CFG.verify_threshold).select("row_index", "match_score", *REVIEW_BLANKS)


@query(f"{_RESULTS} SELECT count(*) AS total, count(*) FILTER ({_MATCHED}) AS matched, count(*) FILTER (NOT {_MATCHED}) AS unmatched, count(*) FILTER ({_MATCHED}) * 100.0::DOUBLE / count(*) AS matched_pct, count(*) FILTER (NOT {_MATCHED}) * 100.0::DOUBLE / count(*) AS unmatched_pct FROM r")
def q_match_counts(spark, sf_dir):
    return audit.match_counts(I.results(spark, sf_dir))


@query(f"{_RESULTS} SELECT CASE WHEN match_score >= 100 THEN '100' WHEN match_score >= 95 THEN '95-99' WHEN match_score >= 90 THEN '90-94' WHEN match_score >= 80 THEN '80-89' WHEN match_score >= 70 THEN '70-79' ELSE '<70' END AS band, count(*) AS n FROM r WHERE {_MATCHED} GROUP BY 1")
def q_score_histogram(spark, sf_dir):
    return audit.score_histogram(I.results(spark, sf_dir))


@query(f"{_RESULTS} SELECT verified AS value, count(*) AS n FROM r GROUP BY 1")
def q_status_counts(spark, sf_dir):
    return audit.value_counts(I.results(spark, sf_dir), "verified")


@query(f"{_RESULTS} SELECT match_method AS value, count(*) AS n FROM r GROUP BY 1")
def q_method_counts(spark, sf_dir):
    return audit.value_counts(I.results(spark, sf_dir), "match_method")


@query(f"{_RESULTS} SELECT matched_store_product_id AS value, count(*) AS n FROM r GROUP BY 1 ORDER BY n DESC, value LIMIT 15")
def q_top_values(spark, sf_dir):
    return audit.value_counts(I.results(spark, sf_dir), "matched_store_product_id", 15)


@query(f"{_RESULTS} SELECT count(*) FILTER (verified LIKE 'ai_confirmed%') AS ai_confirmed, count(*) FILTER (verified LIKE 'ai_corrected%') AS ai_corrected, count(*) FILTER (verified LIKE 'ai_rejected%') AS ai_rejected, count(*) FILTER (verified LIKE 'ai_found%') AS ai_found, count(*) FILTER (verified = 'ai_review_rejected') AS ai_overridden FROM r")
def q_phase_statistics(spark, sf_dir):
    return audit.phase_statistics(I.results(spark, sf_dir))


@query(f"{_RESULTS} SELECT row_index, code FROM r WHERE row_index >= 100 AND row_index < 150")
def q_row_slice(spark, sf_dir):
    return row_slice(I.results(spark, sf_dir), start=100, end=400, limit=50).select("row_index", "code")


_TWO = f"WITH b AS ({I.select(I.RESULTS, 'orders')}), a AS ({I.select(I.AFTER, 'orders', I.AFTER_WHERE)})"
_CHANGE = "CASE WHEN b.matched_product_name_en = '' AND a.matched_product_name_en <> '' THEN 'newly_matched' WHEN b.matched_product_name_en <> '' AND a.matched_product_name_en = '' THEN 'newly_unmatched' WHEN b.matched_product_name_en <> '' AND b.matched_store_product_id <> a.matched_store_product_id THEN 'changed_store_product_id' END"


@query(f"{_TWO}, c AS (SELECT {_CHANGE} AS change FROM b JOIN a USING (code)) SELECT count(*) AS shared_rows, count(*) FILTER (change = 'newly_matched') AS newly_matched, count(*) FILTER (change = 'newly_unmatched') AS newly_unmatched, count(*) FILTER (change = 'changed_store_product_id') AS changed_store_product_id FROM c")
def q_run_delta(spark, sf_dir):
    return audit.delta_counts(audit.run_delta(I.results(spark, sf_dir), I.later_results(spark, sf_dir)))


@query(f"{_TWO} SELECT code, {_CHANGE} AS change FROM b JOIN a USING (code) WHERE {_CHANGE} IS NOT NULL")
def q_run_changes(spark, sf_dir):
    return audit.run_delta(I.results(spark, sf_dir), I.later_results(spark, sf_dir)).where("change IS NOT NULL").select("code", "change")


@query(f"{_TWO} SELECT code FROM b INTERSECT SELECT code FROM a")
def q_shared_codes(spark, sf_dir):
    return I.results(spark, sf_dir).select("code").intersect(I.later_results(spark, sf_dir).select("code"))


@query(f"WITH pairs AS (SELECT d.*, m.* FROM d JOIN m ON m.idx = d.row_index + 8), {O.verdict('v', 'pairs')} SELECT code, reason FROM v WHERE reason <> 'ok'".replace("WITH ", f"WITH {O.sides()}, ", 1))
def q_component_audit(spark, sf_dir):
    names = I.catalog(spark, sf_dir).select((F.col("idx") - 8).alias("row_index"), F.col("product_name_en").alias("matched_product_name_en"))
    rows = I.inventory(spark, sf_dir).join(names, "row_index").select("code", "drug_name", "matched_product_name_en", F.lit("m").alias("match_method"), F.lit("v").alias("verified"))
    return audit.component_audit(rows).select("code", "reason")


_OUTCOME = "CASE WHEN api_failed THEN CASE WHEN is_correct AND sure >= 0.75 THEN 'ai_confirmed' ELSE 'ai_review_rejected' END WHEN flagged AND verified IN ('ai_confirmed', 'ai_corrected', 'ai_found') AND (NOT is_correct OR sure < 0.85 OR NOT safe) THEN 'ai_review_rejected' WHEN is_correct THEN verified || '_reviewed' WHEN sure < 0.75 THEN verified WHEN verified IN ('ai_confirmed', 'ai_corrected', 'ai_found') THEN 'ai_review_rejected' WHEN verified = 'ai_rejected' AND picked THEN 'ai_review_corrected' ELSE verified END"
_DECISIONS = {"api_failed": "o_orderkey % 11 = 0", "is_correct": "o_custkey % 2 = 0", "review_confidence": "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_custkey % 11 AS DOUBLE) / 10 END", "flagged": "o_orderkey % 17 = 0", "safe": "o_orderkey % 2 = 0", "picked": "o_orderkey % 3 = 0"}


@query(f"SELECT row_index, {_OUTCOME} AS outcome FROM (SELECT *, coalesce(review_confidence, 0) AS sure FROM ({I.select(I.RESULTS | _DECISIONS, 'orders')})) WHERE verified IN ('ai_confirmed', 'ai_corrected', 'ai_found', 'ai_rejected')")
def q_review_outcome(spark, sf_dir):
    rows = I.table(spark, sf_dir, "orders").selectExpr(*I.columns(I.RESULTS | _DECISIONS)).where(F.col("verified").isin(*review.DECIDED))
    return rows.select("row_index", review.review_outcome(CFG).alias("outcome"))


# ---- traces, models, replies ----------------------------------------------------------------------

_STATUS = "CASE WHEN r IN ('ai_rejected', 'ai_review_rejected', 'not_found', 'ai_rejected_kept_low_confidence_review') THEN 'rejected' WHEN r = 'ai_review_corrected' OR regexp_replace(r, '(_reviewed|_kept_low_confidence_review)$', '') IN ('ai_found', 'ai_corrected', 'ai_confirmed') THEN 'matched' ELSE '' END"
_FIELDS = ("error_stage", "error_code", "reject_rule", "selection_reason", "candidate_name", "final_match", "ai_result")
_WHOLE = "{" + ", ".join(f"'{f}': coalesce({f}, '')" for f in _FIELDS) + "}"


@query(
    f"""WITH e AS ({I.select(I.EVENTS, 'events')}), g AS (
  SELECT drug_code AS code, drug_name, arg_max({_WHOLE}, seq) FILTER (step = 'final') AS fin, arg_max({_WHOLE}, seq) FILTER (step IN ('ai_verify_result', 'ai_search_result', 'ai_review_result')) AS ai,
    arg_max({_WHOLE}, seq) FILTER (decision = 'rejected' OR coalesce(reject_rule, '') <> '') AS rej, arg_max({_WHOLE}, seq) AS lst,
    arg_max(ai_result, seq) FILTER (ai_result <> '') AS ai_action,
    arg_max(CASE WHEN candidate_name <> '' THEN candidate_name ELSE final_match END, seq) FILTER (candidate_name <> '' OR final_match NOT IN ('', 'NONE')) AS named,
    arg_max(trim(provider_used || '/' || coalesce(model_used, ai_model), '/'), seq) FILTER (provider_used <> '' OR coalesce(model_used, ai_model) <> '') AS who
  FROM e WHERE drug_code <> '' OR drug_name <> '' GROUP BY ALL),
h AS (SELECT *, coalesce(ai.ai_result, '') AS r FROM g), t AS (SELECT *, {_STATUS} AS told FROM h),
s AS (SELECT *, CASE WHEN told = 'rejected' THEN 'no_match' WHEN told = 'matched' THEN 'matched' WHEN fin IS NOT NULL THEN CASE WHEN fin.final_match <> 'NONE' THEN 'matched' ELSE 'no_match' END ELSE 'unknown' END AS final_status, coalesce(rej, fin, lst) AS p FROM t)
SELECT code, drug_name, final_status, CASE WHEN told = 'rejected' THEN 'NONE' WHEN told = 'matched' THEN coalesce(nullif(ai.candidate_name, ''), named, '') ELSE coalesce(fin.final_match, '') END AS final_match,
  CASE WHEN p.error_stage <> '' THEN p.error_stage WHEN final_status = 'no_match' THEN 'matching' ELSE '' END AS failure_stage,
  coalesce(nullif(p.error_code, ''), nullif(p.reject_rule, ''), nullif(p.selection_reason, ''), '') AS primary_reason,
  coalesce(rej.candidate_name, '') AS best_rejected_candidate, coalesce(ai_action, '') AS ai_action, coalesce(who, '') AS ai_provider_model FROM s"""
)
def q_trace_summary(spark, sf_dir):
    return audit.trace_summary(I.events(spark, sf_dir))


@query(f"WITH e AS ({I.select(I.EVENTS, 'events')}) SELECT error_code AS value, count(*) AS n FROM e GROUP BY 1 ORDER BY n DESC, value NULLS FIRST LIMIT 12")
def q_trace_top_errors(spark, sf_dir):
    return audit.value_counts(I.events(spark, sf_dir), "error_code", 12)


@query(f"WITH e AS ({I.select(I.EVENTS, 'events')}) SELECT concat_ws(' | ', CAST(seq AS VARCHAR), coalesce(step, '-'), coalesce(drug_name, '-'), coalesce(decision, '-'), coalesce(selection_reason, '-')) AS value FROM e")
def q_trace_text(spark, sf_dir):
    return audit.trace_text(I.events(spark, sf_dir))


@query(f"WITH h AS ({I.select(I.HEALTH, 'supplier', I.TESTED)}) SELECT coalesce(nullif(error_type, ''), 'unknown') AS error_type, count(*) AS n FROM h WHERE NOT ok GROUP BY 1")
def q_trace_failures(spark, sf_dir):
    return audit.failure_histogram(I.health(spark, sf_dir))


_ACCURACY = f"""c AS ({I.select(I.CASES, 'labels')}), acc AS (SELECT model, count(*) AS total, count(*) FILTER (NOT api_failed) AS valid_count, count(*) FILTER (api_failed) AS api_failed_count,
  count(*) FILTER (NOT api_failed AND expected = got) AS correct_count, coalesce(count(*) FILTER (NOT api_failed AND expected = got)::DOUBLE / nullif(count(*) FILTER (NOT api_failed), 0), 0) AS accuracy,
  coalesce(count(*) FILTER (NOT api_failed AND expected AND got)::DOUBLE / nullif(count(*) FILTER (NOT api_failed AND expected), 0), 0) AS match_accuracy,
  coalesce(count(*) FILTER (NOT api_failed AND NOT expected AND NOT got)::DOUBLE / nullif(count(*) FILTER (NOT api_failed AND NOT expected), 0), 0) AS reject_accuracy FROM c GROUP BY model)"""


@query(f"WITH {_ACCURACY} SELECT * FROM acc")
def q_model_accuracy(spark, sf_dir):
    return audit.model_accuracy(I.table(spark, sf_dir, "labels").selectExpr(*I.columns(I.CASES)))


@query(f"WITH {_ACCURACY} SELECT model, CAST(row_number() OVER (ORDER BY accuracy DESC, total, model) AS INT) AS place FROM acc")
def q_model_ranking(spark, sf_dir):
    return audit.ranked_models(audit.model_accuracy(I.table(spark, sf_dir, "labels").selectExpr(*I.columns(I.CASES))), "total").select("model", "place")


_RECOVERED = """CASE event_id % 8 WHEN 0 THEN 'true|same|0.9' WHEN 1 THEN 'false|form|0.8' WHEN 2 THEN 'true|r' || CAST(event_id % 10 AS VARCHAR) || '|0.5' WHEN 3 THEN 'true|cut|0.7' WHEN 4 THEN 'false|cut off he|0.6' WHEN 7 THEN 'true|loud|0.3' END"""


@query(f"SELECT event_id, {_RECOVERED} AS decision FROM events")
def q_json_recover(spark, sf_dir):
    rows = I.table(spark, sf_dir, "events").selectExpr("event_id", f"{I.REPLY} AS reply").withColumn("d", R.decision(F.col("reply")))
    told = F.concat_ws("|", F.col("d.is_correct").cast("string"), F.col("d.reason"), F.col("d.confidence").cast("string"))
    return rows.select("event_id", F.when(F.col("d").isNotNull(), told).alias("decision"))


_RAW_INDEX = "CASE event_id % 7 WHEN 0 THEN '3' WHEN 1 THEN '\"2\"' WHEN 2 THEN 'true' WHEN 3 THEN '9' WHEN 4 THEN '-1' WHEN 5 THEN '\" 4 \"' ELSE '2-3' END"


@query("SELECT event_id, CAST(CASE event_id % 7 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 5 THEN 4 ELSE -1 END AS INT) AS best_index FROM events")
def q_best_index(spark, sf_dir):
    return I.table(spark, sf_dir, "events").select("event_id", F.coalesce(R.best_index(F.expr(_RAW_INDEX), F.lit(5)), F.lit(-1)).alias("best_index"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 AND event_id % 2 = 0 THEN 'json_generation_failed' WHEN event_id % 3 = 0 THEN 'http_400' WHEN event_id % 3 = 1 THEN 'http_429' ELSE 'http_500' END AS code FROM events")
def q_error_code(spark, sf_dir):
    status = F.expr("CASE event_id % 3 WHEN 0 THEN 400 WHEN 1 THEN 429 ELSE 500 END")
    body = F.expr("CASE WHEN event_id % 2 = 0 THEN 'x Failed to validate JSON y' ELSE 'bad' END")
    return I.table(spark, sf_dir, "events").select("event_id", R.error_code(status, body).alias("code"))


_KIND = "event_type || CASE event_id % 4 WHEN 0 THEN ' is the same product' WHEN 1 THEN ': same brand, Different Dosage' WHEN 2 THEN ' unclear' ELSE ' identical' END"


@query("SELECT event_id, event_id % 4 IN (0, 3) AS verdict FROM events")
def q_infer_verdict(spark, sf_dir):
    return I.table(spark, sf_dir, "events").select("event_id", R.inferred_verdict(F.expr(_KIND)).alias("verdict"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) = 0 THEN CASE WHEN event_id % 2 = 0 THEN 0.7 ELSE 0.6 END ELSE CAST(json_extract(props, '$.k') AS DOUBLE) / 100 END::DOUBLE AS confidence FROM events")
def q_stated_confidence(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("long")
    return I.table(spark, sf_dir, "events").select("event_id", k.alias("k"), R.stated_confidence(k / 100, F.col("event_id") % 2 == 0).alias("confidence"))


@query(f"{_RESULTS} SELECT verified, match_method, count(*) AS n FROM r GROUP BY ALL ORDER BY n DESC, verified NULLS FIRST, match_method NULLS FIRST LIMIT 15")
def q_status_pairs(spark, sf_dir):
    return audit.status_pairs(I.results(spark, sf_dir))


_FAILURES = {"provider": "CASE user_id % 3 WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' END", "key_suffix": "CAST(user_id % 5 AS STRING)", "model": "event_type || CAST(user_id % 40 AS STRING)", "seq": "event_id", "permanent": "event_id % 29 = 0"}
_IS_FAILURE = "event_type = 'error'"


@query(
    f"""WITH f AS ({I.select(_FAILURES, 'events', _IS_FAILURE)}), n AS (SELECT *, row_number() OVER (PARTITION BY provider, key_suffix, model ORDER BY seq) AS nth FROM f)
SELECT provider, key_suffix, model, count(*) AS failures, min(seq) FILTER (permanent OR nth >= 2) AS disabled_seq, count(*) FILTER (permanent OR nth >= 2) > 0 AS disabled FROM n GROUP BY ALL"""
)
def q_breaker_states(spark, sf_dir):
    """The failures are the events of one type."""
    return rotation.breaker_states(I.table(spark, sf_dir, "events").where(_IS_FAILURE).selectExpr(*I.columns(_FAILURES)))


# ---- endpoints ------------------------------------------------------------------------------------

PROVIDERS = ("gamma", "alpha", "beta")
_HEALTH = f"h AS ({I.select(I.HEALTH, 'supplier', I.TESTED)})"
_NUMBER = lambda c: f"(TRY_CAST(nullif(regexp_replace(replace({c}, ',', ''), '[KkMm]$', ''), '') AS DOUBLE) * CASE upper(right({c}, 1)) WHEN 'K' THEN 1000 WHEN 'M' THEN 1000000 ELSE 1 END)"
_CLASSED = f"""{_HEALTH}, q AS (SELECT *, coalesce({', '.join(_NUMBER(c) for c in endpoints.QUOTA_COLUMNS)}, 0.0) AS quota,
  CASE WHEN ok THEN 'working' WHEN error_type = 'TimeoutError' OR error_type IN ('invalid_json', 'response_not_json', 'response_shape', 'null_content') OR starts_with(error_type, 'missing_fields:') THEN 'degraded'
    WHEN http_status = '429' THEN 'quota-limited' WHEN http_status = '403' THEN 'permission-failed' WHEN http_status = '404' OR contains(lower(error_message), 'does not exist') THEN 'model-not-accessible' ELSE 'failed' END AS health_status FROM h),
cl AS (SELECT *, CASE health_status WHEN 'working' THEN 0 WHEN 'degraded' THEN 1 WHEN 'quota-limited' THEN 2 WHEN 'permission-failed' THEN 3 WHEN 'model-not-accessible' THEN 4 ELSE 5 END AS fallback_tier,
  CASE WHEN ok THEN greatest(0.0, 40 - rotation_tier * 10.0) + greatest(0.0, 80 - quality_rank * 5.0) + least(quota, 1000) / 20 + greatest(0.0, 20 - CASE WHEN elapsed_s = 0 THEN 20 ELSE elapsed_s END) ELSE 0.0 END AS score FROM q)"""


@query(f"WITH {_CLASSED} SELECT seq, health_status, CAST(fallback_tier AS INT) AS fallback_tier, CASE health_status WHEN 'working' THEN 'use-first' WHEN 'degraded' THEN 'late-retry' WHEN 'quota-limited' THEN 'last-choice-quota' WHEN 'permission-failed' THEN 'last-choice-permission' WHEN 'model-not-accessible' THEN 'last-choice-model-access' ELSE 'last-choice' END AS rotation_recommendation, CAST(round(score, 6) AS DOUBLE) AS rotation_score FROM cl")
def q_health_classify(spark, sf_dir):
    return endpoints.classified(I.health(spark, sf_dir)).select("seq", "health_status", "fallback_tier", "rotation_recommendation", F.round("rotation_score", 6).alias("rotation_score"))


@query(f"WITH {_CLASSED} SELECT seq, CAST(row_number() OVER (ORDER BY fallback_tier, rotation_tier, quality_rank, quota DESC, CASE WHEN elapsed_s = 0 THEN 9999 ELSE elapsed_s END, provider, model) AS INT) AS rotation_rank FROM cl")
def q_health_rank(spark, sf_dir):
    return endpoints.ranked_health(I.health(spark, sf_dir)).select("seq", "rotation_rank")


@query(f"WITH {_CLASSED} SELECT seq, CAST(quota AS DOUBLE) AS quota FROM cl")
def q_quota_coalesce(spark, sf_dir):
    return I.health(spark, sf_dir).select("seq", endpoints.quota_remaining().alias("quota"))


@query(f"WITH {_HEALTH} SELECT count(*) AS healthy, count(DISTINCT provider) AS providers, count(*) >= 3 AND count(DISTINCT provider) >= 2 AS enough FROM h WHERE ok")
def q_enough_healthy(spark, sf_dir):
    return endpoints.enough_healthy(I.health(spark, sf_dir), 3, 2)


_ATTEMPTS = f"t AS ({I.select(I.ATTEMPTS, 'supplier')})"
_PLACE = "CASE provider WHEN 'gamma' THEN 1 WHEN 'alpha' THEN 2 WHEN 'beta' THEN 3 ELSE 4 END"


@query(f"WITH {_ATTEMPTS} SELECT model, CAST(row_number() OVER (ORDER BY NOT eligible, disabled_until <> '', rotation_tier, quality_rank, coalesce(quota_remaining, 0) DESC, latency, {_PLACE}, provider, model) AS INT) AS place FROM t")
def q_attempt_rank(spark, sf_dir):
    return endpoints.ranked_attempts(I.attempts(spark, sf_dir), PROVIDERS).select("model", "place")


@query(f"WITH {_ATTEMPTS}, u AS (SELECT *, row_number() OVER (PARTITION BY rotation_tier, provider ORDER BY place) AS turn FROM t WHERE rotation_tier <= 3) SELECT model, CAST(row_number() OVER (ORDER BY rotation_tier, turn, provider) AS INT) AS picked FROM u QUALIFY picked <= 30")
def q_round_robin(spark, sf_dir):
    return endpoints.round_robin(I.attempts(spark, sf_dir), 30).select("model", "picked")


@query(f"WITH {_ATTEMPTS} SELECT model, ((row_number() OVER (PARTITION BY rotation_tier ORDER BY place) - 1 - 2) % count(*) OVER (PARTITION BY rotation_tier) + count(*) OVER (PARTITION BY rotation_tier)) % count(*) OVER (PARTITION BY rotation_tier) AS position FROM t")
def q_rotation_cursor(spark, sf_dir):
    return endpoints.rotated(I.attempts(spark, sf_dir), 2).select("model", F.col("position").cast("long").alias("position"))


@query(f"WITH {_ATTEMPTS}, {_HEALTH} SELECT model FROM t WHERE (provider, key_suffix, model) NOT IN (SELECT provider, key_suffix, model FROM h WHERE mode = 'json')")
def q_untested(spark, sf_dir):
    return endpoints.untested(I.attempts(spark, sf_dir), I.health(spark, sf_dir)).select("model")


@query(f"WITH {_ATTEMPTS}, {_CLASSED} SELECT model, CAST(CASE WHEN cl.model IS NULL THEN 1 WHEN ok THEN 0 WHEN health_status IN ('permission-failed', 'model-not-accessible') THEN 3 ELSE 2 END AS INT) AS priority FROM t LEFT JOIN (SELECT * FROM cl WHERE mode = 'json') cl USING (provider, key_suffix, model)".replace("cl.model IS NULL", "cl.seq IS NULL"))
def q_attempts_by_health(spark, sf_dir):
    return endpoints.attempts_by_health(I.attempts(spark, sf_dir), I.health(spark, sf_dir)).select("model", "priority")


_SMART = f"""{_ATTEMPTS}, {_CLASSED}, ranked AS (SELECT *, row_number() OVER (ORDER BY fallback_tier, rotation_tier, quality_rank, quota DESC, CASE WHEN elapsed_s = 0 THEN 9999 ELSE elapsed_s END, provider, model) AS rr FROM cl),
cached AS (SELECT t.model FROM t JOIN (SELECT provider, key_suffix, model, min(rr) AS rr FROM ranked WHERE mode = 'json' AND ok GROUP BY ALL) g USING (provider, key_suffix, model) ORDER BY g.rr LIMIT 5),
turns AS (SELECT *, row_number() OVER (PARTITION BY rotation_tier, provider ORDER BY place) AS turn FROM t WHERE rotation_tier <= 2 AND model NOT IN (SELECT model FROM cached)),
inturn AS (SELECT model, row_number() OVER (ORDER BY rotation_tier, turn, provider) AS picked FROM turns)"""


@query(f"WITH {_SMART} SELECT model FROM cached UNION ALL SELECT model FROM inturn WHERE picked <= 20 - (SELECT count(*) FROM cached)")
def q_preflight_smart(spark, sf_dir):
    return endpoints.preflight_selection(I.attempts(spark, sf_dir), I.health(spark, sf_dir), "smart", 20, 5, 2).select("model")


@query(f"WITH {_ATTEMPTS}, {_CLASSED} SELECT model, CAST(row_number() OVER (ORDER BY CASE WHEN cl.seq IS NULL THEN 1 WHEN ok THEN 0 WHEN health_status IN ('permission-failed', 'model-not-accessible') THEN 3 ELSE 2 END, place) AS INT) AS turn FROM t LEFT JOIN (SELECT * FROM cl WHERE mode = 'json') cl USING (provider, key_suffix, model)")
def q_preflight_plan(spark, sf_dir):
    tested = I.health(spark, sf_dir)
    return endpoints.preflight_plan(I.attempts(spark, sf_dir), tested, tested.limit(0)).select("model", F.col("order").alias("turn"))


@query("SELECT s_suppkey, CAST(CASE WHEN n <= 0 THEN 3 WHEN r <= (n + 2) // 3 THEN 1 WHEN r <= (2 * n + 2) // 3 THEN 2 ELSE 3 END AS INT) AS tier FROM (SELECT s_suppkey, s_suppkey % 9 + 1 AS r, s_suppkey % 14 AS n FROM supplier)")
def q_model_tier(spark, sf_dir):
    return I.table(spark, sf_dir, "supplier").select("s_suppkey", endpoints.model_tier(F.col("s_suppkey") % 9 + 1, F.col("s_suppkey") % 14).alias("tier"))


_HEADERS = "map_from_arrays({0}('x-rpm-limit', 'x-daily-remaining', 'ratelimit-reset', 'retry-after'), {0}(CAST(s_suppkey AS STRING), CASE WHEN s_suppkey % 2 = 0 THEN ' 12 ' ELSE '' END, CAST(s_suppkey * 1000 AS STRING), '2024-01-01T00:00:10Z'))"


@query("SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS quota_limit_minute, CASE WHEN s_suppkey % 2 = 0 THEN '12' ELSE '' END AS quota_remaining_day, CAST(s_suppkey * 1000 AS VARCHAR) AS rate_reset_requests FROM supplier")
def q_quota_headers(spark, sf_dir):
    found = R.quota(F.expr(_HEADERS.format("array")))
    return I.table(spark, sf_dir, "supplier").select("s_suppkey", *(found[c].alias(c) for c in ("quota_limit_minute", "quota_remaining_day", "rate_reset_requests")))


@query(
    """SELECT s_suppkey, CASE WHEN s = 0 THEN '0s' ELSE concat_ws(' ', CASE WHEN s // 86400 > 0 THEN (s // 86400) || 'd' END, CASE WHEN s % 86400 // 3600 > 0 THEN (s % 86400 // 3600) || 'h' END,
  CASE WHEN s % 3600 // 60 > 0 THEN (s % 3600 // 60) || 'm' END, CASE WHEN s % 60 > 0 THEN (s % 60) || 's' END) END AS reset_in FROM (SELECT s_suppkey, s_suppkey * 977 AS s FROM supplier)"""
)
def q_reset_in(spark, sf_dir):
    now = F.lit(1_700_000_000.0)
    seconds = F.col("s_suppkey") * 977
    at = F.when(F.col("s_suppkey") % 2 == 0, seconds.cast("string")).otherwise((seconds + 1_700_000_000).cast("string"))
    return I.table(spark, sf_dir, "supplier").select("s_suppkey", R.reset_in(at, now).alias("reset_in"))


_MODEL = """CASE s_suppkey % 5
  WHEN 0 THEN '{"id": "a/' || CAST(s_suppkey AS STRING) || CASE WHEN s_suppkey % 2 = 0 THEN ':free' ELSE '' END || '", "name": "A", "owned_by": "x", "context_length": 4096, "pricing": {"prompt": "0.1", "completion": "0.2"}, "architecture": {"modality": "text", "input_modalities": ["text", "image"]}, "supported_parameters": ["t", "p"]}'
  WHEN 1 THEN '{"name": "models/g' || CAST(s_suppkey AS STRING) || '", "displayName": "G", "inputTokenLimit": 100, "supportedGenerationMethods": ["generateContent", "count"]}'
  WHEN 2 THEN '{"name": "@cf/c' || CAST(s_suppkey AS STRING) || '", "task": {"name": "chat"}, "description": "d"}'
  WHEN 3 THEN '{"id": "h' || CAST(s_suppkey AS STRING) || '", "name": "H", "publisher": "p", "rate_limit_tier": "low", "summary": "s"}'
  ELSE '{"id": "ministral-' || CAST(s_suppkey AS STRING) || '", "capabilities": {"chat": true, "fim": false}, "max_context_length": 32}' END"""
_PROVIDER = "CASE s_suppkey % 5 WHEN 0 THEN 'router' WHEN 1 THEN 'google' WHEN 2 THEN 'cloudflare' WHEN 3 THEN 'github' ELSE 'mistral' END"


def _models(spark, sf_dir):
    return endpoints.flattened_models(I.table(spark, sf_dir, "supplier").selectExpr(f"{_PROVIDER} AS provider", "false AS all_free", f"{_MODEL} AS json"))


@query(
    f"""SELECT {_PROVIDER} AS provider, CASE s_suppkey % 5 WHEN 0 THEN 'a/' || s_suppkey || CASE WHEN s_suppkey % 2 = 0 THEN ':free' ELSE '' END WHEN 1 THEN 'models/g' || s_suppkey WHEN 2 THEN '@cf/c' || s_suppkey WHEN 3 THEN 'h' || s_suppkey ELSE 'ministral-' || s_suppkey END AS model_id,
  CASE s_suppkey % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'G' WHEN 2 THEN 'c' || s_suppkey WHEN 3 THEN 'H' ELSE 'ministral-' || s_suppkey END AS name,
  CASE s_suppkey % 5 WHEN 0 THEN 'x' WHEN 1 THEN 'Google' WHEN 2 THEN '' WHEN 3 THEN 'p' ELSE 'mistralai' END AS owned_by, s_suppkey % 5 <> 0 OR s_suppkey % 2 = 0 AS is_free,
  CASE s_suppkey % 5 WHEN 0 THEN '4096' WHEN 1 THEN '100' WHEN 4 THEN '32' ELSE '' END AS context_length,
  CASE s_suppkey % 5 WHEN 0 THEN 'text|image' WHEN 1 THEN 'generateContent|count' ELSE '' END AS input_modalities,
  CASE s_suppkey % 5 WHEN 0 THEN 't|p' WHEN 1 THEN 'generateContent|count' WHEN 4 THEN 'chat' ELSE '' END AS supported_parameters,
  CASE s_suppkey % 5 WHEN 0 THEN '0.1' WHEN 4 THEN '' ELSE '0' END AS prompt_price FROM supplier"""
)
def q_modellist_flatten(spark, sf_dir):
    return _models(spark, sf_dir).select("provider", "model_id", "name", "owned_by", "is_free", "context_length", "input_modalities", "supported_parameters", "prompt_price")


@query(f"SELECT {_PROVIDER} AS provider, count(*) FILTER (s_suppkey % 5 <> 0 OR s_suppkey % 2 = 0) AS free, count(*) FILTER (s_suppkey % 5 = 0 AND s_suppkey % 2 <> 0) AS paid FROM supplier GROUP BY 1")
def q_free_counts(spark, sf_dir):
    return endpoints.free_counts(_models(spark, sf_dir))


@query("SELECT DISTINCT ON (user_id) user_id, event_id, event_type FROM events ORDER BY user_id, value DESC, event_id")
def q_first_of_key(spark, sf_dir):
    """The ordered first row of each key: never an arbitrary one."""
    order = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id"))
    return I.table(spark, sf_dir, "events").withColumn("_n", order).where("_n = 1").select("user_id", "event_id", "event_type")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
