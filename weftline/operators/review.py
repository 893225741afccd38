"""Selections for the assisted stages and the outcome of each, as filters and CASE expressions over results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


from weftline.functions.names import clean_brand
from weftline.functions.rounding import rounded
from weftline.functions.similarity import ratio_udf
from weftline.operators.compat import OK, Side
from weftline.operators.config import Matching

# ---- fixed values ---------------------------------------------------------------------------------
DANGEROUS = ("different_age_group", "different_flavor", "different_form", "different_product_class", "different_route", "different_weight")
FUZZY_METHODS = ("partial_token_sort_ratio", "token_set_ratio", "token_sort_ratio")
REVIEW_POLICIES = ("aggressive", "expanded", "review-candidates")
DECIDED = ("ai_confirmed", "ai_corrected", "ai_found", "ai_rejected")
ACCEPTED = ("ai_confirmed", "ai_corrected", "ai_found")
#: Least brand similarity by reason; of a reviewed mismatch; least score of a medicine's modifier mismatch.
BRAND_LEAST = {"different_brand": 80, "different_quantity": 86, "different_volume": 86}
SAFE_BRAND, MODIFIER_SCORE = 84, 75
# ---- end of fixed values --------------------------------------------------------------------------


def has_match(name: str = "matched_product_name_en") -> Column:
    return F.coalesce(F.col(name), F.lit("")) != ""


def brand_similarity(a: Column, b: Column) -> Column:
    """0 if a brand is missing, 100 if one contains the other, their ratio otherwise."""
    x, y = clean_brand(a), clean_brand(b)
    known = (x != "") & (y != "")
    inside = x.contains(y) | y.contains(x)
    ask = known & ~inside
    return F.when(~known, 0.0).when(inside, 100.0).otherwise(ratio_udf(F.when(ask, x), F.when(ask, y)))


def first_rows(df: DataFrame, limit: int | None) -> DataFrame:
    """The first rows by row_index: a top-n that is spread over tasks before it meets in one."""
    return df if limit is None else df.orderBy("row_index").limit(limit)


def verify_selection(results: DataFrame, cfg: Matching) -> DataFrame:
    """Matched rows that a policy sends to verification."""
    score, method = F.col("match_score"), F.coalesce("match_method", F.lit(""))
    weak = score < cfg.verify_threshold
    keep = {
        "all": F.lit(True),
        "all-non-exact": ~((method == "component_index") & F.coalesce(score >= 100, F.lit(False))),
        "fuzzy": F.coalesce(weak, F.lit(False)) | method.isin(*FUZZY_METHODS),
        "score": F.coalesce(weak, F.lit(False)),
    }[cfg.verify_policy]
    return first_rows(results.where(has_match() & keep), cfg.verify_limit)


def unmatched(results: DataFrame, limit: int | None = None) -> DataFrame:
    return first_rows(results.where(~has_match()), limit)


def review_selection(results: DataFrame, cfg: Matching) -> DataFrame:
    """Decisions to look at again: failed calls (confidence 0), unsure ones and flagged components."""
    sure = F.col("ai_confidence")
    flagged = ~F.lower(F.coalesce(F.col("_ai_component_reason"), F.lit(""))).isin("", "nan")
    return results.where(F.col("verified").isin(*DECIDED) & (F.coalesce((sure == 0) | ((sure > 0) & (sure < cfg.review_threshold)), F.lit(False)) | flagged))


def eligibility(results: DataFrame, cfg: Matching) -> DataFrame:
    """results with the assisted stage that a row may go to, and why."""
    score, weak = F.col("match_score"), F.col("match_score") < cfg.verify_threshold
    shown, gated = F.format_string("%.1f", rounded(score)), F.col("match_method").isin("too_short", "invalid_name")
    stage = F.when(has_match(), F.when(weak, "verify").otherwise("none")).when(gated, "none").otherwise("search")
    limit = F.lit(f"ai_threshold={cfg.verify_threshold}")
    why = (
        F.when(has_match() & weak, F.concat(F.lit("score="), shown, F.lit(" < "), limit, F.lit(" -> eligible for AI verify")))
        .when(has_match(), F.concat(F.lit("score="), shown, F.lit(" >= "), limit, F.lit(" -> strong match, no AI needed")))
        .when(gated, F.concat(F.col("match_method"), F.lit(" -> not eligible for AI")))
        .otherwise("no_match -> eligible for AI search")
    )
    return results.withColumns({"ai_stage": stage, "ai_reason": why})


def reviewable(pairs: DataFrame, cfg: Matching) -> DataFrame:
    """Judged pairs with `ok` and `reviewable`: whether a person or model may still accept a mismatch."""
    reason = F.col("reason")
    pairs = pairs.withColumn("_similar", brand_similarity(F.col("d_brand"), F.col("m_brand")))
    listed = reason.isin(*cfg.mismatch_reasons) & ~reason.isin(*DANGEROUS)
    enough = F.lit(True)
    for name, least in BRAND_LEAST.items():
        enough = F.when(reason == name, F.col("_similar") >= least).otherwise(enough)
    modifier = (reason == "different_modifier") & (F.col("d_product_class") == "medicine")
    enough = F.when(modifier, F.col("score") >= max(cfg.review_min_score, MODIFIER_SCORE)).otherwise(enough)
    return pairs.withColumns({"ok": reason == OK, "reviewable": (reason == OK) | (listed & enough)}).drop("_similar")


def eligible_candidates(candidates: DataFrame, cfg: Matching) -> DataFrame:
    """Safe candidates with the least score, and under a reviewing policy the first few reviewable ones, in order."""
    safe = F.col("ok") & (F.col("score") >= cfg.search_min_score)
    second = ~F.col("ok") & F.col("reviewable") & (F.col("score") >= cfg.review_min_score) & F.lit(cfg.search_policy in REVIEW_POLICIES)
    by = Window.partitionBy("row_index", "_second").orderBy("ord")
    out = candidates.withColumn("_second", second).withColumn("_n", F.row_number().over(by))
    out = out.where(safe | (F.col("_second") & (F.col("_n") <= cfg.review_candidates)))
    place = F.row_number().over(Window.partitionBy("row_index").orderBy("ord"))
    return out.withColumn("candidate", place).drop("_second", "_n")


def acceptance(cfg: Matching, picked: Column, ok: Column, may_review: Column, reason: Column) -> tuple[Column, Column]:
    """The least confidence for a picked candidate, and how it stands."""
    strict = max(cfg.search_confidence, cfg.review_confidence)
    least = F.when(~picked | ok, F.lit(cfg.search_confidence)).otherwise(F.lit(strict))
    state = F.when(~picked, "no_record").when(ok, OK).when(may_review, reason).otherwise("unsafe_component_mismatch")
    return least, state


def safe_reviewed(reason: Column, d: Side, m: Side) -> Column:
    """A brand mismatch of near brands whose other components don't contradict each other."""
    differ = lambda a, b: (a != "") & (b != "") & (a != b)
    doses = (F.size(d.dosage_nums) > 0) & (F.size(m.dosage_nums) > 0) & (d.dosage_nums != m.dosage_nums)
    clash = doses | differ(d.form, m.form) | differ(d.qty, m.qty) | differ(d.volume, m.volume)
    return reason.isin("brand_prefix_mismatch", "different_brand") & (brand_similarity(d.brand, m.brand) >= SAFE_BRAND) & ~clash


# ---- outcomes: a decision per row_index is joined and replaces columns ------------------------------

CLEARED = ("matched_product_name_en", "matched_product_name_ar", "matched_store_product_id")




def apply_verification(results: DataFrame, decisions: DataFrame) -> DataFrame:
    """decisions: row_index, is_correct, confidence and, for a better match, rec_* with pick_score, pick_confidence.

    A failed call counts as correct with confidence 0, which review_selection() picks up.
    """
    out = results.join(decisions, "row_index", "left")
    judged, right = F.col("is_correct").isNotNull(), F.col("is_correct")
    better = judged & ~right & F.col("rec_matched_store_product_id").isNotNull()
    gone = judged & ~right & ~better
    cols = {c: F.when(better, F.col(f"rec_{c}")).when(gone, "").otherwise(F.col(c)) for c in CLEARED}
    cols["match_score"] = F.when(better, F.col("pick_score")).when(~gone, F.col("match_score"))
    cols["_matched_price"] = F.when(better, F.col("rec_price")).when(~gone, F.col("_matched_price"))
    cols["verified"] = F.when(better, "ai_corrected").when(gone, "ai_rejected").when(judged, "ai_confirmed").otherwise(F.col("verified"))
    cols["match_method"] = F.when(judged, "ai_verified").otherwise(F.col("match_method"))
    cols["ai_confidence"] = F.when(better, F.col("pick_confidence")).when(judged, F.col("confidence")).otherwise(F.col("ai_confidence"))
    return out.withColumns(cols).select(*results.columns)


def apply_search(results: DataFrame, decisions: DataFrame) -> DataFrame:
    """decisions: row_index, accepted, confidence, state, error_code, pick_score and rec_*. Why a search found nothing stays
    in _ai_search_error."""
    results = results if "_ai_search_error" in results.columns else results.withColumn("_ai_search_error", F.lit(""))
    out = results.join(decisions, "row_index", "left")
    took = F.coalesce(F.col("accepted"), F.lit(False))
    cols = {c: F.when(took, F.col(f"rec_{c}")).otherwise(F.col(c)) for c in CLEARED}
    cols |= {
        "match_score": F.when(took, F.col("pick_score")).otherwise(F.col("match_score")),
        "_matched_price": F.when(took, F.col("rec_price")).otherwise(F.col("_matched_price")),
        "verified": F.when(took, "ai_found").otherwise(F.col("verified")),
        "match_method": F.when(took, "ai_search").otherwise(F.col("match_method")),
        "ai_confidence": F.when(took, F.col("confidence")).otherwise(F.col("ai_confidence")),
        "_ai_component_reason": F.when(took & (F.col("state") != OK), F.col("state")).otherwise(F.col("_ai_component_reason")),
        "_ai_search_error": F.when(F.col("error_code").isNotNull(), F.col("error_code")).otherwise(F.coalesce("_ai_search_error", F.lit(""))),
    }
    return out.withColumns(cols).select(*results.columns)


def search_error(cfg_least: Column, confidence: Column, result: Column, error: Column, parse_failed: Column, best_index: Column) -> Column:
    """Why a search found nothing."""
    return (
        F.when(result.isNull(), "no_ai_result")
        .when(F.coalesce(error, F.lit("")) != "", error)
        .when(parse_failed, "invalid_json")
        .when(F.coalesce(best_index, F.lit(0)) == 0, "best_index_0")
        .when(confidence < cfg_least, "confidence_below_threshold")
        .otherwise("no_record")
    )


def review_outcome(cfg: Matching) -> Column:
    """What a second decision makes of a row; columns verified, api_failed, is_correct, review_confidence, flagged,
    safe, picked. Agreeing with a rejection counts as `is_correct` false, so it leads to a new search: kept as is.
    """
    sure = F.coalesce(F.col("review_confidence"), F.lit(0.0))
    right, first = F.col("is_correct"), F.col("verified")
    strict = max(cfg.override_confidence, cfg.review_confidence)
    return (
        F.when(F.col("api_failed"), F.when(right & (sure >= cfg.override_confidence), "ai_confirmed").otherwise("ai_review_rejected"))
        .when(F.col("flagged") & first.isin(*ACCEPTED) & (~right | (sure < strict) | ~F.col("safe")), "ai_review_rejected")
        .when(right, F.concat(first, F.lit("_reviewed")))
        .when(sure < cfg.override_confidence, first)
        .when(first.isin(*ACCEPTED), "ai_review_rejected")
        .when((first == "ai_rejected") & F.col("picked"), "ai_review_corrected")
        .otherwise(first)
    )


def apply_review(results: DataFrame, decisions: DataFrame, cfg: Matching) -> DataFrame:
    """decisions: row_index, api_failed, is_correct, review_confidence, flagged, safe, picked, pick_score,
    pick_confidence and rec_*."""
    out = results.join(decisions, "row_index", "left")
    judged = F.col("is_correct").isNotNull()
    out = out.withColumn("_new", F.when(judged, review_outcome(cfg)))
    new, first = F.col("_new"), F.col("verified")
    gone, taken = new == "ai_review_rejected", new == "ai_review_corrected"
    fresh = F.col("api_failed") & (new == "ai_confirmed")
    is_ = lambda c: F.coalesce(c, F.lit(False))
    cols = {c: F.when(is_(taken), F.col(f"rec_{c}")).when(is_(gone), "").otherwise(F.col(c)) for c in CLEARED}
    cols |= {
        "match_score": F.when(is_(taken), F.col("pick_score")).when(~is_(gone), F.col("match_score")),
        "_matched_price": F.when(is_(taken), F.col("rec_price")).when(~is_(gone), F.col("_matched_price")),
        "verified": F.coalesce(new, first),
        "match_method": F.when(is_(gone) | is_(taken), "ai_reviewed").when(is_(fresh), "ai_verified").otherwise(F.col("match_method")),
        "ai_confidence": F.when(is_(taken), F.col("pick_confidence")).when(is_(fresh), F.col("review_confidence")).otherwise(F.col("ai_confidence")),
        "ai_review_confidence": F.when(judged, F.coalesce("review_confidence", F.lit(0.0))).otherwise(F.col("ai_review_confidence")),
    }
    return out.withColumns(cols).select(*results.columns)
