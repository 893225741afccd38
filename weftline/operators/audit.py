"""Counts, comparisons of runs and summaries of traces: aggregations over results and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.names import with_components
from weftline.operators.compat import OK, verdict
from weftline.operators.review import has_match
from weftline.sources.tables import scratch

# ---- fixed values ---------------------------------------------------------------------------------
SCORE_BANDS = (("100", 100, 101), ("95-99", 95, 100), ("90-94", 90, 95), ("80-89", 80, 90), ("70-79", 70, 80))
RESULT_STEPS = ("ai_review_result", "ai_search_result", "ai_verify_result")
REJECTED = ("ai_rejected", "ai_review_rejected", "not_found", "ai_rejected_kept_low_confidence_review")
FOUND = ("ai_confirmed", "ai_corrected", "ai_found")
TRACE_COLUMNS = ("phase", "decision", "error_code", "component_reason")
# ---- end of fixed values --------------------------------------------------------------------------


def match_counts(results: DataFrame) -> DataFrame:
    total, matched = F.count("*"), F.count_if(has_match())
    share = lambda n: F.try_divide(n * 100.0, total)
    return results.agg(total.alias("total"), matched.alias("matched"), (total - matched).alias("unmatched"), share(matched).alias("matched_pct"), share(total - matched).alias("unmatched_pct"))


def score_histogram(results: DataFrame) -> DataFrame:
    """Matched rows by score band; under 70 is one band."""
    score = F.col("match_score")
    band = F.when(score < 70, "<70")
    for name, low, high in SCORE_BANDS:
        band = F.when((score >= low) & (score < high), name).otherwise(band)
    return results.where(has_match()).groupBy(band.alias("band")).agg(F.count("*").alias("n")).where("band IS NOT NULL")


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows by value, nulls a group of their own; with top, the most frequent ones, ties by value."""
    out = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return out if top is None else out.orderBy(F.desc("n"), F.asc_nulls_first("value")).limit(top)


def component_audit(results: DataFrame) -> DataFrame:
    """Matches whose names fail the component check, with the reason."""
    rows = with_components(results.where(has_match()), "drug_name", "d_")
    rows = verdict(scratch(with_components(scratch(rows, "audit-left"), "matched_product_name_en", "m_"), "audit-both"))
    return rows.where(F.col("reason") != OK).select("code", "drug_name", "matched_product_name_en", "match_method", "verified", "reason")


def component_audit_counts(audit: DataFrame, sample: int = 20) -> tuple[DataFrame, DataFrame]:
    """Of component_audit(): rows by reason, most frequent first, and the first rows by code."""
    return value_counts(audit, "reason", 12), audit.orderBy(F.asc_nulls_first("code"), "reason").limit(sample)


def run_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of both runs by code (unique in each): what changed."""
    side = lambda df, p: df.select(F.col("code"), has_match().alias(p + "_match"), F.col("matched_store_product_id").cast("string").alias(p + "_id"))
    both = side(before, "b").join(side(after, "a"), "code")
    change = F.when(~F.col("b_match") & F.col("a_match"), "newly_matched").when(F.col("b_match") & ~F.col("a_match"), "newly_unmatched").when(F.col("b_match") & F.col("a_match") & (F.col("b_id") != F.col("a_id")), "changed_store_product_id")
    return both.withColumn("change", change)


def delta_counts(delta: DataFrame) -> DataFrame:
    kinds = ("newly_matched", "newly_unmatched", "changed_store_product_id")
    return delta.agg(F.count("*").alias("shared_rows"), *(F.count_if(F.col("change") == k).alias(k) for k in kinds))


def ai_status(result: Column) -> Column:
    """What an assisted result means for the row: matched, rejected or neither ('')."""
    base = F.regexp_replace(result, "(_reviewed|_kept_low_confidence_review)$", "")
    good = base.isin(*FOUND) | (result == "ai_review_corrected")
    return F.when(result.isin(*REJECTED), "rejected").when(good, "matched").otherwise("")


def trace_summary(events: DataFrame) -> DataFrame:
    """One row for each (drug_code, drug_name): the last events by seq decide.

    Every `last` is max_by over a condition, so events are aggregated before the shuffle.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = events.where((text("drug_code") != "") | (text("drug_name") != ""))
    fields = ("error_stage", "error_code", "reject_rule", "selection_reason", "candidate_name", "final_match", "ai_result")
    whole = F.struct(*(text(c).alias(c) for c in fields))
    last = lambda value, cond: F.max_by(F.when(cond, value), F.when(cond, F.col("seq")))
    turned_down = (text("decision") == "rejected") | (text("reject_rule") != "")
    named = F.when(text("candidate_name") != "", text("candidate_name")).when(~text("final_match").isin("", "NONE"), text("final_match"))
    model = F.coalesce(F.nullif(text("model_used"), F.lit("")), text("ai_model"))
    out = rows.groupBy(text("drug_code").alias("code"), text("drug_name").alias("drug_name")).agg(
        last(whole, F.col("step") == "final").alias("final"),
        last(whole, F.col("step").isin(*RESULT_STEPS)).alias("ai"),
        last(whole, turned_down).alias("rejected"),
        last(whole, F.lit(True)).alias("any"),
        last(text("ai_result"), text("ai_result") != "").alias("ai_action"),
        last(named, named.isNotNull()).alias("named"),
        last(F.concat(text("provider_used"), F.lit("/"), model), (text("provider_used") != "") | (model != "")).alias("who"),
    )
    told = F.coalesce(ai_status(F.col("ai.ai_result")), F.lit(""))
    final = F.col("final.final_match")
    status = F.when(told == "rejected", "no_match").when(told == "matched", "matched").when(final.isNotNull(), F.when(final != "NONE", "matched").otherwise("no_match")).otherwise("unknown")
    match = F.when(told == "rejected", "NONE").when(told == "matched", F.coalesce(F.nullif(F.col("ai.candidate_name"), F.lit("")), F.col("named"), F.lit(""))).otherwise(F.coalesce(final, F.lit("")))
    first = F.coalesce("rejected", "final", "any")
    stage = F.when(first["error_stage"] != "", first["error_stage"]).when(F.col("final_status") == "no_match", "matching").otherwise("")
    reason = F.coalesce(*(F.nullif(first[c], F.lit("")) for c in ("error_code", "reject_rule", "selection_reason")), F.lit(""))
    out = out.withColumn("final_status", status).withColumn("final_match", match)
    return out.select(
        "code", "drug_name", "final_status", "final_match", stage.alias("failure_stage"), reason.alias("primary_reason"),
        F.coalesce(F.col("rejected.candidate_name"), F.lit("")).alias("best_rejected_candidate"),
        F.coalesce("ai_action", F.lit("")).alias("ai_action"),
        F.coalesce(F.regexp_replace("who", "^/+|/+$", ""), F.lit("")).alias("ai_provider_model"),
    )


def trace_text(events: DataFrame) -> DataFrame:
    """A line for each event, in order: `seq | step | drug | decision | detail`."""
    c = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("-"))
    return events.orderBy("seq").select(F.concat_ws(" | ", c("seq"), c("step"), c("drug_name"), c("decision"), c("selection_reason")).alias("value"))


def failure_histogram(rows: DataFrame) -> DataFrame:
    """Failed health rows by error type."""
    kind = F.coalesce(F.nullif(F.col("error_type"), F.lit("")), F.lit("unknown"))
    return rows.where(~F.coalesce(F.col("ok"), F.lit(False))).groupBy(kind.alias("error_type")).agg(F.count("*").alias("n"))


def model_accuracy(cases: DataFrame, by: str = "model") -> DataFrame:
    """cases: model, expected, got, api_failed. Failed calls don't count; an empty class has accuracy 0."""
    valid = ~F.coalesce(F.col("api_failed"), F.lit(False))
    hit = valid & (F.col("expected") == F.col("got"))
    share = lambda n, of: F.coalesce(F.try_divide(n.cast("double"), of.cast("double")), F.lit(0.0))
    of = lambda expected: (F.count_if(hit & (F.col("expected") == expected)), F.count_if(valid & (F.col("expected") == expected)))
    return cases.groupBy(by).agg(
        F.count("*").alias("total"), F.count_if(valid).alias("valid_count"), F.count_if(~valid).alias("api_failed_count"), F.count_if(hit).alias("correct_count"),
        share(F.count_if(hit), F.count_if(valid)).alias("accuracy"), share(*of(True)).alias("match_accuracy"), share(*of(False)).alias("reject_accuracy"),
    )


def markdown_report(accuracy: DataFrame, title: str, elapsed: str = "elapsed") -> list[str]:
    """A benchmark as Markdown: models ranked, and the best of all, of the free and of the paid ones. One row a model."""
    rows = [r.asDict() for r in ranked_models(accuracy, elapsed).orderBy("place").collect()]
    out = [f"# {title}", "", "| # | Model | Accuracy | Should match | Should reject | Failed calls | Seconds |", "|-|-|-|-|-|-|-|"]
    share = lambda x: f"{100 * x:.0f} %"
    out += [f"| {r['place']} | `{r['model']}` | {share(r['accuracy'])} ({r['correct_count']}/{r['valid_count']}) | {share(r['match_accuracy'])} | {share(r['reject_accuracy'])} | {r['api_failed_count']}/{r['total']} | {r[elapsed]} |" for r in rows]
    for label, some in (("Best", rows), ("Best free", [r for r in rows if ":free" in r["model"]]), ("Best paid", [r for r in rows if ":free" not in r["model"]])):
        if some:
            out += ["", f"{label}: `{some[0]['model']}`, {share(some[0]['accuracy'])}"]
    return out


def comparison_report(before: DataFrame, after: DataFrame, top: int = 15) -> list[str]:
    """Two runs as text: counts of each, what changed, component failures by reason with a sample. Bounded by `top`."""
    out: list[str] = []
    for label, rows in (("before", before), ("after", after)):
        out += [f"{label}: " + ", ".join(f"{k}={v}" for k, v in match_counts(rows).first().asDict().items())]
        for column in ("match_method", "verified"):
            out += [f"  {column} {r['value']}: {r['n']}" for r in value_counts(rows, column, top).collect()]
        counts, sample = component_audit_counts(scratch(component_audit(rows), "audit-rows"))
        out += [f"{label} component audit, {r['value']}: {r['n']}" for r in counts.collect()]
        out += [f"  {r['code']}: {r['drug_name']} -> {r['matched_product_name_en']} ({r['match_method']}, {r['verified']}, {r['reason']})" for r in sample.collect()]
    return [*out, "changes: " + ", ".join(f"{k}={v}" for k, v in delta_counts(run_delta(before, after)).first().asDict().items())]


def status_pairs(results: DataFrame, columns: tuple[str, str] = ("verified", "match_method"), top: int = 15) -> DataFrame:
    """The most frequent pairs of values of two columns."""
    return results.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *(F.asc_nulls_first(c) for c in columns)).limit(top)


def phase_statistics(results: DataFrame) -> DataFrame:
    return results.agg(*(F.count_if(F.col("verified").startswith(v)).alias(v) for v in ("ai_confirmed", "ai_corrected", "ai_rejected", "ai_found")), F.count_if(F.col("verified") == "ai_review_rejected").alias("ai_overridden"))


def ranked_models(accuracy: DataFrame, elapsed: str = "elapsed") -> DataFrame:
    """Best accuracy first, then the faster, then by name: a total order."""
    return accuracy.withColumn("place", F.row_number().over(Window.orderBy(F.desc("accuracy"), F.asc(elapsed), F.asc("model"))))
