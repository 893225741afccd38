"""Model endpoints: tiers, ranking, round robin, health classes, model lists. Small tables, relational all the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions.replies import counted

# ---- fixed values ---------------------------------------------------------------------------------
DEGRADED = ("invalid_json", "null_content", "response_not_json", "response_shape")
STATUS_TIER = {"working": 0, "degraded": 1, "quota-limited": 2, "permission-failed": 3, "model-not-accessible": 4, "failed": 5}
STATUS_ADVICE = {
    "working": "use-first", "degraded": "late-retry", "quota-limited": "last-choice-quota", "permission-failed": "last-choice-permission",
    "model-not-accessible": "last-choice-model-access", "failed": "last-choice",
}
PERMANENT = ("model-not-accessible", "permission-failed")
NO_SUCH_MODEL = ("model_not_found", "does not exist", "no such model")
QUOTA_COLUMNS = ("rate_remaining_requests", "quota_remaining_day", "quota_remaining_minute", "rate_remaining_tokens")
ATTEMPT_KEY = ("provider", "key_suffix", "model")
FREE_MARKS = (":free", "-free")
MISTRAL_FREE = ("codestral", "ministral", "mistral-small")
DESCRIPTION = 500
# ---- end of fixed values --------------------------------------------------------------------------


def model_tier(rank: Column, models: Column) -> Column:
    """Thirds of a provider's models by rank, rounded up."""
    first, second = F.floor((models + 2) / 3), F.floor((2 * models + 2) / 3)
    return F.when(models <= 0, 3).when(rank <= first, 1).when(rank <= second, 2).otherwise(3)


def _quality(rank: Column, other: int) -> Column:
    return F.coalesce(F.nullif(rank, F.lit(0)), F.lit(other))


def health_status(df: DataFrame) -> Column:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    error, status, message = text("error_type"), text("http_status"), F.lower(text("error_message"))
    lost = F.lit(False)
    for phrase in NO_SUCH_MODEL:
        lost = lost | message.contains(phrase)
    return (
        F.when(F.coalesce(F.col("ok"), F.lit(False)), "working")
        .when((error == "TimeoutError") | error.isin(*DEGRADED) | error.contains("invalid_json") | error.startswith("missing_fields:"), "degraded")
        .when((status == "429") | (error == "http_429"), "quota-limited")
        .when((status == "403") | (error == "http_403"), "permission-failed")
        .when((status == "404") | (error == "http_404") | lost, "model-not-accessible")
        .otherwise("failed")
    )


def _looked_up(table: dict, key: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), key)


def quota_remaining() -> Column:
    """The first of four metrics that reads as a number; 0 if none does."""
    return F.coalesce(*(counted(F.col(c).cast("string")) for c in QUOTA_COLUMNS), F.lit(0.0))


def classified(rows: DataFrame) -> DataFrame:
    """Health rows with status, fallback tier, advice, remaining quota and a score."""
    rows = rows.withColumn("health_status", health_status(rows)).withColumn("quota", quota_remaining())
    tier, rank = _quality(F.col("rotation_tier"), 3), F.col("quality_rank")
    latency = F.greatest(F.lit(0.0), 20.0 - _quality(F.col("elapsed_s"), 20))
    score = F.greatest(F.lit(0.0), 40.0 - tier * 10.0) + F.greatest(F.lit(0.0), 80.0 - _quality(rank, 100) * 5.0) + F.least("quota", F.lit(1000.0)) / 20.0 + latency
    return rows.withColumns({
        "fallback_tier": _looked_up(STATUS_TIER, F.col("health_status")),
        "rotation_recommendation": _looked_up(STATUS_ADVICE, F.col("health_status")),
        "rotation_score": F.when(F.coalesce(F.col("ok"), F.lit(False)), score).otherwise(0.0),
    })


def ranked_health(rows: DataFrame) -> DataFrame:
    """Classified rows with their rank. All rows meet in one task: there is one for each endpoint probed."""
    order = Window.orderBy("fallback_tier", _quality(F.col("rotation_tier"), 3), _quality(F.col("quality_rank"), 999), F.desc("quota"), _quality(F.col("elapsed_s"), 9999), F.coalesce("provider", F.lit("")), F.coalesce("model", F.lit("")))
    return classified(rows).withColumn("rotation_rank", F.row_number().over(order))


def ranked_attempts(attempts: DataFrame, providers: tuple[str, ...]) -> DataFrame:
    """Attempts in the order in which they are tried; unknown providers come last."""
    place = F.array_position(F.array(*map(F.lit, providers)), F.col("provider"))
    order = Window.orderBy(
        ~F.col("eligible"), F.coalesce("disabled_until", F.lit("")) != "", "rotation_tier", "quality_rank",
        F.desc(F.coalesce("quota_remaining", F.lit(0.0))), "latency", F.when(place > 0, place).otherwise(len(providers) + 1), "provider", "model",
    )
    return attempts.withColumn("place", F.row_number().over(order))


def round_robin(attempts: DataFrame, budget: int, tier_limit: int = 3) -> DataFrame:
    """One attempt of each provider in turn, tier by tier, up to a budget. attempts has `place`, its own order."""
    turn = F.row_number().over(Window.partitionBy("rotation_tier", "provider").orderBy("place"))
    rows = attempts.where(F.col("rotation_tier") <= max(1, tier_limit)).withColumn("turn", turn)
    picked = F.row_number().over(Window.orderBy("rotation_tier", "turn", "provider"))
    return rows.withColumn("picked", picked).where(F.col("picked") <= budget)


def rotated(attempts: DataFrame, cursor: int) -> DataFrame:
    """Attempts of a tier from a cursor on, cyclically. attempts has `place` from 1."""
    n = F.count("*").over(Window.partitionBy("rotation_tier"))
    within = F.row_number().over(Window.partitionBy("rotation_tier").orderBy("place")) - 1
    return attempts.withColumn("position", F.pmod(within - cursor, n))


def untested(attempts: DataFrame, rows: DataFrame) -> DataFrame:
    """Attempts that no row of mode `json` has tested."""
    return attempts.join(rows.where(F.col("mode") == "json").select(*ATTEMPT_KEY), list(ATTEMPT_KEY), "left_anti")


def attempts_by_health(attempts: DataFrame, rows: DataFrame) -> DataFrame:
    """Attempts with healthy ones first, then untested, transiently and permanently failed; each once, at its best."""
    tested = classified(rows.where(F.col("mode") == "json")).select(*ATTEMPT_KEY, F.when(F.col("ok"), 0).when(F.col("health_status").isin(*PERMANENT), 3).otherwise(2).alias("priority"), F.col("seq"))
    order = Window.partitionBy(*ATTEMPT_KEY).orderBy("priority", "seq")
    known = attempts.join(tested, list(ATTEMPT_KEY)).withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    fresh = untested(attempts, rows).withColumns({"priority": F.lit(1), "seq": F.col("place").cast("long")})
    return known.unionByName(fresh, allowMissingColumns=True)


def cached_working(attempts: DataFrame, rows: DataFrame, limit: int) -> DataFrame:
    """The best-ranked attempts that worked when last tested."""
    good = ranked_health(rows).where((F.col("mode") == "json") & F.col("ok")).select(*ATTEMPT_KEY, "rotation_rank")
    best = attempts.join(good.groupBy(*ATTEMPT_KEY).agg(F.min("rotation_rank").alias("rotation_rank")), list(ATTEMPT_KEY))
    return best.orderBy("rotation_rank").limit(limit)


def enough_healthy(rows: DataFrame, min_rows: int, min_providers: int) -> DataFrame:
    good = rows.where(F.col("ok"))
    return good.agg(F.count("*").alias("healthy"), F.count_distinct("provider").alias("providers")).withColumn("enough", (F.col("healthy") >= min_rows) & (F.col("providers") >= min_providers))


# ---- preflight: which attempts to probe, and which to use then ----------------------------------------

PREFLIGHT_POLICIES = ("smart", "full", "off")


def preflight_selection(attempts: DataFrame, rows: DataFrame, policy: str = "smart", budget: int = 60, refresh: int = 10, tier_limit: int = 1) -> DataFrame:
    """Attempts to probe. smart: the best that worked last time (at most `refresh`), then others in turn up to the budget;
    full: all; off: none. rows: health rows of earlier probes."""
    if policy != "smart":
        return attempts if policy == "full" else attempts.limit(0)
    cached = cached_working(attempts, rows, min(refresh, budget)).select(*ATTEMPT_KEY, "rotation_rank")
    others = attempts.join(cached, list(ATTEMPT_KEY), "left_anti")
    known = attempts.join(cached, list(ATTEMPT_KEY)).withColumn("picked", F.row_number().over(Window.orderBy("rotation_rank")))
    both = known.select(*attempts.columns, F.lit(0).alias("_late"), "picked").unionByName(round_robin(others, budget, tier_limit).select(*attempts.columns, F.lit(1).alias("_late"), "picked"))
    return both.orderBy("_late", "picked").limit(budget).drop("_late", "picked")


def preflight_plan(attempts: DataFrame, tested: DataFrame, rows: DataFrame, policy: str = "smart") -> DataFrame:
    """The plan after a probe: off leaves it, full keeps what worked, smart puts what worked first and what failed last."""
    if policy == "off":
        return attempts.withColumn("order", F.col("place"))
    if policy == "full":
        good = ranked_health(tested).where((F.col("mode") == "json") & F.col("ok")).groupBy(*ATTEMPT_KEY).agg(F.min("rotation_rank").alias("order"))
        return attempts.join(good, list(ATTEMPT_KEY))
    known = attempts_by_health(attempts, tested.unionByName(rows, allowMissingColumns=True))
    return known.withColumn("order", F.row_number().over(Window.orderBy("priority", "place"))).select(*attempts.columns, "order")


# ---- model lists ------------------------------------------------------------------------------------

MODEL_COLUMNS = ("provider", "model_id", "name", "owned_by", "is_free", "prompt_price", "completion_price", "context_length", "modality", "input_modalities", "output_modalities", "max_completion_tokens", "per_request_limits", "supported_parameters", "active", "description")


def is_free(model_id: Column, prompt: Column, completion: Column, all_free: Column) -> Column:
    marked = model_id.contains(FREE_MARKS[0]) | model_id.endswith(FREE_MARKS[1])
    return all_free | marked | ((F.coalesce(prompt, F.lit("N/A")) == "0") & (F.coalesce(completion, F.lit("N/A")) == "0"))


def flattened_models(models: DataFrame) -> DataFrame:
    """models: provider, all_free, json (one model of a provider's list) -> MODEL_COLUMNS.

    A provider's shape is a CASE over paths, so one pass serves all providers.
    """
    at = lambda path: F.coalesce(F.get_json_object("json", "$." + path), F.lit(""))
    piped = lambda path: F.array_join(F.from_json(F.get_json_object("json", "$." + path), "array<string>"), "|")
    provider = F.col("provider")

    def by(default: Column, **special: Column) -> Column:
        out = F.when(F.lit(False), default)
        for name, value in special.items():
            out = out.when(provider == name, value)
        return F.coalesce(out.otherwise(default), F.lit(""))

    free_list = provider.isin("google", "cloudflare", "github")
    price = lambda kind: F.when(free_list, "0").when(provider == "mistral", "").otherwise(F.coalesce(F.get_json_object("json", f"$.pricing.{kind}"), F.lit("N/A")))
    none = F.lit("")
    model_id = by(at("id"), google=at("name"), cloudflare=at("name"))
    capabilities = F.from_json(F.get_json_object("json", "$.capabilities"), "map<string, boolean>")
    able = F.array_join(F.map_keys(F.map_filter(capabilities, lambda _, v: v)), "|")
    generates = F.contains(piped("supportedGenerationMethods"), F.lit("generateContent"))
    mistral_free = F.lower(model_id).contains("free")
    for start in MISTRAL_FREE:
        mistral_free = mistral_free | model_id.startswith(start)
    free = F.when(free_list, True).when(provider == "mistral", mistral_free).otherwise(is_free(model_id, F.get_json_object("json", "$.pricing.prompt"), F.get_json_object("json", "$.pricing.completion"), F.col("all_free")))
    window = F.coalesce(F.nullif(at("context_length"), F.lit("")), at("context_window"))
    return models.select(
        provider.alias("provider"), model_id.alias("model_id"),
        by(at("name"), google=at("displayName"), cloudflare=F.replace(at("name"), F.lit("@cf/"), F.lit("")), mistral=F.coalesce(F.get_json_object("json", "$.name"), model_id)).alias("name"),
        by(at("owned_by"), google=F.lit("Google"), cloudflare=none, github=at("publisher"), mistral=F.coalesce(F.get_json_object("json", "$.owned_by"), F.lit("mistralai"))).alias("owned_by"),
        free.alias("is_free"), price("prompt").alias("prompt_price"), price("completion").alias("completion_price"),
        by(window, google=at("inputTokenLimit"), cloudflare=none, github=none, mistral=at("max_context_length")).alias("context_length"),
        by(at("architecture.modality"), google=F.lit("text+image+audio+video->text"), cloudflare=at("task.name"), github=none, mistral=none).alias("modality"),
        by(piped("architecture.input_modalities"), google=piped("supportedGenerationMethods"), cloudflare=none, github=piped("supported_input_modalities"), mistral=none).alias("input_modalities"),
        by(piped("architecture.output_modalities"), google=F.lit("text"), cloudflare=none, github=piped("supported_output_modalities"), mistral=none).alias("output_modalities"),
        by(F.coalesce(F.nullif(at("max_completion_tokens"), F.lit("")), at("top_provider.max_completion_tokens")), google=at("outputTokenLimit"), cloudflare=none, github=none, mistral=at("max_output_tokens")).alias("max_completion_tokens"),
        by(at("per_request_limits"), google=none, cloudflare=none, github=at("rate_limit_tier"), mistral=none).alias("per_request_limits"),
        by(piped("supported_parameters"), google=piped("supportedGenerationMethods"), cloudflare=none, github=none, mistral=able).alias("supported_parameters"),
        by(at("active"), google=F.when(generates, "true").otherwise("false"), cloudflare=F.lit("true"), github=F.lit("true"), mistral=F.lit("true")).alias("active"),
        F.substring(by(at("description"), github=at("summary")), 1, DESCRIPTION).alias("description"),
    )


def fetched_models(spark: SparkSession, lists: dict[str, list[str]], all_free: frozenset[str] = frozenset()) -> DataFrame:
    """Provider lists that the driver fetched, as rows for flattened_models()."""
    rows = [(p, p in all_free, j) for p, models in lists.items() for j in models]
    return spark.createDataFrame(rows, "provider string, all_free boolean, json string")


def free_counts(models: DataFrame) -> DataFrame:
    return models.groupBy("provider").agg(F.count_if("is_free").alias("free"), F.count_if(~F.col("is_free")).alias("paid"))
