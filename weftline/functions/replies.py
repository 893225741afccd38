"""Reading model replies: tolerant JSON, coerced fields, error codes, rate-limit headers. Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ---------------------------------------------------------------------------------
DECISION = (
    "struct<is_correct: boolean, agree: boolean, best_index: string, reason: string, confidence: double, decision: string, "
    "hard_conflicts: array<string>, matched_fields: array<string>, mismatched_fields: array<string>>"
)
REJECT_PHRASES = ("different brand", "not the same", "mismatch", "incorrect", "wrong match", "different product", "different dosage", "different form", "different quantity")
ACCEPT_PHRASES = ("same product", "correct match", "identical", "is_correct", "matching", "same brand", "same dosage")
REQUIRED = ("confidence", "is_correct", "reason")
CLOSINGS = ("}", '"}', '"\n}')
#: Metric -> headers that may carry it, first one first.
HEADERS = {
    "quota_limit_minute": ("x-ratelimit-limit-requests-minute", "x-ratelimit-limit-minute", "x-rpm-limit", "x-ratelimit-limit-rpm"),
    "quota_remaining_minute": ("x-ratelimit-remaining-requests-minute", "x-ratelimit-remaining-minute", "x-rpm-remaining", "x-ratelimit-remaining-rpm"),
    "quota_reset_minute": ("x-ratelimit-reset-requests-minute", "x-ratelimit-reset-minute", "x-rpm-reset", "x-ratelimit-reset-rpm"),
    "quota_limit_day": ("x-ratelimit-limit-requests-day", "x-ratelimit-limit-day", "x-rpd-limit", "x-daily-limit"),
    "quota_remaining_day": ("x-ratelimit-remaining-requests-day", "x-ratelimit-remaining-day", "x-rpd-remaining", "x-daily-remaining"),
    "quota_reset_day": ("x-ratelimit-reset-requests-day", "x-ratelimit-reset-day", "x-rpd-reset", "x-daily-reset"),
    "rate_limit_requests": ("x-ratelimit-limit-requests", "ratelimit-limit", "x-ratelimit-limit"),
    "rate_remaining_requests": ("x-ratelimit-remaining-requests", "ratelimit-remaining", "x-ratelimit-remaining"),
    "rate_reset_requests": ("x-ratelimit-reset-requests", "ratelimit-reset", "x-ratelimit-reset"),
    "rate_limit_tokens": ("x-ratelimit-limit-tokens",),
    "rate_remaining_tokens": ("x-ratelimit-remaining-tokens",),
    "rate_reset_tokens": ("x-ratelimit-reset-tokens",),
    "retry_after": ("retry-after",),
}
# ---- end of fixed values --------------------------------------------------------------------------


def _object(text: Column) -> Column:
    """text if it is a JSON object, or null."""
    return F.when(F.try_parse_json(text).isNotNull() & text.rlike(r"(?s)^\s*\{.*\}\s*$"), text)


def recovered_json(text: Column) -> Column:
    """The JSON object in a reply as text: the whole reply, a fenced block, the first flat object, or a cut-off one
    with its end restored; else what can be read of three fields; else null."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    flat = F.regexp_extract(text, r"(?s)\{[^{}]*\}", 0)
    cut = F.when(F.locate("{", text) > 0, F.substr(text, F.locate("{", text)))
    verdict = F.lower(F.regexp_extract(cut, r'(?i)"is_correct"\s*:\s*(true|false)', 1))
    reason = F.regexp_extract(cut, r'"reason"\s*:\s*"([^"]*)"', 1)
    sure = F.coalesce(F.nullif(F.regexp_extract(cut, r'"confidence"\s*:\s*([\d.]+)', 1), F.lit("")).try_cast("double"), F.lit(0.5))
    fields = F.to_json(F.struct((verdict == "true").alias("is_correct"), reason.alias("reason"), sure.alias("confidence")))
    tries = [text, fenced, flat, *(F.concat(cut, F.lit(c)) for c in CLOSINGS)]
    return F.coalesce(*map(_object, tries), F.when(verdict != "", fields))


def decision(text: Column) -> Column:
    """The reply's fields as a struct, null if nothing can be read."""
    return F.from_json(recovered_json(text), DECISION)


def inferred_verdict(text: Column) -> Column:
    """Correct or not from phrases alone; rejects if in doubt."""
    low = F.lower(text)
    some = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(low, w))
    return ~some(REJECT_PHRASES) & some(ACCEPT_PHRASES)


def best_index(raw: Column, most: Column) -> Column:
    """An index in [0, most] given as a JSON integer or a string of digits, or null."""
    digits = F.trim(F.regexp_replace(raw, '^"|"$', ""))
    n = F.when(digits.rlike(r"^\d+$"), digits.try_cast("int"))
    return F.when(n.between(0, most), n)


def stated_confidence(confidence: Column, is_correct: Column) -> Column:
    """A reply's confidence; none, or 0, becomes .7 for an acceptance and .6 for a rejection, as 0 means a failed call."""
    return F.when(F.coalesce(confidence, F.lit(0.0)) == 0, F.when(F.coalesce(is_correct, F.lit(False)), 0.7).otherwise(0.6)).otherwise(confidence)


def error_code(status: Column, body: Column) -> Column:
    low = F.lower(F.coalesce(body, F.lit("")))
    failed = low.contains("failed_generation") | low.contains("failed to validate json") | low.contains('"code":"json_')
    return F.when((status == 400) & failed, "json_generation_failed").otherwise(F.concat(F.lit("http_"), status.cast("string")))


def missing_fields(text: Column) -> Column:
    """'ok', 'invalid_json' or which required fields a reply lacks."""
    found = recovered_json(text)
    lacking = F.array_except(F.array(*map(F.lit, REQUIRED)), F.json_object_keys(found))
    return F.when(found.isNull(), "invalid_json").when(F.size(lacking) == 0, "ok").otherwise(F.concat(F.lit("missing_fields:"), F.array_join(lacking, ",")))


def content(response: Column) -> Column:
    """The text of a chat response's first choice; parts of a list are joined."""
    parts = F.from_json(F.get_json_object(response, "$.choices[0].message.content"), "array<struct<text: string>>")
    whole = F.get_json_object(response, "$.choices[0].message.content")
    return F.coalesce(F.when(whole.rlike(r"^\s*\["), F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), "")), whole, F.lit(""))


def quota(headers: Column) -> dict[str, Column]:
    """Metric -> value of its first header that is present and not empty."""
    value = lambda h: F.nullif(F.trim(F.try_element_at(headers, F.lit(h))), F.lit(""))
    return {metric: F.coalesce(*map(value, names), F.lit("")) for metric, names in HEADERS.items()}


def duration(seconds: Column) -> Column:
    """'1d 2h 3m 4s' without its zero parts; '0s' at least."""
    s = F.greatest(F.lit(0), F.rint(seconds).cast("long"))
    part = lambda n, unit: F.when(n > 0, F.concat(n.cast("string"), F.lit(unit)))
    day, hour, minute = F.floor(s / 86400), F.floor(s % 86400 / 3600), F.floor(s % 3600 / 60)
    return F.coalesce(F.nullif(F.concat_ws(" ", part(day, "d"), part(hour, "h"), part(minute, "m"), part(s % 60, "s")), F.lit("")), F.lit("0s"))


def reset_in(value: Column, now: Column) -> Column:
    """Time until a reset that is given as epoch seconds, as seconds from now or as an ISO time; other text as is."""
    raw = F.trim(F.coalesce(value, F.lit("")))
    number = raw.try_cast("double")
    until = F.when(raw.rlike(r"^\d+$") & (number > 1_000_000_000), number - now).otherwise(number)
    at = F.try_to_timestamp(raw).cast("double") - now
    return F.when(raw == "", "").when(number.isNotNull(), duration(until)).when(at.isNotNull(), duration(at)).otherwise(raw)


def counted(text: Column) -> Column:
    """'1,200', '1.5K' and '2M' as doubles; null for other text."""
    bare = F.trim(F.replace(text, F.lit(","), F.lit("")))
    unit = F.upper(F.right(bare, F.lit(1)))
    factor = F.when(unit == "K", 1e3).when(unit == "M", 1e6).otherwise(1.0)
    return F.regexp_replace(bare, "[KkMm]$", "").try_cast("double") * factor


def masked(key: Column) -> Column:
    """No more than a key's last six characters."""
    return F.when(F.coalesce(key, F.lit("")) == "", "").otherwise(F.concat(F.lit("..."), F.right(key, F.lit(6))))


def listed(text: Column) -> Column:
    """The non-empty trimmed parts of a comma list."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def rendered(template: str, **values: Column) -> Column:
    """A template's $names replaced by values, null as ''; names without a value stay."""
    out = F.lit(template)
    for name in sorted(values, key=len, reverse=True):
        out = F.replace(out, F.lit(f"${name}"), F.coalesce(values[name].cast("string"), F.lit("")))
    return out
