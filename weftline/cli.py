"""python -m weftline.cli match|verify INVENTORY.csv CATALOG.csv: the pipeline over two files.

`match` runs the cascade and, unless --no-ai is given, verification, search and review; `verify` always asks. The
answers come from the endpoints of --plan (see sources.plan) or, without one, from the offline stub.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import urllib.error
import urllib.request
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from weftline.operators import audit, decide, matching, trace
from weftline.operators.config import SEARCH_POLICIES, Matching, with_policy
from weftline.operators.endpoints import PREFLIGHT_POLICIES
from weftline.operators.rotation import Answer, Breaker, Endpoint, RotatingClient, readable
from weftline.sources import plan as plans
from weftline.sources import tables

LOG = logging.getLogger("weftline")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="weftline", description=__doc__)
    stages = out.add_subparsers(dest="stage", required=True)
    for name in ("match", "verify"):
        p = stages.add_parser(name)
        p.add_argument("inventory")
        p.add_argument("catalog")
        # fixed values: options and their defaults
        for flag, kind, default in (
            ("--limit", int, None), ("--start", int, None), ("--end", int, None), ("--threshold", float, 80), ("--ai-threshold", float, 90.0), ("--ai-verify-limit", int, None), ("--output", str, "output"),
            ("--model", str, None), ("--provider", str, None), ("--api-key", str, None), ("--review-model", str, None), ("--review-threshold", float, None), ("--ai-search-min-candidate-score", float, None),
            ("--ai-search-accept-confidence", float, None), ("--ai-search-candidate-limit", int, None), ("--ai-search-review-candidate-min-score", float, 68.0), ("--ai-search-review-accept-confidence", float, 0.85),
            ("--ai-search-review-candidate-limit", int, 8), ("--plan", str, None), ("--env", str, ".env"), ("--concurrency", int, 5),
        ):
            p.add_argument(flag, type=kind, default=default)
        p.add_argument("--resume", action="store_true")
        p.add_argument("--trace", action="store_true")
        p.add_argument("--log-level", default="INFO", choices=["DEBUG", "INFO", "WARNING", "ERROR"])
        p.add_argument("--ai-verify-policy", default="score", choices=["score", "fuzzy", "all-non-exact", "all"])
        p.add_argument("--ai-search-policy", default="review-candidates", choices=sorted(SEARCH_POLICIES))
        if name == "match":
            p.add_argument("--no-ai", action="store_true")
            p.add_argument("--no-ai-preflight", action="store_true")
            p.add_argument("--rotation-preflight-policy", default="smart", choices=PREFLIGHT_POLICIES)
            for flag, kind, default in (
                ("--ai-timeout", float, 10.0), ("--ai-search-limit", int, None), ("--rotation-preflight-budget", int, 60), ("--rotation-preflight-min-healthy", int, 24), ("--rotation-preflight-min-providers", int, 3),
                ("--rotation-preflight-tier-limit", int, 1), ("--rotation-preflight-cache-ttl", float, 21600.0), ("--rotation-preflight-refresh", int, 10),
            ):
                p.add_argument(flag, type=kind, default=default)
    return out


def settings(args: argparse.Namespace) -> Matching:
    cfg = replace(
        Matching(), fuzzy_threshold=args.threshold, top_k=10, verify_threshold=args.ai_threshold, verify_policy=args.ai_verify_policy, verify_limit=args.ai_verify_limit,
        review_threshold=0.95 if args.review_threshold is None else args.review_threshold, review_min_score=args.ai_search_review_candidate_min_score,
        review_confidence=args.ai_search_review_accept_confidence, review_candidates=args.ai_search_review_candidate_limit,
    )
    return with_policy(cfg, args.ai_search_policy, args.ai_search_min_candidate_score, args.ai_search_accept_confidence, args.ai_search_candidate_limit)


def http(endpoint: Endpoint, prompt: str, timeout: float = 30.0) -> Answer:
    """One chat request in the common format."""
    body = json.dumps({"model": endpoint.model, "messages": [{"role": "user", "content": prompt}], "max_tokens": 512, "temperature": 0.1}).encode()
    ask = urllib.request.Request(f"{endpoint.url}/chat/completions", body, {"Content-Type": "application/json", "Authorization": f"Bearer {endpoint.key}"})
    try:
        with urllib.request.urlopen(ask, timeout=timeout) as got:
            return Answer(got.status, json.load(got)["choices"][0]["message"].get("content"))
    except urllib.error.HTTPError as e:
        return Answer(e.code, e.read().decode("utf-8", "replace"), e.headers.get("Retry-After", ""))


PROBE = json.dumps({"kind": "verify", "name": "probe", "candidate": "probe", "normal": "PROBE", "candidate_normal": "PROBE"})


def probed(endpoints: tuple[Endpoint, ...], transport, policy: str = "smart", budget: int = 60, tier_limit: int = 1) -> tuple[Endpoint, ...]:
    """Endpoints after a probe on the driver, a request each: what works first, then the untested, then what failed now
    and may come back; what is forbidden goes. `full` probes all and keeps what works; `off` probes none."""
    if policy == "off":
        return endpoints
    turn: dict[tuple, int] = {}
    order = []
    for e in endpoints:
        turn[e.tier, e.provider] = turn.get((e.tier, e.provider), 0) + 1
        order.append((e.tier, turn[e.tier, e.provider], e.provider, e))
    chosen = [x[3] for x in sorted(order, key=lambda x: x[:3]) if policy == "full" or x[0] <= tier_limit]
    chosen = chosen if policy == "full" else chosen[:budget]
    breaker, place = Breaker(), {}
    for e in chosen:
        try:
            answer = transport(e, PROBE)
            good = answer.status == 200 and readable(answer.text)
            gone = not good and breaker.failed(e.combo, answer.status in (401, 403, 404))
        except Exception as problem:  # an endpoint that can't be reached is a failed one
            LOG.warning("%s/%s: %s", e.provider, e.model, problem)
            good, gone = False, False
        place[e.combo] = 0 if good else 3 if gone else 2
    kept = [e for e in endpoints if place.get(e.combo, 1) < 3 and (policy != "full" or place.get(e.combo) == 0)]
    return tuple(sorted(kept, key=lambda e: (place.get(e.combo, 1), e.tier, e.quality_rank)))


def run(spark: SparkSession, args: argparse.Namespace, transport=http) -> DataFrame:
    """The pipeline's results, written under --output with the review sheet, the trace and the progress."""
    cfg = settings(args)
    progress = f"{args.output}/progress.json"
    start = tables.load_progress(progress).get("last_end", args.start or 0) if args.resume else args.start or 0
    inventory = tables.row_slice(tables.inventory(tables.numbered(tables.read_csv(spark, args.inventory), "row_index")), start, args.end or 0, args.limit or 0)
    catalog = tables.catalog(tables.numbered(tables.read_csv(spark, args.catalog), "idx"))
    events: list[DataFrame] | None = [] if args.trace else None
    found = matching.cascade(inventory, catalog, cfg, keep=events is not None)
    rows = tables.scratch(found.results, "cli-matched")
    if events is not None:
        events.append(trace.match_events(found, cfg))
    if not getattr(args, "no_ai", False):
        client, model = decide.stub_client, "stub"
        if args.plan:
            with open(args.plan, encoding="utf-8") as f:
                ends = plans.endpoint_plan(f.read(), os.environ | plans.load_env(args.env), args.provider or "", args.model or "", args.api_key or "")
            if args.stage == "match" and not args.no_ai_preflight:
                ends = probed(ends, transport, args.rotation_preflight_policy, args.rotation_preflight_budget, args.rotation_preflight_tier_limit)
            client, model = RotatingClient(ends, transport), ends[0].model if ends else ""
        rows = tables.scratch(decide.verify(rows, catalog, client, cfg, events, model), "cli-verified")
        rows = tables.scratch(decide.search(rows, catalog, client, cfg, getattr(args, "ai_search_limit", None), events, model), "cli-searched")
        second = RotatingClient(ends, transport, args.review_model) if args.plan and args.review_model else client
        rows = tables.scratch(decide.review(rows, catalog, second, cfg, events, args.review_model or model), "cli-reviewed")
    elif events is not None:
        events.append(trace.with_drugs(trace.skipped(rows, "verify", "no_ai"), trace.drugs_of(found.left)))
    tables.write_sheet(rows, f"{args.output}/results")
    tables.write_sheet(tables.manual_review(rows, cfg.verify_threshold), f"{args.output}/review")
    if events is not None:
        trace.write_trace(trace.together(events), f"{args.output}/trace")
    done = inventory.agg({"row_index": "max"}).first()[0]
    if done is not None and "://" not in args.output:
        tables.save_progress(progress, int(done) + 1, rows.count(), start)
    for name, n in audit.match_counts(rows).first().asDict().items():
        LOG.info("%s: %s", name, n)
    return rows


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    logging.basicConfig(level=args.log_level)
    run(SparkSession.builder.appName("weftline").getOrCreate(), args)


if __name__ == "__main__":
    main()
