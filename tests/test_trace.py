"""Trace events, rotation with its circuit breaker, preflight, reports, the command line."""

import json

import pytest
from pyspark.sql import functions as F
from test_matching import CATALOG, INVENTORY

from weftline import cli
from weftline.operators import audit, decide, endpoints, matching, rotation, trace
from weftline.operators.config import Matching, with_policy
from weftline.plans import inputs as I
from weftline.sources import plan, tables

E = rotation.Endpoint


@pytest.fixture(scope="module")
def sides(spark):
    inv = spark.createDataFrame(INVENTORY, "row_index long, code string, drug_name string, drug_price string")
    cat = spark.createDataFrame(CATALOG, "idx long, product_name_ar string, product_name_en string, store_product_id string, price double")
    return inv, cat


def test_events_of_a_run(spark, sides, tmp_path):
    cfg = with_policy(Matching(verify_policy="all"), "aggressive")
    results, events = trace.traced_match(*sides, cfg)
    results = tables.scratch(results, "traced")
    plain = matching.match(*sides, cfg)
    assert sorted(map(tuple, results.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)  # tracing changes nothing
    assert events.columns == ["row_index", "seq", *(c for c in trace.COLUMNS if c != "row_index")] and len(trace.COLUMNS) == 47
    rows = events.collect()
    by = {}
    for r in sorted(rows, key=lambda r: (r["row_index"], r["seq"]["step"], r["seq"]["rank"])):
        by.setdefault(r["row_index"], []).append(r)
    assert set(by) == {r[0] for r in INVENTORY}
    assert all([r["step"] for r in own][0] == "normalize" and own[-1]["step"] == "final" for own in by.values())
    assert [r["step"] for r in by[3]] == ["normalize", "final"]  # too short: nothing was looked up
    first = {r["step"]: r for r in by[0]}
    assert first["score_breakdown"]["selection_reason"].startswith("base=") and first["normalize"]["norm"] == "ALPHADOL 500 MG 20 TAB"
    assert any(r["step"] == "component_check" and r["reject_rule"] for r in rows)
    assert {r["scorer"] for r in by[6] if r["step"] == "fuzzy"} == set(matching.SCORERS)
    assert any(r["error_code"] == "no_brand_hits" for r in rows)
    after = {r["row_index"]: r for r in results.collect()}
    assert all((own[-1]["final_match"] or "NONE") == (after[k]["matched_product_name_en"] or "NONE") for k, own in by.items())
    parts = [events]
    done = tables.scratch(decide.verify(results, sides[1], cfg=cfg, trace=parts, model="m"), "traced-verify")
    done = tables.scratch(decide.search(done, sides[1], cfg=cfg, limit=1, trace=parts, model="m"), "traced-search")
    assert done.where("_ai_search_error <> ''").count() + done.where("verified = 'ai_found'").count() <= done.count()
    unsure = done.withColumn("ai_confidence", F.when(F.col("verified") == "ai_confirmed", 0.0).otherwise(F.col("ai_confidence")))
    decide.review(unsure, sides[1], cfg=cfg, trace=parts, model="m").count()
    whole = tables.scratch(trace.together(parts), "traced-all")
    steps = {r["step"] for r in whole.select("step").distinct().collect()}
    assert {"ai_verify_sent", "ai_verify_result", "ai_skip", "ai_review_sent", "ai_review_result"} <= steps
    summary = {r["code"]: r for r in audit.trace_summary(whole).collect()}
    assert len(summary) == len(INVENTORY) and summary["a"]["final_status"] == "matched"
    trace.write_trace(whole, str(tmp_path / "trace"))
    back = tables.read_csv(spark, str(tmp_path / "trace" / "events"))
    assert tuple(back.columns) == trace.COLUMNS and back.count() == whole.count()
    text = "\n".join(r["value"] for r in spark.read.text(str(tmp_path / "trace" / "lines")).collect())
    assert "DRUG: [a] alphadol500mg 20tab" in text and ">> FINAL: match=ALPHADOL" in text and "[AI VERIFY] result=" in text
    assert tables.read_csv(spark, str(tmp_path / "trace" / "summary")).count() == len(INVENTORY)


def test_pairs_are_judged_once(sides, monkeypatch):
    def again(*_):
        raise AssertionError("a trace takes the verdicts of the match")

    monkeypatch.setattr(trace, "verdict", again)
    results, rows = trace.traced_match(*sides, fuzzy=False)
    assert rows.where("step = 'component_check'").count() > 0 and rows.where("step = 'final'").count() == results.count()


def test_events_of_empty_sides(sides):
    inv, cat = sides
    assert trace.traced_match(inv.where("false"), cat)[1].count() == 0


def test_rotation_order_and_breaker():
    said = {}
    ends = [E("p", "u", f"key-{k:06}", f"m{k}", k) for k in (1, 2, 3)] + [E("p", "u", "key-low", "low", 1, 2)]
    client = rotation.RotatingClient(ends, lambda e, _: said.get(e.model, rotation.Answer(200, '{"is_correct": true}')))
    assert [client.plan()[0].model for _ in range(4)] == ["m1", "m2", "m3", "m1"] and client.plan()[-1].model == "low"
    client = rotation.RotatingClient(ends, client.transport)
    said["m1"] = rotation.Answer(500, "down")
    reply = client.ask("x")
    assert reply == '{"is_correct": true}' and [(a.model, a.decision, a.fallback_used) for a in reply.attempts] == [("m1", "failed", False), ("m2", "success", True)]
    assert client.plan()[0].model == "m3"  # after the one that answered
    client.cursors = {}
    assert [a.decision for a in client.ask("x").attempts] == ["disabled", "success"] and ends[0].combo in client.breaker.open  # the second transient failure
    for model, answer, code in (("m2", rotation.Answer(401, "no"), "http_401"), ("m3", rotation.Answer(200, None), "null_content"), ("low", rotation.Answer(429, "", "9"), "rate_limited")):
        said[model] = answer
        client.cursors = {}
        log = client.ask("x").attempts
        assert (log[0].model, log[0].decision, log[0].error_code) == (model, "disabled", code)
    assert isinstance(client.ask("x"), rotation.Silence) and rotation.told(client.ask("x")) == (None, "[]")

    def broken(e, prompt):
        raise TimeoutError("late")

    log = rotation.RotatingClient(ends[:1], broken).ask("x").attempts
    assert [(a.decision, a.error_code) for a in log] == [("failed", "TimeoutError"), ("disabled", "TimeoutError")]
    assert rotation.error_code(400, 'x "code":"json_bad"') == "json_generation_failed"


def test_review_endpoints_are_others_and_as_strong():
    a, b, weak = E("p", "u", "k1", "m1", 1, 1), E("q", "u", "k2", "m2", 1, 1), E("q", "u", "k3", "m3", 2, 1)
    assert rotation.reviewers((a, b, weak), a) == (b,)
    assert [e.model for e in rotation.RotatingClient((a, b, weak), None, "m2").plan()] == ["m2"]
    assert rotation.RotatingClient((a, b, weak), None, "m3").plan() == []


def test_attempts_become_events(spark, sides):
    ends = [E("p", "u", "key-000001", "bad"), E("p", "u", "key-000002", "good", 2)]
    client = rotation.RotatingClient(ends, lambda e, _: rotation.Answer(200, "no json" if e.model == "bad" else '{"is_correct": true, "reason": "r", "confidence": 0.9}'))
    results = tables.scratch(matching.match(*sides), "rotated")
    parts = []
    decide.verify(results, sides[1], client, Matching(verify_policy="all"), parts, "good").count()
    got = parts[0].collect()
    steps = {r["step"] for r in got}
    assert {"api_attempt", "rotation_attempt_used", "rotation_attempt_disabled", "ai_parse_failure"} <= steps
    assert all("key=...000002" in r["selection_reason"] for r in got if r["step"] == "rotation_attempt_used")


def test_preflight(spark):
    data = "/root/testdata/sf0.01"
    attempts, rows = I.attempts(spark, data), I.health(spark, data)
    assert endpoints.preflight_selection(attempts, rows, "off").count() == 0
    assert endpoints.preflight_selection(attempts, rows, "full").count() == attempts.count()
    assert endpoints.preflight_selection(attempts, rows, "smart", 12, 4, 1).count() == 12
    good = {r["model"] for r in rows.where("ok AND mode = 'json'").collect()}
    assert {r["model"] for r in endpoints.preflight_plan(attempts, rows, rows.limit(0), "full").collect()} == good
    steps = {r["step"]: r for r in trace.preflight_events(endpoints.ranked_health(rows), "policy=smart").collect()}
    assert steps["ai_preflight_result"]["decision"] == "healthy" and "failures=" in steps["ai_preflight_result"]["selection_reason"]
    ends = (E("p", "u", "k1", "bad"), E("p", "u", "k2", "gone", 2), E("q", "u", "k3", "good"), E("q", "u", "k4", "late", 1, 3))
    ask = lambda e, _: rotation.Answer({"bad": 500, "gone": 403}.get(e.model, 200), '{"is_correct": true}')
    assert [e.model for e in cli.probed(ends, ask)] == ["good", "late", "bad"]
    assert [e.model for e in cli.probed(ends, ask, "full")] == ["good", "late"] and cli.probed(ends, ask, "off") == ends


def test_reports(spark):
    rows = spark.createDataFrame([("a:free", 0.9, 1.0, 0.8, 9, 10, 0, 10, 3.0), ("b", 0.9, 0.9, 0.9, 9, 10, 1, 11, 2.0)], "model string, accuracy double, match_accuracy double, reject_accuracy double, correct_count long, valid_count long, api_failed_count long, total long, elapsed double")
    text = audit.markdown_report(rows, "Models")
    assert text[4].startswith("| 1 | `b`") and "Best free: `a:free`, 90 %" in text and "Best paid: `b`, 90 %" in text
    old = spark.createDataFrame([("1", "ALPHADOL 5 MG 10 TAB", "ALPHADOL 9 MG 10 TAB", "7", 90.0, "algo_match", "component_index"), ("2", "X", "", "", None, "", "no_match")], "code string, drug_name string, matched_product_name_en string, matched_store_product_id string, match_score double, verified string, match_method string")
    text = "\n".join(audit.comparison_report(old, old.withColumn("matched_product_name_en", F.lit(""))))
    assert "before component audit, different_dosage: 1" in text and "newly_unmatched=1" in text


def test_plans_and_environment(tmp_path):
    (tmp_path / ".env").write_text("# x\nA_KEY='abc'\nB_KEY=\"abc\"\nbad line\n", encoding="utf-8")
    env = plan.load_env(str(tmp_path / ".env"))
    assert env == {"A_KEY": "abc", "B_KEY": "abc"} and plan.load_env(str(tmp_path / "none")) == {}
    text = json.dumps([{"provider": "p", "url": "u", "keys": ["A_KEY", "B_KEY", "C_KEY"], "models": ["m1", "m2", "m3"]}, {"provider": "q", "keys": ["C_KEY"], "models": ["m"]}])
    assert [(e.model, e.tier) for e in plan.endpoint_plan(text, env)] == [("m1", 1), ("m2", 2), ("m3", 3)]
    assert [e.key for e in plan.endpoint_plan(text, env, "q", key="given")] == ["given"]


def test_command_line(spark, tmp_path):
    inv, cat = tmp_path / "inv.csv", tmp_path / "cat.csv"
    inv.write_text("code,name,price\n" + "\n".join(f"{r[1]},{r[2]},{r[3] or ''}" for r in INVENTORY), encoding="utf-8")
    cat.write_text("ar,en,id,price\n" + "\n".join(f"{r[1]},{r[2]},{r[3]},{r[4] or ''}" for r in CATALOG), encoding="utf-8")
    out = tmp_path / "out"
    out.mkdir()
    args = cli.parser().parse_args(["match", str(inv), str(cat), "--output", str(out), "--trace", "--limit", "4", "--threshold", "65", "--ai-search-policy", "expanded"])
    assert cli.settings(args).search_min_score == 75.0
    assert cli.run(spark, args).count() == 4
    for folder in ("results", "review", "trace/events", "trace/lines", "trace/summary"):
        assert tables.read_csv(spark, str(out / folder)).count() > 0
    more = cli.parser().parse_args(["match", str(inv), str(cat), "--output", str(out), "--no-ai", "--resume", "--threshold", "65"])
    assert cli.run(spark, more).count() == len(INVENTORY) - 4 and tables.load_progress(str(out / "progress.json"))["last_end"] == len(INVENTORY)
    cli.parser().parse_args(["verify", str(inv), str(cat), "--ai-verify-policy", "fuzzy"])
