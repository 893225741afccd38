"""Settings of the matching stages."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Matching:
    """Thresholds and limits, and the policies of the assisted stages."""

    fuzzy_threshold: float = 65.0
    top_k: int = 5
    shortest: int = 3
    verify_threshold: float = 95.0
    verify_policy: str = "score"
    verify_limit: int | None = None
    search_policy: str = "safe"
    search_min_score: float = 80.0
    search_confidence: float = 0.75
    search_candidates: int = 5
    review_min_score: float = 70.0
    review_confidence: float = 0.85
    review_candidates: int = 3
    review_threshold: float = 0.8
    override_confidence: float = 0.75
    mismatch_reasons: tuple[str, ...] = ("different_brand", "different_quantity", "different_volume", "different_modifier", "different_dosage")
    #: Rows of a block of queries and of a block of names in the exhaustive stage.
    query_block: int = 512
    name_block: int = 4096


#: Policy -> least score, confidence, candidates.
SEARCH_POLICIES = {"safe": (80.0, 0.75, 5), "review-candidates": (80.0, 0.75, 8), "expanded": (75.0, 0.75, 10), "aggressive": (70.0, 0.75, 15)}


def with_policy(cfg: Matching, policy: str, least: float | None = None, confidence: float | None = None, candidates: int | None = None) -> Matching:
    """cfg with a search policy's values, each of which may be given instead."""
    score, sure, most = SEARCH_POLICIES[policy]
    return replace(cfg, search_policy=policy, search_min_score=score if least is None else least, search_confidence=sure if confidence is None else confidence, search_candidates=most if candidates is None else candidates)
