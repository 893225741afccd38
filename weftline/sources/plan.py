"""Endpoint plans and environment files, read on the driver: a few rows.

A plan is JSON: [{"provider", "url", "keys": [names of environment variables], "models": [by quality]}, ...]. Each key
and model is an endpoint; its tier is the third of the provider's models that it is in.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from weftline.operators.rotation import Endpoint


def load_env(path: str) -> dict[str, str]:
    """NAME=value lines; quotes round a value go, comments and other lines are ignored; without a file, nothing."""
    try:
        with open(path, encoding="utf-8") as f:
            lines = [x.strip() for x in f]
    except FileNotFoundError:
        return {}
    pairs = [x.split("=", 1) for x in lines if "=" in x and not x.startswith("#")]
    return {k.strip(): v.strip().strip('"').strip("'") for k, v in pairs}


def tier(rank: int, models: int) -> int:
    """endpoints.model_tier() for one number."""
    return 1 if rank <= (models + 2) // 3 else 2 if rank <= (2 * models + 2) // 3 else 3


def endpoint_plan(text: str, env: Mapping[str, str], provider: str = "", model: str = "", key: str = "") -> tuple[Endpoint, ...]:
    """The endpoints of a plan's text whose keys are set; a provider, a model or a key given here narrows it."""
    out = []
    for told in json.loads(text):
        if provider and provider not in ("rotation", told["provider"]):
            continue
        keys = [key] if key else list(dict.fromkeys(env[k] for k in told["keys"] if env.get(k)))
        for rank, name in enumerate(told["models"], 1):
            if not model or name == model:
                out += [Endpoint(told["provider"], told.get("url", ""), k, name, rank, tier(rank, len(told["models"]))) for k in keys]
    return tuple(sorted(out, key=lambda e: (e.tier, e.quality_rank)))
