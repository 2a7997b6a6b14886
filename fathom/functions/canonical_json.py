"""Canonical JSON and its hash. Plain Python: workers import this module."""

from __future__ import annotations

import hashlib
import json
import unicodedata

# Keys that a canonical hash leaves out.
VOLATILE_KEYS = ("actions_run_id", "commit_sha", "generated_at", "llm_response_id", "provenance_collected_at")
DESCRIPTIVE_KEYS = ("description", "display_name", "examples", "logical_name", "synonyms")


def _canonical(value, drop: frozenset):
    if isinstance(value, dict):
        return {unicodedata.normalize("NFC", k): _canonical(v, drop) for k, v in value.items() if k not in drop}
    if isinstance(value, list):
        return [_canonical(v, drop) for v in value]
    return unicodedata.normalize("NFC", value) if isinstance(value, str) else value


def canonical_json_hash(text: str | None, drop: tuple[str, ...] = VOLATILE_KEYS) -> str | None:
    if text is None:
        return None
    plain = json.dumps(_canonical(json.loads(text), frozenset(drop)), sort_keys=True, ensure_ascii=False,
                       separators=(",", ":"))
    return hashlib.sha256(plain.encode()).hexdigest()
