"""Presets, settings and prompts: small things made on the driver, each with a fingerprint."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass


@dataclass(frozen=True)
class Preset:
    name: str
    width: int
    height: int


def parsed_presets(spec: str) -> list[Preset]:
    """`name=WxH`, `name=S` or `S`, by commas; blank parts are left out."""
    out = []
    for part in filter(None, (x.strip() for x in spec.split(","))):
        name, _, size = (x.strip() for x in part.rpartition("="))
        m = re.fullmatch(r"(\d+)(?:x(\d+))?", size)
        if not m or int(m[1]) < 1:
            raise ValueError(f"no preset: {part}")
        out.append(Preset(name or size, int(m[1]), int(m[2] or m[1])))
    return out


def fingerprint(settings: object) -> str:
    """Digest of the settings as JSON with sorted keys, 128 bits."""
    return hashlib.sha256(json.dumps(settings, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:32]


@dataclass(frozen=True)
class Prompt:
    text: str
    schema: dict
    version: str


def label_prompt(vocabulary: list[tuple[int, str, str]], *, enabled: set[int] | None = None, fields: dict[str, str] | None = None, version: str = "1") -> Prompt:
    """What a model is asked, and the JSON schema of its answer. fields: further ones, each 'string' or 'list'."""
    own = sorted(x for x in vocabulary if enabled is None or x[0] in enabled)
    if not own:
        raise ValueError("no labels are enabled")
    lines = ["Choose every label that applies.", *(f"{i}={name} ({about})" if about else f"{i}={name}" for i, name, about in own)]
    kinds = {"string": {"type": "string"}, "list": {"type": "array", "items": {"type": "string"}}}
    properties = {"labels": {"type": "array", "items": {"type": "integer", "enum": [i for i, _, _ in own]}}} | {k: kinds[v] for k, v in (fields or {}).items()}
    schema = {"type": "object", "properties": properties, "required": sorted(properties), "additionalProperties": False}
    text = "\n".join([*lines, "Answer with JSON: " + ", ".join(properties)])
    return Prompt(text, schema, hashlib.sha256(f"{version}\n{text}\n{json.dumps(schema, sort_keys=True)}".encode()).hexdigest())


def enrichment_prompt(path: str, text: str) -> str:
    return f"File: {path}\nGive JSON with subject, summary, entities and tags for this text.\n\n{text}"
