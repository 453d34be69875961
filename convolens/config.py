"""Settings of a run: one frozen object, read from YAML or JSON, with every problem reported at once."""

from __future__ import annotations

import difflib
import json
import os
from dataclasses import dataclass, fields, replace
from urllib.parse import urlsplit


@dataclass(frozen=True)
class Settings:
    """Defaults of a run; a dotted key of a file, such as judge.max_tokens, names a field as judge_max_tokens."""

    input_path: str = ""
    output_dir: str = "output"
    cache_path: str = ""
    filter_path: str = ""
    turns_path: str = ""
    labels_path: str = ""
    history_turns: int = 3
    limit: int = 0
    raw_ids: bool = False
    judge_backend: str = "stub"
    judge_url: str = ""
    judge_key: str = ""
    judge_model: str = ""
    judge_max_tokens: int = 16_000
    judge_timeout: int = 600


#: Closed domains and ranges of settings.
CHOICES = {"judge_backend": ("stub", "http")}
RANGES = {"history_turns": (0, 100), "limit": (0, None), "judge_max_tokens": (256, None), "judge_timeout": (1, None)}
#: Environment variables that may hold the judge's address, key and model, in order of preference.
ENVIRONMENT = {"judge_url": ("LLM_API_URL", "API_URL", "OPENAI_BASE_URL", "OPENAI_API_BASE"), "judge_key": ("LLM_API_KEY", "API_KEY", "OPENAI_API_KEY")}


def flatten(tree: dict, prefix: str = "") -> dict[str, object]:
    """Leaves of nested sections by their dotted keys."""
    out: dict[str, object] = {}
    for key, value in tree.items():
        out |= flatten(value, f"{prefix}{key}.") if isinstance(value, dict) else {f"{prefix}{key}": value}
    return out


def problems(values: dict[str, object]) -> list[str]:
    """Unknown keys with the nearest known one, wrong types (true is no whole number), choices and ranges."""
    known, out = {f.name: f.type for f in fields(Settings)}, []
    for dotted, value in values.items():
        name = dotted.replace(".", "_")
        if name not in known:
            near = difflib.get_close_matches(name, known, 1)
            out.append(f"{dotted}: unknown" + (f", did you mean {near[0]}?" if near else ""))
            continue
        kind = {"str": str, "int": int, "bool": bool}[known[name]]
        if not isinstance(value, kind) or (kind is int and isinstance(value, bool)):
            out.append(f"{dotted}: {known[name]} wanted, found {type(value).__name__}")
        elif name in CHOICES and value not in CHOICES[name]:
            out.append(f"{dotted}: one of {', '.join(CHOICES[name])} wanted")
        elif name in RANGES and (value < RANGES[name][0] or (RANGES[name][1] is not None and value > RANGES[name][1])):
            out.append(f"{dotted}: outside {RANGES[name][0]} to {RANGES[name][1] or 'any'}")
    return out


def parse_file(path: str) -> dict[str, object]:
    with open(path, encoding="utf-8") as file:
        text = file.read()
    if path.endswith(".json"):
        return flatten(json.loads(text))
    try:
        import yaml
    except ImportError:
        raise ValueError(f"{path}: YAML needs the yaml package; JSON is read without it") from None
    return flatten(yaml.safe_load(text) or {})


def load(path: str | None = None, overrides: dict[str, object] | None = None, env_file: str | None = None, environment: dict[str, str] | None = None) -> Settings:
    """Overrides before the file before the environment file before the environment before the defaults."""
    environment = dict(os.environ if environment is None else environment)
    if env_file:
        with open(env_file, encoding="utf-8") as lines:
            pairs = (x.strip().removeprefix("export ").partition("=") for x in lines if "=" in x and not x.lstrip().startswith("#"))
            environment |= {k.strip(): v.strip().strip("'\"") for k, _, v in pairs}
    values: dict[str, object] = {name: next((environment[v] for v in variables if environment.get(v)), "") for name, variables in ENVIRONMENT.items()}
    values = {k: v for k, v in values.items() if v}
    values |= {k: v for k, v in (parse_file(path) if path else {}).items() if v not in ("", None)}
    values |= {k: v for k, v in (overrides or {}).items() if v is not None}
    wrong = problems(values)
    if wrong:
        raise ValueError("; ".join(wrong))
    settings = replace(Settings(), **{k.replace(".", "_"): v for k, v in values.items()})
    return replace(settings, judge_url=normalise_url(settings.judge_url)) if settings.judge_url else settings


def normalise_url(url: str) -> str:
    """The base of an address: with a scheme, without the paths of single calls and without a slash at its end."""
    url = url.strip() if "://" in url else f"http://{url.strip()}"
    path = urlsplit(url).path.rstrip("/")
    for end in ("/chat/completions", "/completions", "/models"):
        if path.endswith(end):
            url = url.rstrip("/").removesuffix(end)
    return url.rstrip("/")
