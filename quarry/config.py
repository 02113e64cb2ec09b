"""Run configuration: a closed set of keys with a rule each, and the table of semantic specs."""

from __future__ import annotations

import copy
import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SPEC_SCHEMA = (
    "name string, block string, ord int, grp string, weight double, target_fraction double, source_scale double, max_target_fraction double, "
    "hard_threshold double, tags array<string>, prefixes array<string>, exclude_tags array<string>, exclude_prefixes array<string>"
)


class ConfigError(RuntimeError):
    """All that is wrong with a configuration."""


def number(low: float | None = None, high: float | None = None, whole: bool = False, over: float | None = None) -> Callable:
    def rule(x) -> str | None:
        if isinstance(x, bool) or not isinstance(x, (int, float)) or (whole and x != int(x)):
            return "must be a whole number" if whole else "must be a number"
        if not ((low is None or x >= low) and (high is None or x <= high) and (over is None or x > over)):
            return "must be " + " and ".join(f"{w} {v}" for w, v in ((">=", low), ("<=", high), (">", over)) if v is not None)
        return None

    return rule


def one_of(*options: str) -> Callable:
    return lambda x: None if x in options else f"must be one of {', '.join(options)}"


def flag(x) -> str | None:
    return None if isinstance(x, bool) else "must be true or false"


def text(x) -> str | None:
    return None if isinstance(x, str) and x.strip() else "must be a text"


def texts(x) -> str | None:
    return None if isinstance(x, list) and all(isinstance(t, str) for t in x) else "must be a list of texts"


PROB, COUNT, HASH = number(0, 1), number(1, whole=True), number(0, 64, whole=True)

#: Every section with its keys; a dict is a section of its own.
SECTIONS: dict[str, dict] = {
    "dataset": {"train": COUNT, "validate": number(0, whole=True)},
    "runtime": {"device": one_of("auto", "cuda", "mps", "cpu"), "batch_size": COUNT, "workers": COUNT, "output_mode": one_of("copy", "hardlink", "symlink")},
    "models": {"embedding": text, "tagger": {"repo": text, "revision": text, "selected_tags_sha256": lambda x: None if isinstance(x, str) else "must be a text"}},
    "audit": {
        "min_side": COUNT, "max_aspect": number(1), "brisque": {"enabled": flag, "weight": PROB},
        "focus": {k: PROB for k in ("fail_risk", "soft_risk_start", "semantic_hard", "semantic_corroborated", "semantic_corroboration_risk")},
    },
    "dedup": {"phash_distance": HASH, "pixel_difference": PROB, "dino_similarity": PROB, "dino_phash_distance": HASH},
    "burst": {"enabled": flag, "gap_seconds": number(0), "max_span_seconds": number(0), "use_exif": flag, "use_filename": flag, "use_mtime": flag, "repeat_penalty": PROB},
    "semantic": {"evidence_floor": PROB, "availability_capture": PROB, "presence_threshold": PROB, "categories": None, "penalties": None},
    "selection": {
        **{k: number(0) for k in ("quality_weight", "coverage_weight", "novelty_weight")}, "coverage_top_groups": COUNT,
        **{k: PROB for k in ("novelty_similarity_start", "redundancy_similarity_start", "redundancy_penalty", "soft_focus_penalty", "semantic_penalty_cap")},
    },
    "validation": {"near_duplicate_similarity": PROB, "near_duplicate_phash_distance": HASH, "same_burst_similarity": PROB},
}
FACE = {"model_path": text, "min_size": COUNT, "min_face_size": COUNT, "context_scale": number(over=1), "confidence": PROB, "detection_max_side": COUNT}
SPEC = {
    "name": text, "group": text, "weight": number(0), "target_fraction": PROB, "source_scale": PROB, "max_target_fraction": PROB, "hard_threshold": PROB,
    "tags": texts, "prefixes": texts, "exclude_tags": texts, "exclude_prefixes": texts,
}
#: (section, lower key, upper key, strict)
ORDERED = [
    (("audit", "focus"), "soft_risk_start", "fail_risk", True),
    (("burst",), "gap_seconds", "max_span_seconds", False),
    (("semantic",), "evidence_floor", "presence_threshold", True),
]


def _section(value, rules: dict, where: str, wrong: list[str]) -> None:
    if not isinstance(value, dict):
        wrong.append(f"{where} must be an object")
        return
    wrong += [f"{where}: unknown key {k}" for k in sorted(set(value) - set(rules))]
    for key, rule in rules.items():
        if key not in value:
            wrong.append(f"{where}: {key} is missing")
        elif isinstance(rule, dict):
            _section(value[key], rule, f"{where}.{key}", wrong)
        elif rule and (problem := rule(value[key])):
            wrong.append(f"{where}.{key} {problem}")


def _specs(semantic: dict, wrong: list[str]) -> None:
    names: list[str] = []
    for block in ("categories", "penalties"):
        rows = semantic.get(block)
        if not isinstance(rows, list) or not all(isinstance(r, dict) for r in rows):
            wrong.append(f"semantic.{block} must be a list of objects")
            continue
        for i, row in enumerate(rows):
            where = f"semantic.{block}[{i}]"
            own: list[str] = []
            _section(row, {k: SPEC.get(k) for k in {"name", "weight", *(set(row) & set(SPEC))}} | {k: SPEC[k] for k in row if k in SPEC}, where, own)
            if not own and row.get("max_target_fraction", 1) < row.get("target_fraction", 0):
                own.append(f"{where}: max_target_fraction is under target_fraction")
            if not own and not (row.get("tags") or row.get("prefixes")):
                own.append(f"{where}: tags or prefixes are missing")
            wrong += own
            names.append(row.get("name"))
    wrong += [f"semantic: the name {n} is used twice" for n in sorted({n for n in names if isinstance(n, str) and names.count(n) > 1})]
    if not any(isinstance(r, dict) and r.get("name") == "semantic_blur" for r in semantic.get("penalties") or []):
        wrong.append("semantic.penalties: semantic_blur is missing")


def checked(cfg, folder: str | Path = ".") -> dict:
    """The configuration with defaults filled in; ConfigError names everything that is wrong with it."""
    wrong: list[str] = []
    if not isinstance(cfg, dict):
        raise ConfigError("the configuration must be an object")
    cfg = copy.deepcopy(cfg)
    virtual = cfg.pop("virtual", {})
    _section(cfg, SECTIONS, "configuration", wrong)
    for path, low, high, strict in ORDERED:
        at = cfg
        for p in path:
            at = at.get(p, {}) if isinstance(at, dict) else {}
        a, b = (at.get(low), at.get(high)) if isinstance(at, dict) else (None, None)
        if isinstance(a, (int, float)) and isinstance(b, (int, float)) and (a > b or (strict and a == b)):
            wrong.append(f"{'.'.join(path)}: {low} must be {'under' if strict else 'at most'} {high}")
    weights = [(cfg.get("selection") or {}).get(f"{k}_weight") for k in ("quality", "coverage", "novelty")] if isinstance(cfg.get("selection"), dict) else [None]
    if all(isinstance(w, (int, float)) for w in weights) and abs(sum(weights) - 1) > 1e-6:
        wrong.append("selection: the three weights must sum to 1")
    if isinstance(cfg.get("semantic"), dict):
        _specs(cfg["semantic"], wrong)
    face = virtual.get("face_crop", {}) if isinstance(virtual, dict) else None
    if not isinstance(face, dict) or set(virtual) - {"face_crop"}:
        wrong.append("virtual must be an object with face_crop only")
        face = {}
    wrong += [f"virtual.face_crop: unknown key {k}" for k in sorted(set(face) - set(FACE) - {"enabled"})]
    if face.get("enabled", False):
        _section({k: v for k, v in face.items() if k in FACE}, FACE, "virtual.face_crop", wrong)
        if isinstance(face.get("model_path"), str) and not Path(face["model_path"]).expanduser().is_absolute():
            face["model_path"] = str((Path(folder) / Path(face["model_path"]).expanduser()).resolve())
    if wrong:
        raise ConfigError("\n".join(wrong))
    return cfg | {"virtual": {"face_crop": {"enabled": False} | face}}


def load(path: str | Path) -> dict:
    path = Path(path)
    try:
        return checked(json.loads(path.read_text(encoding="utf-8")), path.parent)
    except (OSError, ValueError) as e:
        raise ConfigError(f"{path}: {e}") from e


def spec_rows(cfg: dict) -> list[tuple]:
    out = []
    for block, kind, group in (("categories", "category", "coverage"), ("penalties", "penalty", "penalty")):
        for i, s in enumerate(cfg["semantic"][block]):
            hard = s.get("hard_threshold")
            numbers = [float(s["weight"]), *(float(s.get(k, d)) for k, d in (("target_fraction", 0), ("source_scale", 0), ("max_target_fraction", 1)))]
            lists = [list(s.get(k, [])) for k in ("tags", "prefixes", "exclude_tags", "exclude_prefixes")]
            out.append((s["name"], kind, i, s.get("group", group), *numbers, None if hard is None else float(hard), *lists))
    return out


def specs(spark: SparkSession, cfg: dict) -> DataFrame:
    """One row per spec; a handful by contract, so it may be broadcast."""
    return spark.createDataFrame(spec_rows(cfg), SPEC_SCHEMA)
