"""Settings as frozen dataclasses; passed on explicitly, never kept in a global."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from kartoteka.errors import ConfigError


@dataclass(frozen=True)
class CommonCrawl:
    enabled: bool = False
    index_id: str = ""
    domains: tuple[str, ...] = ()
    max_records: int = 100
    timeout_s: float = 30.0
    page_size: int = 500


@dataclass(frozen=True)
class Ocr:
    confidence_threshold: float = 0.65
    languages: str = "pol+pol_frak"


@dataclass(frozen=True)
class Extraction:
    model_url: str = "http://localhost:11434"
    model: str = "llama3"
    timeout_s: float = 60.0
    bloom_hit_rate_threshold: float = 0.3
    bloom_filter_path: str | None = None


@dataclass(frozen=True)
class Resolution:
    fuzzy_match_threshold: float = 0.85
    store_dir: str = "data/resolution"


@dataclass(frozen=True)
class Settings:
    source: str = "local"
    input_dir: str = "data/input"
    checkpoint_dir: str = "data/checkpoints"
    dead_letter_dir: str = "data/dead_letter"
    lang_score_threshold: float = 0.3
    commoncrawl: CommonCrawl = field(default_factory=CommonCrawl)
    ocr: Ocr = field(default_factory=Ocr)
    extraction: Extraction = field(default_factory=Extraction)
    resolution: Resolution = field(default_factory=Resolution)


def _build(cls: type, values: dict[str, Any], where: str) -> Any:
    known = {f.name: f for f in dataclasses.fields(cls)}
    if unknown := set(values) - set(known):
        raise ConfigError(f"unknown settings in {where}: {sorted(unknown)}")
    out = {}
    for name, value in values.items():
        part = {"commoncrawl": CommonCrawl, "ocr": Ocr, "extraction": Extraction, "resolution": Resolution}.get(name)
        out[name] = _build(part, value or {}, name) if part else tuple(value) if isinstance(value, list) else value
    for name, low, high in (("confidence_threshold", 0, 1), ("fuzzy_match_threshold", 0, 1), ("lang_score_threshold", 0, 1), ("bloom_hit_rate_threshold", 0, 1)):
        if name in out and not low <= out[name] <= high:
            raise ConfigError(f"{name} must lie in [{low}, {high}]")
    return cls(**out)


def load_settings(path: str | Path) -> Settings:
    """Settings of a YAML file; unknown keys, unreadable files and values out of range raise :class:`ConfigError`."""
    import yaml

    try:
        values = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    except (OSError, yaml.YAMLError) as e:
        raise ConfigError(f"cannot read {path}: {e}") from e
    if not isinstance(values, dict):
        raise ConfigError(f"{path} holds no mapping")
    return _build(Settings, values, str(path))
