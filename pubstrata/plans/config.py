"""Stage parameters (reduction, clustering, periphery) with defaults and strict validation.

The JSON form is ``{"id": ..., "config": {"umap": {...}, "hdbscan": {...},
"periphery": {...}}}``; unknown keys are rejected. GPU batch sizes are
accepted and validated but have no effect here (Spark partitions the work).
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, fields


class ConfigError(ValueError):
    pass


def _strict(cls, data: dict):
    if not isinstance(data, dict):
        raise ConfigError(f"{cls.__name__}: expected an object")
    names = {f.name for f in fields(cls)}
    extra = set(data) - names
    if extra:
        raise ConfigError(f"{cls.__name__}: unknown keys {sorted(extra)}")
    return cls(**data)


@dataclass(frozen=True)
class UmapConfig:
    n_neighbors: int = 50
    min_dist: float = 0.1
    # fixed: 16 components, cosine metric, spectral initialisation
    n_components = 16
    metric = "cosine"
    init = "spectral"


@dataclass(frozen=True)
class HdbscanConfig:
    min_cluster_size: int = 100
    min_samples: int = 25
    cluster_selection_method: str = "eom"

    def __post_init__(self):
        if self.cluster_selection_method not in ("eom", "leaf"):
            raise ConfigError("cluster_selection_method must be 'eom' or 'leaf'")


@dataclass(frozen=True)
class PeripheryConfig:
    core_sample_frac: float = 0.2
    core_sample_min: int = 0
    core_sample_max: int = 999_999_999
    core_quantile: float = 0.05
    mv_batch_size: int = 2048
    batch_size: int = 50_000

    def __post_init__(self):
        if self.core_sample_min > self.core_sample_max:
            raise ConfigError("core_sample_min must not exceed core_sample_max")
        if self.mv_batch_size > self.batch_size:
            raise ConfigError("mv_batch_size must not exceed batch_size")


@dataclass(frozen=True)
class AppConfig:
    umap: UmapConfig = field(default_factory=UmapConfig)
    hdbscan: HdbscanConfig = field(default_factory=HdbscanConfig)
    periphery: PeripheryConfig = field(default_factory=PeripheryConfig)


@dataclass(frozen=True)
class ConfigItem:
    id: str
    config: AppConfig

    @classmethod
    def from_dict(cls, data: dict) -> "ConfigItem":
        if not isinstance(data, dict) or set(data) - {"id", "config"} or "id" not in data or "config" not in data:
            raise ConfigError("config item must have exactly the keys 'id' and 'config'")
        c = data["config"]
        if not isinstance(c, dict) or set(c) != {"umap", "hdbscan", "periphery"}:
            raise ConfigError("config must have the keys 'umap', 'hdbscan' and 'periphery'")
        return cls(
            id=str(data["id"]),
            config=AppConfig(
                umap=_strict(UmapConfig, c["umap"]),
                hdbscan=_strict(HdbscanConfig, c["hdbscan"]),
                periphery=_strict(PeripheryConfig, c["periphery"]),
            ),
        )

    @classmethod
    def from_json(cls, text: str) -> "ConfigItem":
        return cls.from_dict(json.loads(text))

    @classmethod
    def from_json_file(cls, path: str) -> "ConfigItem":
        with open(path, encoding="utf-8") as f:
            return cls.from_json(f.read())

    def to_dict(self) -> dict:
        return {"id": self.id, "config": {k: asdict(v) for k, v in
                                          (("umap", self.config.umap), ("hdbscan", self.config.hdbscan),
                                           ("periphery", self.config.periphery))}}


STAGES = ("reduced", "clusters", "periphery")
# bumped whenever a stage's algorithm changes, so stored tables of older code are not reused
STAGE_VERSION = 3


def stage_key(cfg: AppConfig, stage: str, extra: dict | None = None) -> str:
    """Hash of a stage's parameters and those of the stages before it."""
    parts = {"version": STAGE_VERSION, "umap": asdict(cfg.umap)}
    if stage in ("clusters", "periphery"):
        parts["hdbscan"] = asdict(cfg.hdbscan)
    if stage == "periphery":
        parts["periphery"] = asdict(cfg.periphery)
    if extra:
        parts["extra"] = extra
    blob = json.dumps(parts, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(blob.encode()).hexdigest()[:16]
