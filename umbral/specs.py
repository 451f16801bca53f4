"""Thresholds and declarations. A user extends the engine by adding one of these, not a UDF."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column


@dataclass(frozen=True)
class Thresholds:
    """The four coverage cuts of the cascade; incoherent combinations are refused."""

    narrow_at: float = 0.7
    min_coverage: float = 0.5
    full_at: float = 0.8
    partial_at: float = 0.5

    def __post_init__(self):
        if self.narrow_at < self.min_coverage:
            raise ValueError(f"narrow_at {self.narrow_at} is below min_coverage "
                             f"{self.min_coverage}: the search would stop on entities that are "
                             "then reported as DOMAIN_ONLY")
        if self.full_at < self.partial_at:
            raise ValueError(f"full_at {self.full_at} is below partial_at {self.partial_at}: "
                             "the completeness bands overlap")


@dataclass(frozen=True)
class TierSpec:
    """One tier of the cascade, in authority order by its position in the list."""

    id: str
    source: str
    max_evalue: float | None = None
    skip_if_named_by: tuple[str, ...] = ()
    skip_artefacts: bool = False


@dataclass(frozen=True)
class LabelSource:
    """A label database: its name, the kind its labels carry and its release."""

    name: str
    kind: str
    version: str | None = None


@dataclass(frozen=True)
class EvidenceLine:
    """A named test over a family row, and the lines whose firing already implies it."""

    name: str
    test: Callable[["RealityThresholds"], Column]
    implied_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class RealityThresholds:
    purifying_max: float = 0.5
    min_members: int = 3
    min_lineages: int = 2


@dataclass(frozen=True)
class ContextSpec:
    max_gap: int = 100
    window: int = 3
    min_lineages: int = 2


@dataclass(frozen=True)
class PairSpec:
    min_lineages_together: int = 2
    fdr: float = 0.05


@dataclass(frozen=True)
class RaritySpec:
    rare_max_lineages: int = 2
    widespread_percentile: float = 99
    cross_min_hosts: int = 2
    cross_min_genera: int = 2


@dataclass(frozen=True)
class NetworkSpec:
    max_out_edges: int = 4
    min_cov: float = 0.5
    max_evalue: float = 1e-4
    dark_brightness: float = 0.05


@dataclass(frozen=True)
class SketchSpec:
    k: int = 21
    size: int = 1000
    max_distance: float = 0.05
    max_pvalue: float = 1e-10
    alphabet: int = 4


@dataclass(frozen=True)
class ClusterSpec:
    """One resolution of the similarity clustering. ``both`` asks the coverage of both sides."""

    name: str = "intermediate"
    min_identity: float = 50.0
    min_coverage: float = 80.0
    both: bool = False


#: The three family resolutions.
RESOLUTIONS = (
    ClusterSpec("close", 90.0, 80.0),
    ClusterSpec("intermediate", 50.0, 80.0),
    ClusterSpec("broad", 30.0, 50.0),
)
