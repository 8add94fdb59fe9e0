"""Thresholds shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    max_null_pct: float = 50.0
    min_rows: int = 100
    max_duplicate_pct: float = 5.0
    min_completeness_pct: float = 80.0
    outlier_z: float = 3.0


@dataclass(frozen=True)
class MiningLimits:
    """Row counts below which an analysis reports an error instead of a model."""

    min_baskets: int = 10
    min_profiles: int = 50
    min_investments: int = 20
    min_jobs: int = 50
    min_support: float = 0.1
    min_confidence: float = 0.5
    test_share: float = 0.3
    seed: int = 42
    trees: int = 50
    kmeans_restarts: int = 10
    max_depth: int = 10
    min_leaf: int = 1
