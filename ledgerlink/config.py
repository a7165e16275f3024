"""Run parameters. Plain values, passed explicitly; nothing is read from the environment."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RunConfig:
    # The defaults below equal the reference's configuration.
    batch_id: str = "batch_001"
    # fuzzy acceptance: token-sort ratio >= threshold (inclusive)
    match_threshold: float = 85.0
    # characters of the clean name that form the fuzzy blocking key
    block_chars: int = 6
    # quality gate: a source with fewer rows fails (equal passes)
    min_rows: int = 1000
    # label = profit > profit_threshold
    profit_threshold: float = 100000.0
    # drift band: anomaly iff value < avg - tol or value > avg + tol
    drift_historical_avg: float = 0.25
    drift_tolerance: float = 0.15
    # revenue distribution rule: fail when max > factor * avg
    revenue_spread_factor: float = 1000.0
    # linkage options (see operators.linkage.resolve_entities)
    match_blank: bool = False
    one_to_one: bool = False
    pairs_per_task: int | None = 1_000_000
    lcs_engine: str = "arrow"
