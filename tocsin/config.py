"""Parameters of the scoring model."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from tocsin.functions.periods import last_quarters, previous_quarter


@dataclass(frozen=True)
class ScoringConfig:
    """Period, weights, thresholds and switches of one scoring run.

    ``as_of`` stands for "today": it bounds event dates and ages the portfolio.
    ``None`` means the session's current date; a run that must be repeatable
    passes a date.
    """

    current_quarter: str
    as_of: date | None = None

    # Component weights, flag thresholds and score scales.
    weight_rate: float = 0.30
    weight_severity: float = 0.35
    weight_novelty: float = 0.20
    weight_velocity: float = 0.15
    investigate_at: float = 65.0
    monitor_at: float = 40.0
    cap: float = 100.0
    benchmark_points: int = 40
    novelty_points: int = 200
    velocity_points: int = 100

    # True scores from the displayed (rounded) rates and percentages.
    round_inputs: bool = False
    # 'skip': a NULL component scores the cap (velocity: 0), because LEAST and
    # GREATEST skip NULL. 'zero': a NULL component scores 0.
    null_policy: str = "skip"

    def __post_init__(self) -> None:
        if self.null_policy not in ("skip", "zero"):
            raise ValueError(f"null_policy must be 'skip' or 'zero', not {self.null_policy!r}")
        previous_quarter(self.current_quarter)

    @property
    def previous_quarter(self) -> str:
        return previous_quarter(self.current_quarter)

    def last_quarters(self, n: int = 4) -> list[str]:
        return last_quarters(self.current_quarter, n)
