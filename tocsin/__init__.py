"""Safety-signal analytics as Spark DataFrame plans."""

from tocsin.config import ScoringConfig

__all__ = ["ScoringConfig"]
