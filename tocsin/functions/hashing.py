"""Repeatable pseudo-random numbers from an id, in integer arithmetic.

The numbers depend only on ``(id, salt)``, never on partitioning or row order,
so a retried task makes the same rows again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Mersenne prime 2**31 - 1: products of two residues stay inside a BIGINT.
MODULUS = 2147483647


def hash_residue(key: Column, salt: int) -> Column:
    """A number in [0, MODULUS) that looks random in ``key`` for a fixed ``salt``.

    The key's high bits count for themselves, so that large keys do not repeat small ones.
    """
    key = key.cast("bigint")
    high = F.pmod(F.shiftright(key, 31), F.lit(MODULUS))
    mixed = F.pmod(key, F.lit(MODULUS)) * 48271 + high * 25214 + 69621 * (salt + 1)
    for multiplier in (16807, 39373):
        low = mixed % MODULUS
        mixed = low * (low + multiplier) + salt
    return mixed % MODULUS


def hash_uniform(key: Column, salt: int) -> Column:
    """A double in [0, 1)."""
    return hash_residue(key, salt).cast("double") / F.lit(float(MODULUS))


def hash_index(key: Column, salt: int, size: Column) -> Column:
    """An index in [0, size)."""
    return F.floor(hash_uniform(key, salt) * size).cast("bigint")


def weighted_choice(uniform: Column, values: list[str], weights: list[float]) -> Column:
    """Pick from ``values`` by cumulative weight; ``uniform`` is in [0, 1)."""
    total = float(sum(weights))
    running = 0.0
    choice = None
    for value, weight in zip(values[:-1], weights[:-1]):
        running += weight
        bound = uniform < F.lit(running / total)
        choice = F.when(bound, value) if choice is None else choice.when(bound, value)
    return F.lit(values[-1]) if choice is None else choice.otherwise(values[-1])
