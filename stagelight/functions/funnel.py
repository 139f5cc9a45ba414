"""Expressions over stages, flags and score bands."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stagelight.schemas import SCORE_BANDS, STAGES, Stage


def one_if(column: Column, value: str) -> Column:
    """1 for exactly ``value``, 0 for anything else and for NULL."""
    return F.when(column == value, 1).otherwise(0)


def passed_bits(stages: Sequence[Stage] = STAGES) -> Column:
    """One integer per row; bit k is set when the row passes the rule of stage k."""
    return _or_bits([F.when(s.passes(), 1 << k).otherwise(0) for k, s in enumerate(stages)])


def name_bit(name: Column, stages: Sequence[Stage] = STAGES) -> Column:
    """The bit of the stage called ``name``; 0 for an unknown stage."""
    return _or_bits([F.when(name == s.name, 1 << k).otherwise(0) for k, s in enumerate(stages)])


def has_stage(bits: Column, k: int) -> Column:
    return bits.bitwiseAND(F.lit(1 << k)) != 0


def _or_bits(bits: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def score_band(score: Column) -> Column:
    """Name of the band; a NULL score is below no limit and so lands in the last band."""
    (last, _), *below = reversed(SCORE_BANDS)
    return reduce(lambda rest, band: F.when(score < band[1], band[0]).otherwise(rest), below, F.lit(last))


def band_rank(band: Column) -> Column:
    return F.array_position(F.array(*[F.lit(name) for name, _ in SCORE_BANDS]), band)
