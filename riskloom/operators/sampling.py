"""Stratified samples and splits.

Spark's own samplers draw per partition, so a different layout of the same table gives a
different sample. The keyed forms decide by a hash of the row's key: the same rows come out for
any layout, and again when a lost executor's partitions are computed anew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# --- Fixed values: sampling fraction per label, split weights and seeds of the training job. ---
LABEL_FRACTIONS = {0: 0.24, 1: 1.0}
SPLIT_WEIGHTS = [0.85, 0.15]
SAMPLE_SEED = 36
SPLIT_SEED = 5043


def stratified_sample(
    df: DataFrame,
    stratum: str = "label",
    fractions: Mapping = LABEL_FRACTIONS,
    seed: int = SAMPLE_SEED,
    uniform: Column | None = None,
) -> DataFrame:
    """Keep a fraction per stratum; a stratum without a fraction is left out.

    ``uniform`` is a column in [0, 1) derived from the row's key. Without it Spark's own sampler
    draws.
    """
    if uniform is None:
        return df.sampleBy(stratum, dict(fractions), seed=seed)
    kept = F.lit(0.0)
    for value, fraction in fractions.items():
        kept = F.when(F.col(stratum) == value, F.lit(float(fraction))).otherwise(kept)
    return df.where(uniform < kept)


def split(
    df: DataFrame,
    weights: Sequence[float] = SPLIT_WEIGHTS,
    seed: int = SPLIT_SEED,
    uniform: Column | None = None,
) -> list[DataFrame]:
    """Disjoint parts that together are ``df``, in proportion to ``weights``."""
    if uniform is None:
        return df.randomSplit(list(weights), seed=seed)
    return [
        df.where((uniform >= low) & (uniform < high)) for low, high in split_bounds(weights)
    ]


def split_bounds(weights: Sequence[float]) -> list[tuple[float, float]]:
    """The ranges of [0, 1) that belong to the parts."""
    total, running, edges = sum(weights), 0.0, [0.0]
    for weight in weights:
        running += weight
        edges.append(running / total)
    edges[-1] = 1.0
    return list(zip(edges, edges[1:]))
