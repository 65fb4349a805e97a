"""Column functions. All of them are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F


def round_half_even(value: Column, places: int) -> Column:
    """Round as numpy does: scale, round ties to even, scale back."""
    scale = float(10**places)
    return F.rint(value * scale) / scale


def vector_element(vector: Column, position: int) -> Column:
    """One element of a live ML vector."""
    return vector_to_array(vector)[position]


def stored_vector_element(vector: Column, position: int) -> Column:
    """One element of a dense ML vector read back from JSON."""
    return vector["values"][position]


def label_from_severity(severity: Column, threshold: int = 3) -> Column:
    """1 from the threshold upwards, else 0. A missing severity counts as 0."""
    return F.when(severity >= threshold, 1).otherwise(0)


def uniform_of(*keys: Column, seed: int, others: Sequence[Column] = ()) -> Column:
    """A number in [0, 1) fixed by the key and the seed, whatever the partitioning.

    It comes from a digest that other SQL engines compute too. A row that lacks a part of its key
    draws from ``others``.
    """
    text = _joined(seed, keys)
    if others:
        known = reduce(lambda a, b: a & b, [key.isNotNull() for key in keys])
        text = F.when(known, text).otherwise(_joined(seed, others))
    digest = F.substring(F.md5(text), 1, 13)
    return F.conv(digest, 16, 10).cast("bigint") * F.lit(2.0**-52)


def _joined(seed: int, values: Sequence[Column]) -> Column:
    texts = [F.coalesce(value.cast("string"), F.lit("")) for value in values]
    return F.concat_ws(":", F.lit(str(seed)), *texts)
