"""Arithmetic on interval texts such as ``1 hour`` or ``1 day 12 hours``."""

from __future__ import annotations

import re

_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
_PART = re.compile(r"(\d+)\s+(" + "|".join(_MICROS) + r")s?", re.IGNORECASE)


def micros(interval: str) -> int | None:
    """Length in microseconds, or None for a text in another form, which Spark has to judge."""
    text = re.sub(r"^\s*interval\s+", "", interval.strip(), flags=re.IGNORECASE)
    if not re.fullmatch(rf"(?:{_PART.pattern}\s*)+", text, flags=re.IGNORECASE):
        return None
    return sum(int(count) * _MICROS[unit.lower()] for count, unit in _PART.findall(text))
