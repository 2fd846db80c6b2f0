"""Interval texts as plain numbers."""

import re

# Microseconds in each unit.
_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def interval_micros(text: str) -> int:
    """Length in microseconds of an interval such as ``"2 hours"`` or ``"1 hour 30 minutes"``."""
    parts = re.findall(r"(\d+)\s*([a-z]+)", text.lower())
    if not parts or re.sub(r"\d+\s*[a-z]+", "", text.lower()).strip():
        raise ValueError(f"not an interval: {text!r}")
    total = 0
    for amount, unit in parts:
        unit = unit.rstrip("s")
        if unit not in _MICROS:
            raise ValueError(f"unit {unit!r} has no fixed length in {text!r}")
        total += int(amount) * _MICROS[unit]
    return total
