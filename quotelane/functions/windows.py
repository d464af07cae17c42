"""Event-time window helpers."""

import math
import re

import pandas as pd


def micros(duration: str) -> int:
    """Length of a day-time duration such as ``30 minutes`` in microseconds."""
    units = duration.lower().strip().removeprefix("interval ")
    units = re.sub(r"(\d+)\s*weeks?", lambda match: f"{7 * int(match[1])} days", units)
    return pd.Timedelta(units) // pd.Timedelta(1, "us")


def pane(window: str, slide: str | None) -> str | None:
    """The longest tumbling duration that tiles every sliding window exactly.

    None for tumbling windows, and for durations so uneven that a slide has more panes
    than a quote has windows: then panes are more work than copies.
    """
    if slide is None or micros(slide) == micros(window):
        return None
    length, step = micros(window), micros(slide)
    size = math.gcd(length, step)
    return None if step // size > length / step else f"{size} microseconds"
