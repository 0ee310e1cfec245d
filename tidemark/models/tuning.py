"""Choice of settings on validation rows by successive halving."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from tidemark.models.boosting import at_once


@dataclass(frozen=True)
class Trial:
    setting: object
    budget: int
    loss: float


def halving(settings: Sequence[object], loss: Callable[[object, int], float], budgets: Sequence[int], keep: float = 1 / 3, threads: int = 4) -> list[Trial]:
    """All settings are tried with the first budget (a number of trees or rounds); the best ``keep`` of
    them, one at least, go on to the next budget. All trials, the best of the last budget first.

    Fits of one budget run side by side. Equal losses keep the order of ``settings``; a loss that is no
    number comes last.
    """
    left, trials = list(range(len(settings))), []
    for budget in budgets:
        losses = at_once([lambda i=i: loss(settings[i], budget) for i in left], threads)
        ranked = sorted(zip(losses, left), key=lambda x: (math.isnan(x[0]), x))
        trials = [Trial(settings[i], budget, x) for x, i in ranked] + trials
        left = [i for _, i in ranked[: max(1, math.ceil(len(left) * keep))]]
    return trials
