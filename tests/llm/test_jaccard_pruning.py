"""What pruning loses at and above the threshold, computed exactly."""

from __future__ import annotations

from math import comb

import numpy as np
import pytest

from tidemark.llm import jaccard


@pytest.mark.parametrize("similarity", [0.8, 0.81, 0.85, 0.9])
def test_pruning_loses_less_than_the_bands(similarity):
    match = similarity + (1 - similarity) / 256
    step = np.array([comb(jaccard.STEP, k) * match**k * (1 - match) ** (jaccard.STEP - k) for k in range(jaccard.STEP + 1)])
    matches, lost = np.ones(1), 0.0
    for least in jaccard.least_matches():
        matches = np.convolve(matches, step)
        lost += matches[:least].sum()
        matches[:least] = 0
    assert lost < (1 - 0.8**jaccard.ROWS) ** jaccard.BANDS
