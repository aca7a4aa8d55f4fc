"""Patterns carry the packing on the usual shapes of lengths, without needing more sequences than best fit."""

import numpy as np
import pytest

from isobar.llm import packing

RNG = np.random.default_rng(1)
SHAPES = {
    "lognormal": RNG.lognormal(6.5, 1.0, 40_000), "short": RNG.lognormal(4.0, 0.7, 60_000), "long": RNG.lognormal(7.5, 0.8, 30_000), "uniform": RNG.integers(1, 4097, 30_000), "middle": RNG.normal(1500, 300, 30_000),
    "pairs": np.repeat([1000, 3096], 4_000), "one length": np.repeat([700], 9_000), "tiny": np.repeat([1, 2], 50_000),
}


def histogram(lengths, capacity=4096):
    found, n = np.unique(np.clip(lengths.astype(int), 1, capacity), return_counts=True)
    return dict(zip(found.tolist(), n.tolist(), strict=True))


@pytest.mark.parametrize("shape", SHAPES)
def test_patterns_and_best_fit(shape):
    h = histogram(SHAPES[shape])
    groups, by_patterns = packing._planned(h, 4096)
    held = {}
    for many, kinds in groups:
        assert many > 0 and sum(length * n for length, n in kinds) <= 4096
        for length, n in kinds:
            held[length] = held.get(length, 0) + many * n
    assert held == h
    left = np.zeros(4097, np.int64)
    for length, n in h.items():
        left[length] = n if length < 4096 else 0
    full, sequences = h.get(4096, 0), sum(many for many, _ in groups)
    assert sequences <= full + packing._filled(left, 4096, packing._Open())
    if shape in ("lognormal", "short", "long", "uniform", "middle", "pairs"):
        assert 2 * by_patterns >= sequences - full


@pytest.mark.parametrize("capacity", [1, 2, 3, 7, 64, 100, 1000])
def test_small_capacities(capacity):
    h = histogram(RNG.integers(1, capacity + 1, 500), capacity)
    groups, _ = packing._planned(h, capacity)
    held = {}
    for many, kinds in groups:
        for length, n in kinds:
            held[length] = held.get(length, 0) + many * n
    assert held == h and packing.plan({}, capacity) == []
