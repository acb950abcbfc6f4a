import numpy as np

from paddockflow.llm import packing


def test_last_pool_is_packed_tightly():
    fewer = 0
    for seed in range(20):
        draw = np.random.default_rng(seed)
        # full bins cut in three or four, so that no gap is left over
        parts = [np.diff([0, *sorted(draw.choice(np.arange(1, 100), int(draw.integers(2, 4)), False)), 100]) for _ in range(12)]
        lengths = np.sort(np.concatenate(parts))[::-1]
        bins, offsets = packing.fullest_bins(lengths, 100)
        for b in range(bins.max() + 1):
            at = 0
            for i in np.flatnonzero(bins == b)[np.argsort(offsets[bins == b])]:
                assert offsets[i] == at
                at += lengths[i]
            assert at <= 100
        fewer += int(bins.max()) < int(packing.best_fit_decreasing(lengths, 100)[0].max())
    assert fewer
