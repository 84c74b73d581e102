import numpy as np

from shelfmark.llm import mixing as m


def test_a_long_phase_stays_within_a_block_of_the_given_weights():
    sizes = np.array([2_000_000, *np.linspace(100_000, 321_000, 19).astype(int)])
    for weights in (sizes**m.SMOOTHING, np.array([0.001, *[1.0] * 19])):
        blocks = -(-sizes // 32)
        phases = m.pfair_phases(weights, blocks)
        source, block = np.repeat(np.arange(20), blocks), np.concatenate([np.arange(b) for b in blocks])
        slots = m.block_slots(phases, source, block)
        assert (np.sort(slots) == np.arange(blocks.sum())).all()
        order = source[np.argsort(slots)][: phases[1].slot]
        assert len(order) > 50_000
        for s, share in enumerate(weights / weights.sum()):
            assert np.abs(np.cumsum(order == s) - np.arange(1, len(order) + 1) * share).max() < 1 + 1e-6
