import numpy as np

from driftwood.llm import line_dedup
from driftwood.llm import minhash as mh


def test_lines_at_the_threshold_share_a_band():
    """40,000 pairs of sets of 45 that share 40: similarity 0.8."""
    n = 40_000
    values = np.random.default_rng(5).integers(0, 1 << 64, (n, 50), dtype=np.uint64)
    keys = []
    for side in (values[:, :45], np.hstack([values[:, :40], values[:, 45:]])):
        signature = mh.signatures(side.reshape(-1), np.full(n, 45), line_dedup.BANDS * line_dedup.ROWS)
        keys.append(mh.band_keys(signature, line_dedup.BANDS, line_dedup.ROWS))
    missed = int((~(keys[0] == keys[1]).any(axis=1)).sum())
    assert missed <= 4, missed


def test_sketches_allow_pairs_at_the_threshold():
    """4,000 pairs of sets of 450 that share 400: similarity 0.8; far pairs are refused."""
    from driftwood.llm import near_dedup as nd
    most, rng, missed, far = mh.most_odd_bits(nd.SKETCH_SAMPLES, nd.SKETCH_WORDS, nd.PERCENT / 100), np.random.default_rng(7), 0, 0
    for _ in range(4):
        n, v = 1000, rng.integers(0, 1 << 64, (1000, 700), dtype=np.uint64)
        sides = [v[:, :450], np.hstack([v[:, :400], v[:, 450:500]]), v[:, 200:650]]
        a, b, c = (mh.odd_sketches(mh.signatures(np.ascontiguousarray(x).reshape(-1), np.full(n, 450), nd.SKETCH_SAMPLES), nd.SKETCH_WORDS)
                   for x in sides)
        missed += int((np.bitwise_count(a ^ b).sum(axis=1) > most).sum())
        far += int((np.bitwise_count(a ^ c).sum(axis=1) <= most).sum())
    assert missed <= 1 and far <= 1
