"""The fits of the quality operators, step by step against what they are defined to minimise."""

import numpy as np

from patronage.llm import quality
from patronage.llm.features import DIM, Rows


def least_point(f, low=-50.0, high=50.0):
    """Where a convex function of one number is least, by thirds."""
    for _ in range(200):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if f(a) <= f(b) else (a, high)
    return (low + high) / 2


def test_leader_minimises_its_regularised_losses_at_each_step():
    rng = np.random.default_rng(9)
    rows = [(np.sort(rng.choice(6, 3, replace=False)), rng.uniform(0.2, 1.0, 3)) for _ in range(12)]
    labels = np.array([int(0 in index) for index, _ in rows])
    sparse = Rows(np.arange(13) * 3, np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]))
    leader = quality.Ftrl()
    got, bias = leader.fit(sparse, labels, passes=2, seed=4)

    past = {c: [] for c in [*range(6), DIM]}  # gradient, regulariser's strength and its centre of each step of a coordinate

    def weight(c):
        slope, strengths = sum(g for g, _, _ in past[c]), [(s, w) for _, s, w in past[c]]
        steady = leader.beta / leader.alpha + leader.l2
        return least_point(lambda w: slope * w + sum(s * (w - at) ** 2 for s, at in strengths) / 2 + steady * w * w / 2 + leader.l1 * abs(w))

    order = np.random.default_rng(4)
    for _ in range(2):
        for i in order.permutation(12):
            entries = [*zip(rows[i][0].tolist(), rows[i][1].tolist(), strict=True), (DIM, 1.0)]
            now = {c: weight(c) for c, _ in entries}
            error = 1 / (1 + np.exp(-sum(now[c] * v for c, v in entries))) - labels[i]
            for c, v in entries:
                squares = sum(g * g for g, _, _ in past[c])
                strength = (np.sqrt(squares + (error * v) ** 2) - np.sqrt(squares)) / leader.alpha
                past[c].append((error * v, strength, now[c]))
    assert np.allclose(got[:6], [weight(c) for c in range(6)], atol=1e-4) and abs(bias - weight(DIM)) < 1e-4
    assert np.abs(got[:6]).max() > 0.1 and not got[6:].any()


def test_calibration_is_the_least_of_its_loss():
    rng = np.random.default_rng(3)
    margins = rng.normal(size=400) * 3
    labels = (rng.random(400) < 1 / (1 + np.exp(-(0.6 * margins - 0.4)))).astype(int)
    ones = labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (400 - ones + 2))

    def loss(slope, offset):
        p = 1 / (1 + np.exp(-(slope * margins + offset)))
        return -(target * np.log(p) + (1 - target) * np.log(1 - p)).sum() + 5e-4 * ((slope - 1) ** 2 + offset**2)

    slope, offset = quality.calibration(margins, labels)
    around = [loss(slope + a, offset + b) for a in (-1e-3, 0, 1e-3) for b in (-1e-3, 0, 1e-3) if a or b]
    assert loss(slope, offset) < min(around)
    assert abs(slope - 0.6) < 0.2 and abs(offset + 0.4) < 0.35
