"""Mixing with scarce domains, and with targets that no rates meet."""
import numpy as np
import pytest

from llm import soft_mixing


@pytest.fixture(scope="module")
def llm(spark):
    from llm.tables import ship
    ship(spark)
    return spark


def _narrow(llm, shares):
    rng = np.random.default_rng(5)
    n, k = 6000, len(shares)
    p = rng.dirichlet([0.05] * k, n) * 0.15 + 0.85 * np.eye(k)[rng.choice(k, n, p=shares)]
    return llm.createDataFrame([(x.tolist(), int(t)) for x, t in zip(p, rng.integers(20, 400, n))], "_p array<double>, _stats_words long").cache()


@pytest.mark.parametrize("shares", [(.50, .33, .01, .02, .14), (.30, .30, .05, .02, .33), (.85, .10, .02, .02, .01)])
def test_scarce_domains_reach_their_targets(llm, shares):
    narrow = _narrow(llm, shares)
    steps, reached, targets = soft_mixing.descend(narrow, list(soft_mixing.TARGETS.values()), [4])
    assert np.abs(reached / targets - 1).max() < 2 * soft_mixing.TOLERANCE
    assert len(steps) < 40
    rows = narrow.collect()
    p, tokens = np.array([r[0] for r in rows]), np.array([float(r[1]) for r in rows])
    assert np.allclose((tokens * soft_mixing._rates(p, steps)) @ p, reached)


def _coordinate_descent(p, tokens, target, rounds=4000):
    """The least squares by the plain definition, one document's rate after the other."""
    r, total = np.ones(len(p)), tokens @ p
    a = p * tokens[:, None]
    for _ in range(rounds):
        for i in range(len(p)):
            new = max(0.0, r[i] - (a[i] * (total - target) / target).sum() / (a[i] ** 2 / target).sum())
            total = total + a[i] * (new - r[i])
            r[i] = new
    return total


@pytest.mark.parametrize("weights", [(0.2, 0.3, 0.5), (0.02, 0.08, 0.9), (0.9, 0.05, 0.05)])
def test_least_squares_equal_another_solver(llm, weights):
    rng = np.random.default_rng(8)
    # Posteriors that are never sharp: not every target is within reach.
    p = rng.dirichlet([1.0] * 3, 40) * 0.4 + 0.6 / 3
    tokens = rng.integers(20, 400, 40).astype(float)
    narrow = llm.createDataFrame([(x.tolist(), int(t)) for x, t in zip(p, tokens)], "_p array<double>, _stats_words long").cache()
    _, reached, targets = soft_mixing.descend(narrow, list(weights), [], 8000.0)
    want = _coordinate_descent(p, tokens, targets)
    f = lambda x: ((x - targets) ** 2 / targets).sum()
    assert f(reached) <= f(want) + 1e-4 * targets.sum() * soft_mixing.TOLERANCE
    assert np.allclose(reached, want, rtol=1e-3)


def test_targets_out_of_reach_are_reported(llm):
    narrow = llm.createDataFrame([([0.5, 0.5], 100)] * 20, "_p array<double>, _stats_words long")
    _, reached, targets = soft_mixing.descend(narrow, [0.9, 0.1], [], 2000.0)
    with pytest.warns(UserWarning, match="misses its targets"):
        assert set(soft_mixing.missed(["a", "b"], reached, targets)) == {"a", "b"}
    # The least sum of (total - target)^2 / target over totals x, x.
    assert np.allclose(reached, 2 / (1 / 1800 + 1 / 200), rtol=1e-3)
