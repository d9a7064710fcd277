"""The scorer's array steps against plain ones."""
import numpy as np
import pytest

from gazette.llm import lm_score as L


def test_drawn_units_are_those_of_a_search():
    rng = np.random.default_rng(1)
    for shares in (rng.dirichlet(np.ones(256) * 0.05), np.full(256, 1 / 256), np.array([1.0])):
        cum, x = np.cumsum(shares), rng.random((500, 12))
        assert (L.Drawer(cum)(x) == np.minimum(np.searchsorted(cum, x), len(cum) - 1)).all()


def test_sums_by_group():
    rng = np.random.default_rng(2)
    group, rows = rng.integers(0, 300, 1024).astype(np.int32), rng.normal(size=(1024, 16)).astype(np.float32)
    expect = np.zeros((301, 16))
    np.add.at(expect, group, rows)
    assert np.allclose(L.sums_by(group, rows, 301), expect, atol=1e-5)


@pytest.mark.parametrize("scale", [1, 40])
def test_log_probabilities_equal_a_plain_softmax_also_for_far_scores(scale):
    rng = np.random.default_rng(3)
    m = L.LogBilinear(rng.integers(1, 1000, 256).astype(float))
    m.r *= scale * 5
    context, unit = rng.integers(0, 257, (700, L.CONTEXT)).astype(np.int32), rng.integers(0, 256, 700)
    h = sum(m.q.astype(float)[context[:, j]] * m.c[j] for j in range(L.CONTEXT))
    z = h @ m.r.T.astype(float) + m.b
    z -= z.max(1, keepdims=True)
    expect = z[np.arange(700), unit] - np.log(np.exp(z).sum(1))
    assert np.allclose(m.log_probabilities(context, unit), expect, atol=2e-4, rtol=1e-5)


def test_known_words_have_their_place_and_others_that_of_their_unit():
    u = L.Units(["the", "of"])
    places = L.Known(["of", "the", "rare"], u, limit=2)
    for _ in range(2):
        for w in ("zebra", "apple", "of", "rare", "other", ""):
            at = places[w]
            assert at == {"of": 0, "rare": 2}.get(w, 3 + u.class_of(w))
    assert len(places) <= 3 + 2
