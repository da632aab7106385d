"""What a step of the language model computes."""

import numpy as np

from feedlake.llm import recurrent
from tests.llm.test_recurrent import little


def test_each_probability_is_computed_once(monkeypatch):
    w, classes = little(n=300)
    rng = np.random.default_rng(3)
    hidden = rng.normal(0, 1, (500, recurrent.STATE)).astype(np.float32)
    target = rng.integers(0, 300, 500)
    sizes = np.array([len(m) for m in classes.members])[classes.of[target]]
    exp, seen = np.exp, []

    def counted(x, *args, **kwargs):
        seen.append(np.size(x))
        return exp(x, *args, **kwargs)

    monkeypatch.setattr(np, "exp", counted)
    recurrent.outputs(w, classes, hidden, target, recurrent.Trainer(w, classes).grad)
    assert sum(seen) == 500 * len(classes.members) + sizes[sizes > 1].sum()


def test_gates_far_from_zero(recwarn):
    w, classes = little()
    w.into[:, :2 * recurrent.STATE] = np.float32(-1000)
    docs = [np.array([2, 3, 4])]
    assert np.isfinite(recurrent.likelihoods(w, classes, docs)).all()
    assert not [x for x in recwarn if issubclass(x.category, RuntimeWarning)]
