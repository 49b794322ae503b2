"""Evidence that must reach what it concerns, whatever the size of the text or the sample."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from corpusloom.llm import pii, toxicity


@pytest.mark.parametrize("at", [0, 25, 49])
def test_evidence_reaches_fifty_mentions(at):
    """One of 50 mentions has context; the others, far from it, get its label."""
    model = pii.PiiModel(np.zeros((pii.SHAPES + 2 * pii.HASHED + 1, 5)), np.zeros((3, 5, 5)))
    model.pair[1] = np.eye(5) * 5
    plain = pii.Graph()
    plain.add(0, "dial 12345678 now", [])
    context = next(f for f in plain.feats[0] if pii.SHAPES <= f < pii.SHAPES + pii.HASHED)
    model.unary[context, 3] = 8
    text = " and ".join("dial 12345678" if i == at else "12345678" for i in range(50))
    _, every = pii.find_in([text], model, pii.PiiConfig())[0]
    assert [k for _, k, _ in every] == [3] * 50


def test_messages_settle_along_a_run():
    """Exact along 40 neighbouring tokens, alone or beside another document."""
    model = pii.PiiModel(np.zeros((pii.SHAPES + 2 * pii.HASHED + 1, 5)), np.zeros((3, 5, 5)))
    model.pair[0] = np.eye(5) * 6
    model.unary[6, 3] = 9  # the shape of a long number, only the first
    run = "9" * 20 + " " + " ".join(str(i) for i in range(100, 139))
    want = np.array([1, 1, 1, np.exp(9), 1])
    for _ in range(39):
        want = np.exp(model.pair[0]) @ want
        want /= want.sum()
    for texts in ([run], ["1 2", run]):
        graph = pii.Graph()
        for i, t in enumerate(texts):
            graph.add(i, t, [])
        assert pii.marginals(graph, model, pii.PiiConfig().rounds)[-1] == pytest.approx(want, abs=1e-3)


@pytest.mark.parametrize("others", [77, 78, 300])
def test_rare_words_count_at_every_size(others):
    """Two texts with a word of their own: it counts below and above 80 texts."""
    texts = pa.array(["vile"] * 2 + ["calm"] * others, pa.large_string())
    config = toxicity.ToxicityConfig(l1=0.1)
    model = toxicity.train(texts, np.array([1.0] * 2 + [0.0] * others), config)
    data = np.frombuffer(b"vile", np.uint8)
    _, features = toxicity.gram_features(data, np.array([0, 4]), config.bits)
    assert (model.weights[features] > 0).all()


def numbers(size, seed=0):
    """A text of about size characters whose words are all candidates."""
    rng, out = np.random.default_rng(seed), []
    while size > 0:
        out.append(str(rng.integers(10 ** rng.integers(1, 10))))
        size -= len(out[-1]) + 1
    return " ".join(out)


@pytest.mark.parametrize("case", ["one text", "many texts", "training"])
def test_personal_data_memory_follows_candidates(case):
    """Under 1 KB a candidate beside what a block takes, however many features and labels there are."""
    texts = [numbers(1 << 18)] if case == "one text" else [numbers(1 << 12, i) for i in range(64)]
    model = pii.PiiModel(np.zeros((pii.SHAPES + 2 * pii.HASHED + 1, 5)), np.zeros((3, 5, 5)))
    candidates = sum(len(t.split()) for t in texts)
    tracemalloc.start()
    try:
        if case == "training":
            pii.train(texts, pii.PiiConfig(epochs=1))
        else:
            pii.find_in(texts, model, pii.PiiConfig())
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < (16 << 20) + 1000 * candidates


def test_blocks_and_gathering_change_no_result(monkeypatch):
    texts = ["call +1 555 123 4567, 555.123.4567 or 1234567", "5551234 x 5551234 y 5551234 z 99", None, "joe@a.example, joe@a", "1 2 3 a 4 5", numbers(300)]
    config = pii.PiiConfig(epochs=20, add_at=0.3, made=1.0)
    sample = [t for t in texts if t] * 5

    def results():
        graph, model = pii.Graph(), pii.train(sample, config)
        for i, t in enumerate(texts):
            graph.add(i, t or "", pii.base_spans(t or ""))
        return model, pii.marginals(graph, model, 50), pii.find_in(texts, model, config)

    whole = results()
    monkeypatch.setattr(pii, "BLOCK", 3)
    monkeypatch.setattr(pii, "GATHERED", 2)
    cut = results()
    assert np.allclose(whole[0].unary, cut[0].unary) and np.allclose(whole[0].pair, cut[0].pair) and np.abs(whole[0].pair).max() > 0
    assert np.allclose(whole[1], cut[1]) and whole[2] == cut[2]
    assert whole[2][2] == ([], []) and any(len(every) > len(base) for base, every in whole[2])
