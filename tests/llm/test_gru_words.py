"""Operator 9: what the network learns from."""

import numpy as np
import pyarrow as pa

from lakeweave.llm import gru
from lakeweave.llm.wordblocks import distinct_words, split_words


def lexicon():
    return gru.Lexicon([(b"w%d" % i, 60 - i) for i in range(59)], np.full(gru.ENDING_CLASSES, 2.5))


def test_every_word_is_learned_from():
    network, rng = gru.Network(lexicon()), np.random.default_rng(1)
    seen, inner = [], network.gradients
    network.gradients = lambda inputs, targets, *rest: seen.extend(targets.ravel()) or inner(inputs, targets, *rest)
    tokens = rng.integers(0, 60, 96 * 30 + 57 + 3)
    fresh = np.zeros(len(tokens), bool)
    fresh[[0, 100, 2000]] = True
    assert network.learn(tokens, fresh) == len(tokens) - 3
    assert sorted(seen) == sorted(tokens[~fresh])


def test_long_texts_pass_through_whole(spark, docs, monkeypatch):
    words = lexicon()

    class Counting(gru.Network):
        def learn(self, tokens, fresh):
            seen = len(tokens) - int(fresh.sum())
            self.weights["bias"] = np.full_like(self.weights["bias"], seen)
            return seen

    monkeypatch.setattr(gru, "Network", Counting)
    df = spark.createDataFrame([("w1 " * 5000,), ("w2 w3",), (None,)], "text string").coalesce(1)
    made = gru.averaged(df, Counting(words))
    assert set(made.weights["bias"]) == {5001 + 3 + 1}


def test_words_with_weights_grow_with_the_distinct_words():
    assert [gru.own_weights(n) for n in (0, 10_000, 10**6, 10**8)] == [2000, 2000, 8000, 80_000]


def odd_texts():
    rng = np.random.default_rng(2)
    pool = list("aB é\u0085 \x1c\x1f\n\t\x0b\x0c\r\x00日  ")
    return [None, "", " ", *[chr(i) + "A" + chr(i) + "b" for i in range(200)],
            *["".join(rng.choice(pool, rng.integers(0, 30))) for _ in range(500)]]


def test_words_are_cut_as_bytes_are():
    texts = odd_texts()
    for kind in (pa.string(), pa.large_string(), pa.binary()):
        column = pa.array([t if t is None or kind != pa.binary() else t.encode() for t in texts], kind)
        for lower in (True, False):
            words, sizes = split_words([column, column.slice(5, 90), column.slice(0, 0)], lower)
            raw = [(t or "").encode() for t in [*texts, *texts[5:95]]]
            want = [(r.lower() if lower else r).split() for r in raw]
            assert sizes.tolist() == [len(w) for w in want]
            distinct, numbers = distinct_words(words)
            assert [distinct[i] for i in numbers] == [w for one in want for w in one]
    assert len(split_words([], True)[0]) == len(split_words([column.slice(0, 0)], True)[0]) == 0


def test_runs_stand_between_ends():
    words, texts = lexicon(), [None, "w3 W4  zz\n", " "]
    runs = [r.tolist() for r in gru.runs_of(words, pa.array(texts))]
    end = words.number[gru.END]
    assert runs == [[end, *words.codes((t or "").encode().lower().split()), end] for t in texts]


def test_shares_of_scores_far_apart():
    network, rng = gru.Network(lexicon()), np.random.default_rng(4)
    states = np.tanh(rng.normal(size=(300, gru.STATE))).astype(np.float32)
    targets = rng.integers(0, 60 + gru.ENDING_CLASSES, 300)
    for size in (1, 40, 400):
        for name in ("to_class", "to_word"):
            network.weights[name][:] = size * rng.normal(size=network.weights[name].shape)
        w, words = network.weights, network.lexicon
        scores = states.astype(np.float64) @ w["to_class"] + w["class_bias"]
        scores -= scores.max(axis=1, keepdims=True)
        want = (scores - np.log(np.exp(scores).sum(axis=1, keepdims=True)))[np.arange(300), words.class_of[targets]]
        for i in np.flatnonzero(targets < 60):
            first, last = words.firsts[words.class_of[targets[i]]:][:2]
            own = states[i].astype(np.float64) @ w["to_word"][first:last].T + w["word_bias"][first:last]
            own -= own.max()
            want[i] += own[targets[i] - first] - np.log(np.exp(own).sum())
        got = network.log_shares(states, targets)
        assert np.isfinite(got).all() and np.allclose(got, want, rtol=1e-4, atol=1e-4 * size)


def test_few_classes_are_without_words():
    words = gru.Lexicon([(b"w", 5)], np.full(gru.ENDING_CLASSES, 2.5))
    network = gru.Network(words)
    for targets in ([0, 1], [2, 3], [1, 1, 9], []):
        targets = np.array(targets, np.int64)
        states = np.full((len(targets), gru.STATE), 0.1, np.float32)
        assert np.isfinite(network.log_shares(states, targets)).all()
        grads, back = gru.ByClass(network, states, targets).errors()
        assert back.shape == states.shape and all(np.isfinite(g).all() for g in grads.values())
