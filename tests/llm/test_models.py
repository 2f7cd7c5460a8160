"""Operators 6, 7 and 9: quality rules, language identification, and the language model."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lakeweave.llm import catalog, gru, langid, quality


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    inside = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def test_counts_and_base_rule(docs, cases, nothing):
    got = Counter(tuple(r)[:7] for r in quality.judge(docs).collect())
    want = Counter()
    for c in cases:
        n = plain_counts(c["text"])
        want[(c["doc_id"], *n, n[0] < 50 or 100 * n[4] > 50 * n[0])] += 1
    assert got == want
    assert quality.judge(nothing).collect() == []


def test_thresholds_follow_each_group(spark, docs):
    rng = random.Random(1)
    def text(size):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(size - 1, size + 1))) for _ in range(80))
    rows = [(i, text(3 if i % 2 else 9), "en", "short" if i % 2 else "long") for i in range(400)]
    rows += [(1001, text(9), "en", "short"), (1002, text(9), "en", "long"), (1003, text(3), "en", None),
             (1004, text(3) + " ####" * 40, "en", "short"), (1005, None, None, None)]
    got = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in range(400))
    assert (got[1001], got[1002], got[1003], got[1004], got[1005]) == (False, True, True, False, False)


def test_sketches_are_accurate_and_merge(spark, docs):
    values = np.random.default_rng(1).lognormal(1, 2, 4000)
    rows = spark.createDataFrame([(float(v), int(i % 3)) for i, v in enumerate(values)], "v double, g int")
    parts = quality.sketch(rows, ["g"], {"m": F.col("v")})
    got = quality.quartiles(quality.merged(parts, []), []).first()
    assert got["rows"] == 4000
    for q, at in (("q1", 999), ("q3", 2999)):
        assert abs(got[q] / np.sort(values)[at] - 1) <= quality.ACCURACY * 1.001
    whole = quality.sketch(rows.repartition(7), [], {"m": F.col("v")})
    same = lambda df: sorted((r["bucket"], r["n"]) for r in df.collect())
    assert same(whole) == same(quality.merged(parts, []))


def test_pieces_give_what_one_run_gives():
    rng = np.random.default_rng(1)
    chain = langid.Chain(rng.normal(size=3), rng.normal(size=(3, 3)))
    table = rng.random((50, 3))
    texts = [rng.integers(1, 50, size=n) for n in (5, 17, 1, 40, 16, 8)]
    words, marginals, owner = chain.whole(table, texts, piece=8)
    for i, text in enumerate(texts):
        forward = [chain.start * table[text[0]]]
        for w in text[1:]:
            forward.append(forward[-1] @ chain.steps * table[w])
        back = [np.ones(3)]
        for w in text[:0:-1]:
            back.append(chain.steps @ (table[w] * back[-1]))
        own = np.array(forward) * np.array(back[::-1])
        own /= own.sum(axis=1, keepdims=True)
        assert np.allclose(marginals[:, owner == i].sum(axis=(0, 1)), own.sum(axis=0))


def test_languages_of_held_out_and_mixed_texts(spark):
    folder = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in catalog.QUERIES["op7_langid"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert all(got[r["doc_id"]]["held_out"] for r in held)
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    model = langid.fit([(r["text"], r["lang"]) for r in rows[:300]], rounds=120)
    by = {lang: next(r["text"] for r in rows[300:] if r["lang"] == lang and len(r["text"]) > 2000).split()[:60] for lang in ("en", "de")}
    words = [w.encode() for w in by["en"] + by["de"]]
    features = langid.Features(words, model.bits)
    table = model.emissions(features)
    _, marginals, _ = langid.Chain(model.start, model.steps).whole(table, [np.arange(len(words))], piece=16)
    order = np.argsort(-np.full(8, 16), kind="stable")
    labels = np.concatenate([marginals[:, i] for i in order])[:120].argmax(axis=1)
    truth = [model.labels.index("en")] * 60 + [model.labels.index("de")] * 60
    assert (labels == truth).mean() > 0.9


def test_texts_without_language(docs, cases, nothing):
    got = langid.identify(docs, F.lit(True))
    assert got.columns == [*[c for c in docs.columns if c not in ("lang_pred", "score")], "lang_pred", "score"]
    for r in got.collect():
        if not re.search(r"[^\W\d_]", r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("de", "en") and 0 < r["score"] <= 1
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(docs, F.lit(False)).collect()} == {("und", 0.0)}
    assert langid.identify(nothing, F.lit(True)).collect() == []


def little():
    words = [(b"w%d" % i, 50 - i) for i in range(45)]
    return gru.Lexicon([(gru.END, 9), *words], np.full(gru.ENDING_CLASSES, 2.5))


def test_shares_of_all_words_sum_to_one():
    network = gru.Network(little())
    rng = np.random.default_rng(0)
    network.weights["to_word"][:] = rng.normal(size=network.weights["to_word"].shape)
    network.weights["to_class"][:] = rng.normal(size=network.weights["to_class"].shape)
    state = rng.normal(size=(1, gru.STATE)).astype(np.float32)
    top = len(network.lexicon.counts)
    logs = network.log_shares(np.repeat(state, top + gru.ENDING_CLASSES, axis=0), np.arange(top + gru.ENDING_CLASSES))
    assert abs(np.exp(logs).sum() - 1) < 1e-5


def test_gradients_match_differences():
    network, rng = gru.Network(little()), np.random.default_rng(3)
    for w in network.weights.values():
        w += (0.3 * rng.normal(size=w.shape)).astype(np.float32)
    inputs, targets = rng.integers(0, 60, (4, 3)), rng.integers(0, 60, (4, 3))
    fresh = np.zeros((4, 3), bool)
    fresh[2, 1] = True
    state = rng.normal(size=(3, gru.STATE)).astype(np.float32)
    network.weights = {k: w.astype(np.float64) for k, w in network.weights.items()}

    def loss():
        states, _, _ = network.forward(inputs, state, fresh)
        return -network.log_shares(states.reshape(-1, gru.STATE), targets.ravel()).sum()

    grads, _ = network.gradients(inputs, targets, state, fresh)
    for name, w in network.weights.items():
        flat, grad = w.reshape(-1), np.asarray(grads[name]).reshape(-1)
        for i in np.argsort(-np.abs(grad))[:3]:
            step, kept = 2e-3, flat[i]
            flat[i] = kept + step
            up = loss()
            flat[i] = kept - step
            down = loss()
            flat[i] = kept
            assert abs((up - down) / (2 * step) - grad[i]) < 0.02 * max(1, abs(grad[i])), name


def test_state_passes_window_borders():
    network = gru.Network(little())
    for w in network.weights.values():
        w += (0.2 * np.random.default_rng(1).normal(size=w.shape)).astype(np.float32)
    texts = [np.random.default_rng(n).integers(0, 60, n) for n in (1, 7, 33, 90)]
    whole = network.score(texts, window=1000)
    for streams, window in ((512, 32), (2, 5), (1, 1)):
        assert np.allclose(network.score(texts, streams=streams, window=window), whole, rtol=1e-5)


def test_scores_of_texts(spark, docs, cases, nothing):
    learn = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1, F.lit(True))
    rows = gru.score(docs, learn).collect()
    in_training = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 != 1
    tokens = lambda t: [*(t or "").encode().lower().split(), gru.END]
    seen = Counter(w for c in cases if in_training(c["doc_id"]) for w in tokens(c["text"]))
    n, v = sum(seen.values()), len(seen)
    want = Counter()
    for c in cases:
        own = tokens(c["text"])
        base = sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        want[c["doc_id"], not in_training(c["doc_id"]), len(own), sum(seen[w] > 0 for w in own), n, round(base, 4)] += 1
    assert Counter((*tuple(r)[:5], round(r["base_score"], 4)) for r in rows) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)
    assert gru.score(nothing, F.lit(True)).collect() == []
    untrained = gru.score(docs.limit(3), F.lit(False)).collect()
    assert len(untrained) == 3 and all(math.isfinite(r["score"]) and r["n_known"] == 0 for r in untrained)


def test_model_beats_word_counts_on_held_out_texts(spark):
    rows = [r for r in catalog.QUERIES["op9_gru"](spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
