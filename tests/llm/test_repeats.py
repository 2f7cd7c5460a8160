"""Operator 4: repeated passages, against brute force."""

import random

import numpy as np
import pytest

from lakeweave.llm import repeats


def brute(rows, length):
    """Result per row for rows in the order of the operator; rows that agree in id and text are one document."""
    seen, out = set(), []
    for raw in rows:
        covered = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            window = raw[p:p + length]
            if window in seen:
                covered[p:p + length] = True
            seen.add(window)
        runs = int(np.sum(np.diff(np.concatenate([[0], covered.astype(int)])) == 1))
        out.append((len(raw), int(covered.sum()), runs, bytes(np.frombuffer(raw, np.uint8)[~covered])))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["ab", "ba", "a", "é", "xyz", " "]
    base = "".join(rng.choice(words) for _ in range(300))
    texts = [base, base, base[:150] + "Q" + base[150:], None, "", "short", "ab" * 200, "zab" * 90 + base[20:90], base[::-1]]
    for _ in range(25):
        a, b = sorted(rng.sample(range(300), 2))
        texts.append("".join(rng.choice(words) for _ in range(40)) + base[a:b] + rng.choice(["", "tail", base[:60]]))
    texts += ["COMMON LINE THAT MANY SHARE, WORD BY WORD " + "".join(rng.choice("uvwxyz") for _ in range(30)) for _ in range(25)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed, length, contents", [(1, 30, 2048), (2, 12, 2), (3, 41, 1), (4, 100, 2048)])
def test_every_byte_as_by_brute_force(spark, docs, seed, length, contents):
    texts = corpus(seed)
    rows = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, name string").repartition(4)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in
           repeats.remove(rows, length=length, most_contents=contents, keep=("name",)).collect()}
    assert [got[i] for i in range(len(texts))] == brute([(t or "").encode() for t in texts], length)


def test_slices_and_flushes_do_not_matter(monkeypatch):
    rng = np.random.default_rng(1)
    text = rng.integers(97, 100, 5000).astype(np.uint8)
    ends = np.array([0, 700, 700, 3000, 5000])
    start, count, names, content = repeats.runs(text, ends, 50, 10)
    assert (count <= 41).all()
    covered = np.concatenate([np.arange(s, s + c) for s, c in zip(start, count)])
    want = np.concatenate([np.arange(a, max(a, b - 49)) for a, b in zip(ends, ends[1:])])
    assert (covered == want).all()
    for a in range(0, len(start), 7):
        window = [bytes(text[start[a] + i:start[a] + i + 50]) for i in range(count[a])]
        assert len(set(window)) == count[a]


def test_index_matches_naive_suffixes():
    rng = random.Random(5)
    for n in (1, 2, 50, 300):
        text = bytes(rng.choice(b"ab\xff") for _ in range(n))
        index = repeats.RunIndex(np.frombuffer(text, np.uint8))
        order = sorted(range(n), key=lambda i: text[i:])
        assert index.order.tolist() == order
        match = index.matches()
        for a, b in zip(order, order[1:]):
            k = 0
            while max(a, b) + k < n and text[a + k] == text[b + k]:
                k += 1
            assert match[b] == k


def test_awkward_rows(docs, cases, nothing):
    got = repeats.remove(docs, keep=("a.b", "lang"), as_text=True)
    rows = got.collect()
    assert len(rows) == len(cases) and got.columns == ["doc_id", "a.b", "lang", "n_bytes", "n_removed", "n_spans", "kept"]
    order = sorted(cases, key=lambda c: (c["doc_id"] is not None, c["doc_id"] or 0))
    unique = {(c["doc_id"], c["text"]): None for c in order}
    # Two texts share an id: either may come first.
    orders = [list(unique), sorted(unique, key=lambda k: (k[0] is not None, k[0] or 0, k[1] != "other text under one id"))]
    results = [dict(zip(o, brute([(t or "").encode() for _, t in o], 100))) for o in orders]
    for r in rows:
        own = {(k[0], v[:3]) for result in results for k, v in result.items()}
        assert (r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"])) in own
    assert repeats.remove(nothing).collect() == []


def test_one_long_text_is_named_in_pieces(spark, docs):
    """A text of several pieces, with repeats inside it, across the borders of pieces, and in a second text cut elsewhere."""
    rng = np.random.default_rng(12)
    body = bytes(rng.integers(97, 123, 3 * repeats.SLICE + 12_345, dtype=np.uint8))
    again = body[repeats.SLICE - 700:repeats.SLICE + 900]
    texts = [body + b" " + again, b"intro " + body[5000:repeats.SLICE + 5000] + again[:99], b"none of it"]
    df = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in repeats.remove(df, length=100).collect()}
    tail = repeats.SLICE + 5000
    assert got[0][:2] == (len(again), 1) and got[0][2] == body + b" "
    assert got[1][1] == 1 and got[1][0] == repeats.SLICE and got[1][2] == b"intro " + again[:99]
    assert got[2] == (0, 0, b"none of it") and tail > repeats.SLICE


def test_an_index_in_parts_finds_the_same(spark, docs, monkeypatch):
    rng = random.Random(9)
    line = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = [line(300) for _ in range(6)]
    rows = [(i, line(rng.randint(0, 80)) + rng.choice(shared)[rng.randint(0, 60):] + line(rng.randint(0, 80))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = lambda: sorted((r["doc_id"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in repeats.remove(df, length=100).collect())
    whole = found()
    monkeypatch.setattr(repeats, "INDEXED", 500)
    assert found() == whole and sum(r[1] for r in whole)
