"""Operator 11: the trie of rebuilt conversations against a plain one in Python, and against SQL."""

import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from lakeweave.llm import catalog, trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def mark(role, text):
    return sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32], len(re.findall("[^\x20\x09-\x0d]+", text))


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, *mark(role or "", text or ""), role or "", text or ""))
    turns = {c: [r[4:] for r in sorted(found)] for c, found in convs.items()}
    members = defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for depth in range(len(rebuilt) + 1):
            members[rebuilt[:depth]].append((c, len(rebuilt) == depth))
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def leaves(node):
        return sum(map(leaves, children[node])) or 1

    def saved(node):
        own = (len(members[node]) - 1) * mark(*node[-1])[1] if node else 0
        return own + sum(map(saved, children[node]))

    return sorted(((min(m)[0], len(n), min(members[n[:-1]])[0] if n else None, len(m), len(children[n]), leaves(n), saved(n),
                    sha256(",".join(str(c) for c, ends in sorted(m) if ends).encode()).hexdigest()) for n, m in members.items()), key=repr)


def op11(df):
    return sorted(map(tuple, catalog.BUILDS["op11_trie"](df).select(*COLUMNS).collect()), key=repr)


def rows_of(rng, count):
    said = ["hi", "Hi there\tyou", "", "a b  c", None, "é \x0b x", "more words than the others have"]
    rows = []
    for c in range(count):
        for turn in range(rng.randint(1, 6)):
            rows.append((c * 3, turn, rng.choice(["user", "bot", None]), rng.choice(said[:3] if turn < 2 else said)))
    return rows


def test_against_brute_force(spark, nothing):
    rng = random.Random(11)
    rows = rows_of(rng, 150)
    rows += [(1, None, "user", "first"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 5, "r", "x"), (2, 5, "r", "x"),
             (None, 0, "user", "lost"), (None, None, None, None), (-41, 0, "user", "hi"), (-40, 0, "user", "hi"), (-40, 1, "u", "z"),
             (10_001, 0, "user", "alone"), (10_002, 0, "user", "alone"), (10_003, 0, "user", "x" * 70_000), (10_003, None, "user", "hi")]
    assert any(zlib.crc32(str(c).encode()) % 4 for c in (10_001, 10_002))  # one of them loses its only turn
    df = spark.createDataFrame([(*r, b"z", 7, "k", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, chain binary, depth int, `a.b` string, conv int").repartition(4)
    assert op11(df) == brute(rows)


def test_no_conversation(spark, nothing):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert op11(df) == [] and catalog.BUILDS["op11_trie"](df).columns == COLUMNS
    assert op11(spark.createDataFrame([(None, 1, "a", "b")], "conv_id long, turn long, role string, text string")) == []


def test_one_start_for_many(spark, nothing):
    """A third of all conversations are one text, another third share its first turn: more than one piece of ids."""
    rows = [(c, 0, "user", "hi") for c in range(0, 15_000, 20)]
    rows += [(c, t, "user", "hi" if t == 0 else "same" if c % 3 else f"own {c}") for c in range(15_000) if c % 20 for t in range(2)]
    assert op11(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)) == brute(rows)


def test_long_conversations(spark, nothing):
    """Tails of their own, with and without copies; a long start that two share; one that is the start of another."""
    rows = [(20 * c, t, "user", f"turn {t}" if t < 6 else f"{c} {t}") for c in range(3) for t in range(90)]
    rows += [(20 * c, t, "user", f"copy {t}") for c in range(5, 9) for t in range(45)]
    rows += [(20 * c, t, "user", f"deep {t}" if t < 20 else f"deep {c % 2} {t}") for c in range(10, 14) for t in range(24 + c)]
    rows += [(20 * c, t, "bot", f"start {t}") for c in (20, 21, 22) for t in range(c)]
    rows += [(401, t, "user", f"turn {t}") for t in range(12)]
    assert op11(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")) == brute(rows)


def test_own_tails_need_no_round(spark, nothing):
    rows = [(20 * c, t, "user", f"{c} {t}") for c in range(4) for t in range(300)]
    convs = trie.conversations(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    starts, tails = trie.truncated(trie.chains_of(convs))
    assert starts.agg(F.max("depth")).first()[0] == trie.SHORTEST and tails.count() == 4 * (300 - trie.SHORTEST)


def test_parents_of_many_children_are_spread(spark, nothing):
    rows = [(20 * c, t, "user", "hi" if t == 0 else f"{c}") for c in range(3000) for t in range(2)]
    convs = trie.conversations(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    nodes = trie.peel(trie.truncated(trie.chains_of(convs))[0])
    assert nodes.filter("depth = 1").select(F.expr("bit_count(salts)")).first()[0] == trie.SALTS
    assert nodes.count() == 3002
