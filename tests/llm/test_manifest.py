"""Operator 12: Merkle trees, proofs and folded roots against a plain tree in Python, and against SQL."""

import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeweave.llm import catalog, manifest


def digest(text):
    return sha256(text.encode()).hexdigest()


def tree(leaves):
    """All levels of a tree, the leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i:i + 8])) for i in range(0, len(below), 8)])
    return levels


def way(levels, at):
    steps = []
    for level in levels[:-1]:
        first = at - at % 8
        steps.append((level[first:at], level[at + 1:first + 8]))
        at //= 8
    return steps


def fold(node, steps):
    for left, right in steps:
        node = digest("".join(left) + node + "".join(right))
    return node


def row_leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    by = defaultdict(list)
    for r in rows:
        changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        text = r[4] and bytes(c + 32 if 65 <= c <= 90 else c for c in r[4].encode()).decode()
        by[r[2]].append((r[0], row_leaf(r), row_leaf((*r[:4], text)) if changed else row_leaf(r)))
    names = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([r[1] for r in sorted(by[x], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))]) for x in names}
    crown = tree([trees[x][-1][0] for x in names])
    out = []
    for k, x in enumerate(names):
        for at, (doc_id, leaf, own) in enumerate(sorted(by[x], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))):
            steps = way(trees[x], at) + way(crown, k)
            root = fold(own, steps)
            out.append((doc_id, leaf, trees[x][-1][0], crown[-1][0], digest("".join(h for a, b in steps for h in a + b)), root, root == crown[-1][0]))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("leaves", [1, 2, 7, 8, 9, 63, 64, 65, 100, 511, 512])
def test_places_follow_the_log(leaves):
    digests = [sha256(str(i).encode()).digest() for i in range(leaves)]
    levels = manifest.levels_of(leaves)
    log = manifest.append_log(iter(digests), leaves, levels)
    nodes = [log[i:i + 32].hex() for i in range(0, len(log), 32)]
    expected = tree([d.hex() for d in digests])
    assert len(nodes) == sum(map(len, expected)) and nodes[-1] == expected[-1][0]
    for level, row in enumerate(expected):
        assert [nodes[i] for i in manifest.places(level, np.arange(len(row)), leaves)] == row


def test_awkward_rows(spark, cases):
    rows = [(c["doc_id"], c["source"], c["lang"], i if i % 4 else None, c["text"]) for i, c in enumerate(cases)]
    df = spark.createDataFrame([(*r, 1, "x", "y", 2, b"z") for r in rows],
                               "doc_id long, source string, lang string, n_chars long, text string, at int, tree string, root string, `a.b` int, path binary")
    got = sorted(map(tuple, op12(df).select(*COLUMNS).collect()), key=repr)
    assert got == brute(rows) and {r[-1] for r in got} == {True, False}


def op12(df):
    # The registered function reads a folder; the query itself is the function below it.
    return catalog.BUILDS["op12_manifest"](df)


@pytest.mark.parametrize("count", [0, 1, 9])
def test_small_tables(spark, nothing, count):
    rows = [(i, "s", None, 3, "ABC") for i in range(count)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert sorted(map(tuple, op12(df).select(*COLUMNS).collect()), key=repr) == brute(rows)


def test_many_blocks_of_one_tree(spark, nothing):
    rows = [(i, None, "én" if i % 3 else "de", i % 7, f"Text {i % 1000}") for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert sorted(map(tuple, op12(df).select(*COLUMNS).collect()), key=repr) == brute(rows)


def test_three_tiers(spark, nothing):
    count = manifest.BLOCK ** 2 + 700
    rows = spark.range(count).select("id", F.lit("x").alias("tree"), F.col("id").alias("at"), F.lit(count).cast("long").alias("n"),
                                     F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    tiers = manifest.build(rows)
    levels = tree([digest(str(i)) for i in range(count)])
    assert len(tiers) == 3 and bytes(manifest.roots(tiers).first()["root"]).hex() == levels[-1][0]
    given = manifest.roots(tiers).select("tree", F.lit(b"").alias("path"), F.lit(b"").alias("tops"))
    some = rows.filter(F.col("id").isin(0, 511, 512, count - 701, count - 700, count - 1)).select("tree", "at")
    for r in manifest.siblings(some, manifest.known_paths(tiers, given)).collect():
        steps = way(levels, r["at"])
        assert bytes(r["path"]) == b"".join(bytes((len(a), len(b))) + bytes.fromhex("".join(a + b)) for a, b in steps)
        assert bytes(r["tops"]).hex() == levels[-1][0]
