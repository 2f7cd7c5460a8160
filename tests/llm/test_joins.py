"""Operators 5 and 8: exact search and the similarity join, against brute force."""

import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeweave.llm import catalog, components, setjoin, shingles, topk


def best(rows, k):
    sound = {i: v for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    whole = {i: [int(np.floor(64 * float(x))) for x in v] for i, v in sound.items()}
    out = {}
    for q in whole:
        if q % 20 == 0:
            score = lambda c: sum(a * b for a, b in zip(whole[q], whole[c]))
            ranked = sorted(((-score(c), c) for c in whole if c != q))[:k]
            out[q] = [(n + 1, c, -s) for n, (s, c) in enumerate(ranked)]
    return out


@pytest.mark.parametrize("sizes", [(8192, 1024), (7, 2)])
def test_search_is_exact(spark, docs, sizes):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=rng.choice([6, 6, 4]))]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]  # ties
    rows += [(400, None), (420, [1.0, None]), (440, [float("nan")] * 6), (460, [float("inf")] * 6), (480, []), (500, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, e array<double>").select("vec_id", topk.whole_parts(F.col("e")).alias("vector"))
    got = defaultdict(list)
    for r in topk.search(df, df.filter("vec_id % 20 = 0"), 5, shard_rows=sizes[0], query_rows=sizes[1]).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(tuple(r)[1:])
    assert got == best(rows, 5)


def test_few_candidates_and_none(spark, docs):
    df = spark.createDataFrame([(0, [1]), (1, [2]), (2, [-3])], "vec_id long, vector array<long>")
    got = [tuple(r) for r in topk.search(df, df.filter("vec_id = 0"), 20).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2), (0, 2, 2, -3)]
    assert topk.search(df.limit(0), df.limit(0), 3).collect() == []
    assert topk.search(df.filter("vec_id = 0"), df.filter("vec_id = 0"), 3).collect() == []


def test_pruned_search_equals_full_search():
    rng = np.random.default_rng(0)
    vectors = rng.integers(-20, 20, (3000, 64))
    shard = topk.Shard(rng.permutation(3000), vectors)
    for query in rng.integers(-20, 20, (20, 64)):
        ids, scores = shard.best(query, 7, 10)
        full = query @ shard.terms
        order = [i for i in np.lexsort((shard.ids, -full)) if shard.ids[i] != 7][:10]
        assert ids.tolist() == shard.ids[order].tolist() and scores.tolist() == full[order].tolist()


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_queries_against_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("embeddings", "documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    answer = con.sql(catalog.ORACLES[name])
    got = catalog.QUERIES[name](spark, folder).select(*answer.columns).collect()
    assert sorted(map(tuple, got)) == sorted(answer.fetchall())


def sets_of(text, words=3):
    own = (text or "").encode()
    own = bytes(c + 32 if 65 <= c <= 90 else c for c in own).split()
    if len(own) < words:
        return {tuple(own)} if own else set()
    return {tuple(own[i:i + words]) for i in range(len(own) - words + 1)}


def groups(rows, pct, words=3):
    """Components of all rows by id; rows without words are linked by their id only."""
    first = lambda i: -1 << 63 if i is None else i
    root = {first(i): first(i) for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    made = [(first(i), sets_of(t, words)) for i, t in rows]
    for n, (i, x) in enumerate(made):
        for j, y in made[:n]:
            common = len(x & y)
            if x and y and 100 * common >= pct * (len(x) + len(y) - common):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in root}


@pytest.mark.parametrize("seed, pct", [(1, 90), (2, 90), (3, 60)])
def test_groups_as_by_brute_force(spark, docs, seed, pct):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([2, 5, 40, 120]))]
        for _ in range(rng.randint(1, 12)):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append(" ".join(own + rng.choice([[], ["The", "same", "closing", "line", "of", "all"]])))
    rows = list(enumerate(rng.sample(rows, len(rows))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in setjoin.groups(df, pct=pct, most_frequent=50).collect()}
    root = groups(rows, pct)
    assert got == {i: (len(sets_of(t)), root[i]) for i, t in rows}


def test_broadcast_bound_does_not_matter(spark, docs):
    rows = [(i, " ".join(f"v{j}" for j in range(60)) + f" end{i % 3}") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    both = [sorted(map(tuple, setjoin.groups(df, most_broadcast=n).collect())) for n in (0, 1 << 20)]
    assert both[0] == both[1] and {r[2] for r in both[0]} == {0}


def test_awkward_rows(docs, cases, nothing):
    got = setjoin.groups(docs).collect()
    assert len(got) == len(cases)
    root = groups([(c["doc_id"], c["text"]) for c in cases], 90)
    for r in got:
        key = -1 << 63 if r["doc_id"] is None else r["doc_id"]
        want = root[key]
        assert r["component_id"] == (None if want == -1 << 63 else want)
    assert setjoin.groups(nothing).collect() == []


def test_components_of_random_graphs(spark, docs):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(400 + i, 401 + i) for i in range(40)]
    root = {n: n for e in edges for n in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["root"] for r in components.contract(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for a, b in edges if a != b for n in (a, b)}


def test_shingles_do_not_cross_texts():
    texts = [b"a b c d", b"", b" ", b"A b", b"a  b\n", b"x", b"a b c a b c a b c"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    found, owner = shingles.shingles(data, np.cumsum([0, *map(len, texts)]), 3)
    assert np.bincount(owner, minlength=len(texts)).tolist() == [2, 0, 0, 1, 1, 1, 3]
    assert found[owner == 3] == found[owner == 4] and set(found[owner == 0]) & set(found[owner == 6])
