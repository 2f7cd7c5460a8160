"""Operators 2 and 3: mixing sources, and sharding."""

import heapq
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeweave.llm import common, mixing, sharding


def test_jump_follows_the_published_loop():
    def plain(key, shards):
        b, j = -1, 0
        while j < shards:
            b = j
            key = (key * 2862933555777941757 + 1) % 2 ** 64
            j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
        return b

    keys = np.random.default_rng(1).integers(-2 ** 63, 2 ** 63, 500)
    for shards in (1, 2, 7, 40, 1000):
        assert sharding.jump(keys, shards).tolist() == [plain(int(k) % 2 ** 64, shards) for k in keys]


def test_shards_are_gapless_and_grow_into_the_new_one_only(docs, cases):
    got = sharding.assign(docs.select("doc_id", "text", "id"), "doc_id", 5, ("text",)).collect()
    assert len(got) == len(cases)
    slots, shard = defaultdict(list), {}
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert shard.setdefault(r["doc_id"], r["shard"]) == r["shard"]
        assert r["grown_shard"] in (r["shard"], 5)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_running_totals_over_ties_and_ranges(spark, docs):
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("w"))
    got = common.running_totals(rows, ["k", "w"], {"before": "w"}, "test").orderBy("k", "w").collect()
    at = 0
    for r in got:
        assert r["before"] == at
        at += r["w"]


def seats_by_heap(weights, n, most):
    heap = [(-w, i, 0) for i, w in enumerate(weights) if w > 0]
    heapq.heapify(heap)
    seats = [0] * len(weights)
    while n and heap:
        _, i, k = heapq.heappop(heap)
        if seats[i] == most[i]:
            continue
        seats[i] += 1
        n -= 1
        heapq.heappush(heap, (-weights[i] / (2 * (k + 1) + 1), i, k + 1))
    return seats


@pytest.mark.parametrize("seed", [1, 2])
def test_quotas_are_the_highest_quotients(spark, docs, seed):
    rng = random.Random(seed)
    rows, want = [], {}
    for g, n in ((0, 10), (1, 137), (2, 0)):
        weights = [round(rng.choice([0.0, rng.random(), rng.random() * 50]), 3) for _ in range(12)]
        want[g] = seats_by_heap(weights, n, [10 ** 6] * 12)
        rows += [(g, i, w, n, 10 ** 6) for i, w in enumerate(weights)]
    seats = spark.createDataFrame(rows, "g int, i int, weight double, n long, most long")
    got = defaultdict(dict)
    for r in mixing.quota_table(seats, ["g"], ["i"]).collect():
        got[r["g"]][r["i"]] = r["quota"]
    assert {g: [q[i] for i in range(12)] for g, q in got.items()} == want


def levels(sizes, weights, share, most):
    full, total = {i for i, s in enumerate(sizes) if s == 0}, share * sum(sizes)
    while True:
        free = [i for i in range(len(sizes)) if i not in full]
        pace = (total - sum(most * sizes[i] for i in full)) / sum(weights[i] for i in free) if free else 0
        over = {i for i in free if pace * weights[i] > most * sizes[i]}
        if not over:
            return [most * s if i in full else pace * weights[i] for i, s in enumerate(sizes)]
        full |= over


def test_mix_meets_targets_and_repeats_itself(docs, cases):
    mixed = lambda df: sorted((tuple(r) for r in mixing.mix(df, [3, 1, 2]).collect()), key=repr)
    got = mixed(docs)
    assert got == mixed(docs.repartition(5)) and len(got) == len(cases)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((c["doc_id"], size(c["text"])) for c in cases) == Counter(r[:2] for r in got)
    sources = sorted({c["source"] for c in cases} - {None}) + [None]
    sizes = [sum(size(c["text"]) for c in cases if c["source"] == s) for s in sources]
    targets = levels(sizes, [[3, 1, 2][i % 3] for i in range(len(sources))], 1.5, 2)
    by_target = defaultdict(int)
    for _, s, source_size, target, taken in got:
        assert 0 <= taken <= 2 * s
        by_target[source_size, round(target, 6)] += taken
    for s, t in zip(sizes, targets):
        assert abs(by_target[s, round(t, 6)] - t) <= 32
    assert abs(sum(targets) - 1.5 * sum(sizes)) < 1e-6


def test_empty_tables(nothing):
    assert mixing.mix(nothing, [1]).collect() == []
    assert sharding.assign(nothing, "doc_id", 3).collect() == []
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("doc_id"), 0)
