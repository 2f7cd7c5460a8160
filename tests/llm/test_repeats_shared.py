"""Operator 4: a passage that very many documents share."""

import random

from lakeweave.llm import repeats
from test_repeats import brute


def test_no_task_indexes_a_passage_of_many_documents(spark, docs, monkeypatch):
    class Small(repeats.RunIndex):
        def __init__(self, text):
            assert len(text) < 15_000, "the runs of all documents in one index"
            super().__init__(text)

    monkeypatch.setattr(repeats, "RunIndex", Small)
    rng = random.Random(6)
    flank = lambda: "".join(rng.choice("abcdefghij") for _ in range(130))
    line = "".join(rng.choice("uvwxyz ") for _ in range(113))
    texts = [flank() + line + flank() for _ in range(400)]
    texts += [texts[7][:220], texts[9][60:] + flank(), line, line * 2]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in
           repeats.remove(rows, most_contents=20).collect()}
    assert [got[i] for i in range(len(texts))] == brute([t.encode() for t in texts], 100)
