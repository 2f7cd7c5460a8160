"""What stages hold and leave behind: indexes of a bounded size, no steps that are done with, one worker a task."""

import os
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from lakeweave.llm import langid, repeats, setjoin
from lakeweave.session import scratch_root


def scratch_names(spark):
    root = scratch_root(spark).removeprefix("file:")
    return {f for f in os.listdir(root)} if os.path.isdir(root) else set()


def test_an_index_holds_no_more_runs_than_its_bound():
    size = repeats.INDEXED
    assert [repeats.index_parts(n) for n in (0, 1, size, size + 1, 2 * size - 1, 2 * size + 1)] == [1, 1, 1, 2, 2, 3]


def test_an_index_takes_less_than_sixty_bytes_for_each_of_its_text():
    rng = np.random.default_rng(1)
    base = rng.integers(97, 110, 40_000).astype(np.uint8)
    text = np.concatenate([base, [255], base[1000:1400], base[20_000:20_300], [255], rng.integers(97, 110, 30_000)]).astype(np.uint8)
    tracemalloc.start()
    found = repeats.RunIndex(text).repeated(text != 255, 100)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    again = np.flatnonzero(found)
    assert again.tolist() == [*range(40_001, 40_302), *range(40_401, 40_602)]
    assert most < 60 * len(text)


def test_near_copies_leave_only_what_is_small(spark, docs):
    before = scratch_names(spark)
    found = setjoin.groups(docs.filter("doc_id is not null"), pct=80)
    left = {name.rsplit("-", 1)[0].split("-")[0] for name in scratch_names(spark) - before}
    assert "groups" in left and not left & {"signatures", "sets", "merged", "nodes"}
    assert found.count() == docs.filter("doc_id is not null").count()


def test_the_last_stage_has_one_worker_for_each_task(spark, docs):
    plan = corpus_pipeline.encode_texts(spark, docs.select("doc_id", "text", "lang", "source"), "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InArrow") == 1 and "CoGroups" not in plan


def test_the_driver_gives_back_what_learning_took(docs, monkeypatch):
    steps, fit = [], langid.fit
    monkeypatch.setattr(langid, "fit", lambda *a: (fit(*a), steps.append("fit"))[0])
    monkeypatch.setattr(langid, "trim", lambda: steps.append("trim"))
    langid.identify(docs.select("text", "lang"), F.lit(True))
    assert steps == ["fit", "trim"]


def test_words_met_for_the_first_time_are_looked_at_in_pieces(monkeypatch):
    model = langid.fit([("le chat est dans la maison", "fr"), ("the cat is in the house", "en")], rounds=3)
    words = [b"%x" % (i * 2654435761 % (1 << 40)) for i in range(60_000)]
    texts = [b" ".join(words[i:i + 200]) for i in range(0, len(words), 200)]
    tracemalloc.start()
    found = langid.label(model)(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 600 * len(words)
    # The size of the pieces changes no language, and scores at most by rounding.
    monkeypatch.setattr(langid, "FRESH_WORDS", 7)
    few = langid.label(model)(texts[:3])
    assert [lang for lang, _ in few] == [lang for lang, _ in found[:3]]
    assert np.allclose([score for _, score in few], [score for _, score in found[:3]], rtol=0, atol=1e-6)
