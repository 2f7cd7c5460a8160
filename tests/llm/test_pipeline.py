"""The pipeline stage by stage, each against brute force on what the stage before has kept."""

import importlib.util
import subprocess
import sys
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from lakeweave.llm import catalog
from test_joins import groups
from test_repeats import brute

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_do_what_they_say(spark, docs, tmp_path):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "12 34 !", None, "s", 7)]
    twice = given.filter("doc_id = 3")
    rows = given.unionByName(spark.createDataFrame(odd, given.schema)).unionByName(twice).unionByName(
        given.filter("doc_id = 4").withColumn("lang", given["lang"].substr(9, 1)).selectExpr("9004L AS doc_id", "text || ' und' AS text", "nullif(lang, '') AS lang", "source", "n_chars"))
    kept = [rows]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, kept[-1], FOLDER).write.parquet(path)
        kept.append(spark.read.parquet(path))
    made = [df.collect() for df in kept]
    assert all(df.columns == COLUMNS for df in kept[:-1])

    ids = Counter(r["doc_id"] for r in made[1])
    assert set(ids) >= {r["doc_id"] for r in made[0]} - {9001, 9002, 9003} - {r["doc_id"] for r in made[0] if r["text"] and len(r["text"]) < 60}
    assert not set(ids) & {9001, 9002, 9003} and ids[3] == 2 and all(r["lang"] for r in made[1])

    root = groups([(r["doc_id"], r["text"]) for r in made[1]], corpus_pipeline.NEAR_PCT, corpus_pipeline.NEAR_WORDS)
    assert Counter(r["doc_id"] for r in made[2]) == Counter({i: 1 for i, r in root.items() if i == r})
    assert {tuple(r) for r in made[2]} <= {tuple(r) for r in made[1]}

    before = sorted(made[2], key=lambda r: r["doc_id"])
    want = {}
    for r, (_, removed, _, rest) in zip(before, brute([r["text"].encode() for r in before], 100)):
        rest = rest.decode("utf-8", "ignore")
        if not removed or rest.strip(" \t\n\x0b\x0c\r"):
            want[r["doc_id"]] = (rest, r["lang"], r["source"], len(rest))
    assert {r["doc_id"]: tuple(r)[1:] for r in made[3]} == want

    taken = Counter(tuple(r) for r in made[4])
    assert set(taken) <= {tuple(r) for r in made[3]} and max(taken.values()) <= 2
    size = lambda rs: sum(len(r["text"].encode().split()) for r in rs)
    assert 1.2 * size(made[3]) < size(made[4]) < 1.8 * size(made[3])

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    encode = lambda t: np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in made[5]) == Counter((r["doc_id"], encode(r["text"])) for r in made[4])


def test_empty_documents_pass(spark, tmp_path):
    folder = tmp_path / "sf"
    spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0).write.parquet(str(folder / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(folder)).collect() == []


def test_the_rest_imports_without_the_subpackage(tmp_path):
    code = ("import sys, importlib.util as u; real = u.find_spec\n"
            "u.find_spec = lambda n, *a: None if n == 'lakeweave.llm' else real(n, *a)\n"
            "import __spark_entry__ as e; assert 'op1_bpe' not in e.queries() and len(e.queries()) > 90; print('fine')")
    root = importlib.util.find_spec("corpus_pipeline").origin.rpartition("/")[0]
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.stdout.strip() == "fine", done.stderr
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
