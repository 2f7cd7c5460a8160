"""Stages of the pipeline on rows made for them."""

import random
from collections import Counter

import corpus_pipeline
from lakeweave.llm import mixing
from test_joins import sets_of

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], COLUMNS).repartition(3)


def alike(x, y):
    x, y = sets_of(x, 5), sets_of(y, 5)
    return 100 * len(x & y) >= 80 * len(x | y)


def test_near_copies_share_five_words_in_eight_tenths(spark, docs):
    rng = random.Random(4)
    base, other = words(rng, 200), words(rng, 100)
    replaced, far = list(base), list(base)
    for at in (20, 70, 120, 170):
        replaced[at] = "new"
    for at in range(10, 190, 20):
        far[at] = "new"
    texts = [" ".join(t) for t in (base, replaced, far, other, other + words(rng, 12), words(rng, 80))]
    want = [i for i, t in enumerate(texts) if not any(alike(t, u) for u in texts[:i])]
    assert want == [0, 2, 3, 5]
    kept = corpus_pipeline.drop_near_copies(spark, table(spark, [(i, t, "s") for i, t in enumerate(texts)]), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_sources_of_long_documents_meet_their_mix(spark, docs):
    rows = [(i if i % 7 else None, f"d{i} " + "w " * (4000 + 50 * i), f"s{i % 3}") for i in range(90)]
    df = table(spark, rows)
    size = {t: len(t.split()) for _, t, _ in rows}
    mixed = mixing.mix(df, [3, 1, 2], share=1.5, most_repeats=2, block_words=1024, shard_blocks=64).collect()
    got, copies = Counter(), Counter()
    for r in corpus_pipeline.mix_sources(spark, df, "").collect():
        got[r["source"]] += size[r["text"]]
        copies[r["text"]] += 1
    assert max(copies.values()) <= 2
    for source in ("s0", "s1", "s2"):
        target = next(r["target"] for r in mixed if r["source_size"] == sum(size[t] for _, t, s in rows if s == source))
        assert abs(got[source] - target) <= 2 * max(size.values()), (source, got[source], target)


def test_only_texts_link_rows(spark, docs):
    rng = random.Random(8)
    text = [" ".join(words(rng, 60)) for _ in range(9)]
    rows = [(5, text[0], "s"), (9, text[1], "s"), (None, text[0] + " end", "s"), (None, text[1], "s"), (None, text[2], "s"),
            (None, text[3], "s"), (12, text[4], "s"), (12, text[5], "s"), (13, text[6], "s"), (14, text[6], "s"),
            (15, text[7], "s"), (15, text[7], "s"), (16, "", "s"), (16, "", "s"), (17, "", "s")]
    got = Counter(tuple(r)[:2] for r in corpus_pipeline.drop_near_copies(spark, table(spark, rows), "").collect())
    want = [(None, text[0] + " end"), (None, text[1]), (None, text[2]), (None, text[3]), (12, text[4]), (12, text[5]),
            (13, text[6]), (15, text[7]), (16, ""), (17, "")]
    assert got == Counter(want)


CLASHING = ["a.b", "row", "copy", "times", "number", "row_number", "row_key", "kept", "n_removed", "n_bytes", "lang_pred", "lang_found", "score",
            "lang_score", "component_id", "n_shingles", "mark", "first", "doc", "tie", "id", "c0", "_"]


def test_columns_of_any_name_pass(spark, docs):
    """Each stage gives back every column with the values it came with."""
    rng = random.Random(5)
    text = [" ".join(rng.choice("the of and that der die das und le la les des".split()[4 * (i % 3):4 * (i % 3) + 4]) + f" word{rng.randrange(999)}"
                     for _ in range(rng.randint(30, 60))) for i in range(24)]
    rows = [(i, t, ["en", "de", "fr"][i % 3], f"s{i % 2}", len(t), *[f"{c} {i}" for c in CLASHING]) for i, t in enumerate(text)]
    df = spark.createDataFrame(rows, COLUMNS + "".join(f", `{c}` string" for c in CLASHING)).repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, df, "")
        assert got.columns == df.columns, name
        found = got.collect()
        assert found and all(tuple(r)[5:] == tuple(f"{c} {r['doc_id']}" for c in CLASHING) and r["text"] == text[r["doc_id"]] for r in found), name
        if name != "mix_sources":
            assert len(found) == len(rows), name
    assert corpus_pipeline.encode_texts(spark, df, "").count() == len(rows)
