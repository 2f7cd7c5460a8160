import random

import pytest

from lakeweave.llm.common import reach_workers

SCHEMA = "doc_id long, text string, lang string, source string, block int, rows string, id long, score double, `a.b` int"


def line(rng, words=12):
    return " ".join(rng.choice("alpha beta gamma delta der die das und la le les été ñandú one's 42 x2".split()) for _ in range(words))


@pytest.fixture(scope="session")
def cases(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns whose names the operators use."""
    reach_workers(spark)
    rng = random.Random(3)
    texts = [None, "", " \n\t ", "Hello World", "Hello World", "<|startoftext|>go <|endoftext|>", "été ﬁn Ⅷ İstanbul ΣΑΣ",
             "日本語 テキスト 한국어", "don't we'll I'D 's '", " a b\u0085c", "x" * 3000, "ab " * 4000,
             " ".join(line(rng) for _ in range(900))]
    texts += [line(rng, rng.randint(1, 60)) + ("\n" + line(rng) if i % 3 else "") for i in range(40)]
    texts += [texts[20], texts[21] + " more", texts[22]]
    langs, sources = ["en", "de", None], ["s1", "s0", None, "é", "s1"]
    rows = [(i * 3 if i != 7 else None, t, langs[i % 3], sources[i % 5], i, None, None, None, i) for i, t in enumerate(texts)]
    rows += [rows[25], rows[25], (rows[26][0], "other text under one id", "en", "s1", 1, "r", 2, 3.0, None)]
    return [dict(zip([c.split()[0].strip("`") for c in SCHEMA.split(", ")], r)) for r in rows]


@pytest.fixture(scope="session")
def docs(spark, cases):
    return spark.createDataFrame([tuple(c.values()) for c in cases], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    reach_workers(spark)
    return spark.createDataFrame([], SCHEMA)
