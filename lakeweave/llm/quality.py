"""Quality rules whose thresholds come from the data: per language and source, from quantile sketches.

A sketch counts values in buckets whose bounds grow by a fixed ratio (DDSketch,
Masson et al.), so any quantile is right up to ``ACCURACY``. Sketches of two
groups merge by adding counts; neither order nor partitioning changes them. A
group of fewer than ``least_rows`` documents takes the merged sketch of its
language, and a language that small the one of all documents.

A document is kept if it passes the base rule and each of its measures lies
within quartile -/+ ``reach`` times the spread between the quartiles, the spread
being at least ``LEAST_SPREAD``. Sketches are made of documents that pass the
base rule.

Null and empty texts have no words and fail the base rule. Null languages and
sources are groups of their own. Equal rows count each and get equal verdicts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.llm.common import byte_values, named, stored

ACCURACY = 0.01
SMALLEST = 1e-6
#: Measures with a lower and an upper bound, and with an upper one only.
BOTH, UPPER = ("word_length",), ("symbols", "dup_lines", "repeats")
LEAST_SPREAD = {"word_length": 0.25, "symbols": 0.025, "dup_lines": 0.075, "repeats": 0.075}
SYMBOLS = b"#*$%&|<>"
SPACE = "\t\n\x0b\x0c\r "


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which occurs again in the list."""
    if len(words) < 4:
        return 0
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes = np.array([numbers[w] for w in words], np.int64)
    pairs = codes[:-1] * len(numbers) + codes[1:]
    _, pairs = np.unique(pairs, return_inverse=True)
    _, at, count = np.unique(pairs[:-1] * len(numbers) + codes[2:], return_inverse=True, return_counts=True)
    again = count[at] > 1
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift:len(words) - 2 + shift] |= again
    return int(inside.sum())


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    return len(lines) - len(set(lines))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def counts(docs: DataFrame, text: str) -> DataFrame:
    """Add the counts of ``COUNTS`` in place of the text column."""
    rest = [c for c in docs.columns if c != text]
    schema = T.StructType([*[docs.schema[c] for c in rest], *[T.StructField(c, T.LongType()) for c in COUNTS]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in byte_values(batch.column(text)):
                words = raw.split()
                decoded = raw.decode("utf-8", "replace")
                rows.append((len(words), len(decoded) - sum(map(decoded.count, SPACE)),
                             len(raw) - len(raw.translate(None, SYMBOLS)), repeated_lines(raw),
                             repeated_words(words), raw.count(b"\n") + 1))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], *columns], [*rest, *COUNTS])

    return docs.mapInArrow(count, schema)


def bucket_of(value: Column) -> Column:
    """The bucket of a value; values up to ``SMALLEST`` share the first."""
    first = math.ceil(math.log(SMALLEST) / math.log((1 + ACCURACY) / (1 - ACCURACY)))
    return F.when(value <= SMALLEST, F.lit(first)).otherwise(
        F.ceil(F.log(value) / math.log((1 + ACCURACY) / (1 - ACCURACY)))).cast("int")


def value_of(bucket: Column) -> Column:
    ratio = (1 + ACCURACY) / (1 - ACCURACY)
    value = F.pow(F.lit(ratio), bucket) * 2 / (ratio + 1)
    return F.when(value <= SMALLEST, 0.0).otherwise(value)


def sketch(df: DataFrame, group: list[str], measures: dict[str, Column]) -> DataFrame:
    """One row per group, measure and bucket with its count ``n``."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket_of(c).alias("bucket"))
                                 for m, c in measures.items()])).alias("v")
    return df.select(*group, values).groupBy(*group, "v.measure", "v.bucket").agg(F.count("*").alias("n"))


def merged(sketches: DataFrame, group: list[str]) -> DataFrame:
    """The sketches of all rows that agree in ``group``."""
    return sketches.groupBy(*group, "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, group: list[str]) -> DataFrame:
    """``rows``, ``q1`` and ``q3`` of each group and measure; a sketch has a bounded number of buckets."""
    own = Window.partitionBy(*group, "measure")
    ranked = sketches.withColumns({"upto": F.sum("n").over(own.orderBy("bucket")), "rows": F.sum("n").over(own)})
    at = [F.min(F.when(F.col("upto") >= F.ceil(q * F.col("rows")), F.col("bucket"))) for q in (0.25, 0.75)]
    return ranked.groupBy(*group, "measure").agg(
        F.first("rows").alias("rows"), value_of(at[0]).alias("q1"), value_of(at[1]).alias("q3"))


def thresholds(sketches: DataFrame, least_rows: int, reach: float) -> DataFrame:
    """``lang``, ``source`` and a lower and an upper bound for each measure."""
    by_source, by_lang = quartiles(sketches, ["lang", "source"]), quartiles(merged(sketches, ["lang"]), ["lang"])
    all_rows = quartiles(merged(sketches, []), [])
    lang = by_lang.select(F.col("lang").alias("l"), F.col("measure").alias("lm"), F.struct("rows", "q1", "q3").alias("in_lang"))
    top = all_rows.select(F.col("measure").alias("tm"), F.struct("rows", "q1", "q3").alias("in_all"))
    known = by_source.withColumn("own", F.struct("rows", "q1", "q3")).join(
        lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("measure") == F.col("lm"))).join(
        top, F.col("measure") == F.col("tm"))
    chosen = F.when(F.col("own.rows") >= least_rows, F.col("own")).when(
        F.col("in_lang.rows") >= least_rows, F.col("in_lang")).otherwise(F.col("in_all"))
    known = known.withColumn("q", chosen)
    least = F.element_at(F.create_map(*[F.lit(x) for pair in LEAST_SPREAD.items() for x in pair]), F.col("measure"))
    spread = F.greatest(F.col("q.q3") - F.col("q.q1"), least) * reach
    return known.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("measure") == m, bound)).alias(f"{m}_{end}")
        for m in (*BOTH, *UPPER) for end, bound in (("low", F.col("q.q1") - spread), ("high", F.col("q.q3") + spread))])


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
          least_words: int = 50, most_repeat_pct: int = 50, least_rows: int = 100, reach: float = 4.0) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every document."""
    rows = stored(counts(docs.select(named(doc_id).alias("id"), named(text).alias("text"), named(lang).alias("lang"),
                                     named(source).alias("source")), "text"), "quality")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeat_pct * F.col("n_words"))
    words = F.greatest(F.col("n_words"), F.lit(1))
    measures = {"word_length": F.col("word_chars") / words, "symbols": F.col("n_symbols") / words,
                "dup_lines": F.col("n_dup_lines") / F.col("n_lines"), "repeats": F.col("n_repeat_words") / words}
    rows = rows.withColumn("base_failed", failed)
    bounds = thresholds(stored(sketch(rows.filter(~failed), ["lang", "source"], measures), "sketches"), least_rows, reach)
    joined = rows.join(bounds.select(F.col("lang").alias("l"), F.col("source").alias("s"), *bounds.columns[2:]),
                       F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left")
    fits = ~F.col("base_failed")
    for m in (*BOTH, *UPPER):
        fits &= F.coalesce(measures[m] <= F.col(f"{m}_high"), F.lit(True))
    for m in BOTH:
        fits &= F.coalesce(measures[m] >= F.col(f"{m}_low"), F.lit(True))
    return joined.select(F.col("id").alias(doc_id), *COUNTS[:-1], "base_failed", fits.alias("kept"))
