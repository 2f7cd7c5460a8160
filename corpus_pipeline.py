"""From documents to token ids: five stages, each written and read again.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows of the stage
before. All but the last return the columns of ``documents``, and further ones
of any name as they are. Rows with null texts have no language and leave in the
first stage; an empty table passes through all stages. Where rows tie, a hash
of all their columns decides; rows equal in all columns are alike to each stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.llm import bpe, langid, mixing, repeats, setjoin
from lakeweave.llm.common import named, reach_workers, running_totals, stored
from lakeweave.session import scratch_dir

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: A text is rejected if its words give no language half of the probability.
LEAST_SCORE = 0.5
#: Near copies share this percentage of their shingles of so many words; ``op8_setjoin`` has bounds of its own.
NEAR_WORDS, NEAR_PCT = 5, 80
#: Shares of documents are whole numbers of this part.
SHARE_UNIT = 1 << 24


def carried(docs: DataFrame, *own: str) -> DataFrame:
    """The columns ``own``, and all others by place in the struct ``row``, out of the way of the operators."""
    return docs.select(*own, F.struct(F.lit(0).alias("f"), *[named(c).alias(f"f{i}") for i, c in enumerate(docs.columns) if c not in own]).alias("row"))


def restored(df: DataFrame, docs: DataFrame, **own: Column) -> DataFrame:
    """The columns of ``docs`` again: ``own`` as given, all others from the struct that ``carried`` made."""
    return df.select(*[own.get(c, F.col("row").getField(f"f{i}")).alias(c) for i, c in enumerate(docs.columns)])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts with a language; rows without one get what was found."""
    reach_workers(spark)
    found = langid.identify(carried(docs, "text", "lang"), F.lit(True))
    kept = found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return restored(kept, docs, text=F.col("text"), lang=F.coalesce("lang", "lang_pred"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id stays, a null id before all others; of several, that of
    the smallest hash of all columns.

    Only texts link rows: rows that share an id, or have none, are told apart. Equal rows are one, also without words.
    """
    reach_workers(spark)
    # Numbers are the ids of the join; they are stored with the rows, so that they stay.
    rows = stored(carried(docs, "doc_id", "text").withColumn("number", F.monotonically_increasing_id()), "near_rows")
    groups = setjoin.groups(rows, doc_id="number", words=NEAR_WORDS, pct=NEAR_PCT)
    own = rows.select("number", "doc_id", F.xxhash64("doc_id", "text", "row").alias("mark")).join(groups, "number")
    wordless = F.col("n_shingles") == 0
    kept = own.groupBy(F.when(~wordless, F.col("component_id")), F.when(wordless, F.col("doc_id")), F.when(wordless, F.col("mark"))).agg(
        F.min(F.struct("doc_id", "mark", "number")).alias("first")).select("first.number")
    return restored(rows.join(kept, "number", "left_semi"), docs, doc_id=F.col("doc_id"), text=F.col("text"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of a hundred bytes that stand earlier go; a document goes if no word is left of it.

    Documents are ordered by id, null first, and by a hash of the text where rows share an id; equal rows are one.
    """
    reach_workers(spark)
    cut = repeats.remove(carried(docs, "doc_id", "text"), length=100, keep=("row",), as_text=True)
    left = cut.filter((F.col("n_removed") == 0) | F.col("kept").rlike("[^\\x20\\x09-\\x0D]"))
    return restored(left, docs, doc_id=F.col("doc_id"), text=F.col("kept"), n_chars=F.length("kept").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as keeps step with the words that the mix takes of their source.

    The shares taken are summed over the documents of a source in order of size, and a document stands as
    often as the sum passes a whole number in it: its share rounded up or down, without leaning to either.
    Equal rows stand equally often.
    """
    reach_workers(spark)
    rows = carried(docs, "text", "source").withColumn("row_key", F.xxhash64("text", "source", "row"))
    mixed = mixing.mix(rows, [3, 1, 2], share=1.5, most_repeats=2, block_words=1024, shard_blocks=64, doc_id="row_key")
    taken = mixed.filter("size > 0").groupBy("row_key").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    sources = rows.groupBy("row_key").agg(F.min("source").alias("source"))
    shares = taken.join(sources, "row_key").withColumn("share", F.round(F.col("taken") / F.col("size") * SHARE_UNIT).cast("long"))
    placed = running_totals(shares, ["source", "size", "row_key"], {"before": "share"}, "copies")
    times = placed.select("row_key", F.expr(f"(before + share) div {SHARE_UNIT} - before div {SHARE_UNIT}").cast("int").alias("times"))
    rows = rows.join(times.filter("times > 0"), "row_key")
    return restored(rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))), docs, text=F.col("text"), source=F.col("source"))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the checksum of the text that they decode to; further columns end here.

    The ids are stored between the two: in one chain each task would hold a worker for either.
    """
    reach_workers(spark)
    ids = stored(bpe.encode(docs, VOCABULARY, keep=("lang", "source")), "ids")
    return bpe.decode(ids, VOCABULARY).select(
        "doc_id", "lang", "source", F.expr("octet_length(ids) div 4").alias("n_tokens"), "ids",
        F.crc32("decoded").alias("decoded_crc32"))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("mix_sources", mix_sources),
    ("bpe", encode_texts),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
