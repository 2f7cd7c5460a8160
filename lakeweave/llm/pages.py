"""The main text of web pages by a recurrent block labeller.

A page becomes its leaf blocks in order (``markup``), the labeller (``labeller``) reads them all in both directions and
gives each a probability; blocks from one half on are the text. Nothing of a page is cut, whatever its length: pages of a
few megabytes of markup at a time are taken apart, and their blocks leave as text at once.

The labeller is fitted on the driver to a bounded sample: at most ``most_pages`` pages with the smallest hashes of their
columns other than the markup, of each at most ``most_blocks`` blocks and ``most_words`` words a block. Labels come from
the pages' own markup. The same table gives the same labeller.

Null and empty markup, and markup without text, give an empty text. Equal rows get equal texts. A table without pages has
no labeller and no rows.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.llm.common import named, sliced, trim, with_columns
from lakeweave.llm.labeller import Network, read_blocks, sample_page
from lakeweave.llm.markup import leaves

#: Bytes of markup that are taken apart at a time.
SLICE = 1 << 20


def sample(pages: DataFrame, html: str, keys: tuple[str, ...], most_pages: int, most_blocks: int, most_words: int) -> list[list[dict]]:
    """Pages to learn from. The keys alone are read to choose them; if too few of these have a block, markup is looked at too."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "html", SLICE):
            rank, made = [], []
            for hashed, page in zip(batch.column("rank").to_pylist(), batch.column("html").to_pylist()):
                found = leaves(page or "")
                if found:
                    rank.append(hashed)
                    made.append(sample_page(found, most_blocks, most_words))
            yield pa.RecordBatch.from_arrays([pa.array(rank, pa.int64()), pa.array(made, pa.string())], ["rank", "page"])

    ranked = pages.select(F.xxhash64(*[named(k) for k in keys]).alias("rank"), named(html).alias("html"))
    found: list[str] = []
    for rows in (ranked, ranked.filter("octet_length(html) > 0")):
        last = rows.orderBy("rank").limit(most_pages).agg(F.max("rank"), F.count("*")).first()
        if last[0] is None:
            break
        chosen = rows.filter(F.col("rank") <= last[0]).mapInArrow(read, "rank long, page string")
        found = [r["page"] for r in chosen.orderBy("rank", "page").limit(most_pages).collect()]
        if len(found) == most_pages or last[1] < most_pages:
            break
    return [json.loads(page) for page in found]


def fit(pages: DataFrame, html: str = "html", keys: tuple[str, ...] = ("page_id", "url"), most_pages: int = 320,
        most_blocks: int = 192, most_words: int = 48, rounds: int = 20) -> bytes | None:
    """A labeller for the pages, or nothing if no page has a block."""
    learned = sample(pages, html, keys, most_pages, most_blocks, most_words)
    if not learned:
        return None
    network = Network()
    network.learn(learned, rounds)
    return pickle.dumps({k: v.astype("float32") for k, v in network.w.items()})


def extract(pages: DataFrame, model: bytes | None, html: str = "html", text: str = "text") -> DataFrame:
    """Add ``text``, the main text of each page, blocks joined by a line feed; a column of this name is replaced."""
    place = pages.columns.index(html)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        network = Network(pickle.loads(model)) if model else None
        for batch in sliced(batches, f"c{place}", SLICE):
            taken = [leaves(page or "") for page in batch.column(place).to_pylist()]
            found = network.label(read_blocks(taken)) if network and any(taken) else []
            texts, at = [], 0
            for page in taken:
                texts.append("\n".join(leaf.text for leaf, p in zip(page, found[at:at + len(page)]) if p >= 0.5))
                at += len(page)
            yield batch, [pa.array(texts, pa.string())]
        trim()

    return with_columns(pages, read, T.StructType([T.StructField(text, T.StringType())]))
