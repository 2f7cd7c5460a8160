"""A value for every distinct word of a corpus, joined back to the texts block by block.

Documents are dealt into blocks. Each block names its distinct words once, in
packets by a hash of the word; one task per packet number merges the packets of
all blocks, works out the value of each distinct word a single time, and answers
every block with the values in the order it asked. A block then holds a
dictionary for exactly its own words, so no task sees the whole word table.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakeweave.llm.common import byte_values, pieces, trim

BLOCK_BYTES = 8 << 20


def dealt_words(words, buckets: int) -> list[list[bytes]]:
    """Distinct words by bucket, each list in byte order."""
    lists: list[list[bytes]] = [[] for _ in range(buckets)]
    crc32 = zlib.crc32
    for word in words:
        lists[crc32(word) % buckets].append(word)
    for one in lists:
        one.sort()
    return lists


def split_words(columns: list[pa.Array], lower: bool) -> tuple[pa.Array, np.ndarray]:
    """All words of string columns one behind another, and how many each value has; null has none.

    Words are cut where ``bytes.split()`` cuts; ``lower`` puts A-Z in lower case first.
    """
    words, sizes = [], []
    for column in columns:
        # A view, as bytes need not be UTF-8 to be cut at ASCII white space.
        column = column.cast(pa.large_binary()).view(pa.large_string()).fill_null("")
        lists = pc.ascii_split_whitespace(pc.ascii_lower(column) if lower else column)
        found, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
        ends -= ends[0] if len(ends) else 0
        # White space at either end, or a text without words, leaves empty ones.
        real = pc.not_equal(pc.binary_length(found), 0)
        if pc.all(real).as_py() is False:
            ends = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False), dtype=np.int64)])[ends]
            found = found.filter(real)
        words.append(found.cast(pa.large_string()))
        sizes.append(np.diff(ends))
    if not words:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    return pa.concat_arrays(words), np.concatenate(sizes)


def distinct_words(words: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """The distinct words as bytes, and the number among them of each word."""
    coded = words.dictionary_encode()
    return coded.dictionary.cast(pa.large_binary()).to_pylist(), coded.indices.to_numpy()


def pack_values(values: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, values), np.uint32, len(values))
    return zlib.compress(np.uint32(len(values)).tobytes() + sizes.tobytes() + b"".join(values))


def unpack_values(packed: bytes) -> list[bytes]:
    raw = zlib.decompress(packed)
    count = int(np.frombuffer(raw, np.uint32, 1)[0])
    ends = np.cumsum(np.frombuffer(raw, np.uint32, count, 4), dtype=np.int64) + 4 + 4 * count
    ends = ends.tolist()
    return [raw[a:b] for a, b in zip([4 + 4 * count, *ends[:-1]], ends)] if count else []


def pack_rows(rows: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(rows)
    return out.getvalue().to_pybytes()


def unpack_rows(packed: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(packed).read_next_batch()


class WordBlocks:
    """The rows of ``docs`` in blocks by hash of the row, and the words of their ``text`` column.

    ``lower`` puts A-Z in lower case first. ``numbered`` cuts all words of a
    block at once in Arrow, which is quicker and holds them all; ``join`` then
    hands out their numbers too. Block and packet numbers follow the
    size of the input, so a packet of a larger corpus holds no more words. A
    word that a third of all rows use is one entry per block.
    """

    def __init__(self, docs: DataFrame, text: str, lower: bool = False, block_bytes: int = BLOCK_BYTES,
                 numbered: bool = False):
        self.text, self.names, self.lower, self.numbered = text, docs.columns, lower, numbered
        self.n = n = pieces(docs, text, block_bytes)
        names = docs.columns
        dealt = docs.withColumn("block", F.pmod(F.xxhash64(*names), F.lit(n)).cast("int"))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                numbers = batch.column("block").to_numpy()
                rows = batch.select(names)
                order = np.argsort(numbers, kind="stable")
                starts = np.flatnonzero(np.diff(numbers[order], prepend=-1))
                packed = [pack_rows(rows.take(pa.array(own))) for own in np.split(order, starts[1:])] if len(order) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[order[starts]], pa.int32()), pa.array(packed, pa.binary())], ["block", "rows"])

        # Packed, the texts take half the room on their way.
        self.blocks = dealt.mapInArrow(pack, "block int, rows binary").repartition(n, "block")

    def words_of(self) -> Callable[[bytes], list[bytes]]:
        return (lambda value: value.lower().split()) if self.lower else bytes.split

    def answers(self, value_of: Callable[[list[bytes], list[int]], list[bytes]], counted: str | None = None,
                summary: Callable[[list[bytes], list[int]], bytes] | None = None) -> DataFrame:
        """``values`` of the words of each ``block`` and packet (``bucket``).

        ``value_of`` gets distinct words and how often they occur over the
        documents with a true ``counted`` column (0 if none is named). What
        ``summary`` makes of a packet stands in a row of block -1.
        """
        n, text, lower, numbered, words_of = self.n, self.text, self.lower, self.numbered, self.words_of()

        def ask(packs: pa.Table) -> pa.Table:
            own: dict[bytes, int] = Counter()
            if numbered:
                rows = list(map(unpack_rows, packs["rows"].to_pylist()))
                words, sizes = split_words([r.column(text) for r in rows], lower)
                distinct, numbers = distinct_words(words)
                if counted:
                    numbers = numbers[np.repeat([bool(c) for r in rows for c in r.column(counted).to_pylist()], sizes)]
                own = dict(zip(distinct, np.bincount(numbers, minlength=len(distinct)).tolist()))
                del rows, words, distinct, numbers
            for rows in [] if numbered else map(unpack_rows, packs["rows"].to_pylist()):
                count = rows.column(counted).to_pylist() if counted else [False] * rows.num_rows
                for value, counts in zip(byte_values(rows.column(text)), count):
                    words = words_of(value)
                    if counts:
                        own.update(words)
                    else:
                        for word in set(words):
                            own.setdefault(word, 0)
            asked = [(i, words) for i, words in enumerate(dealt_words(own, n)) if words]
            packed = [zlib.compress(b" ".join(words)) for _, words in asked]
            counts = [zlib.compress(np.fromiter((own[w] for w in words), np.uint32, len(words)).tobytes())
                      if counted else b"" for _, words in asked]
            number = packs["block"][0].as_py()
            del own
            trim()
            return pa.table({"bucket": pa.array([i for i, _ in asked], pa.int32()), "block": pa.array([number] * len(asked), pa.int32()),
                             "words": pa.array(packed, pa.binary()), "counts": pa.array(counts, pa.binary())})

        def answer(table: pa.Table) -> pa.Table:
            asked = [zlib.decompress(w).split(b" ") for w in table["words"].to_pylist()]
            total: dict[bytes, int] = {}
            for words, counts in zip(asked, table["counts"].to_pylist()):
                if counted:
                    for word, count in zip(words, np.frombuffer(zlib.decompress(counts), np.uint32).tolist()):
                        total[word] = total.get(word, 0) + count
                else:
                    total.update(dict.fromkeys(words, 0))
            distinct, counts = list(total), list(total.values())
            values = dict(zip(distinct, value_of(distinct, counts)))
            blocks, packed = table["block"].to_pylist(), [pack_values([values[w] for w in words]) for words in asked]
            if summary:
                blocks.append(-1)
                packed.append(summary(distinct, counts))
            return pa.table({"block": pa.array(blocks, pa.int32()), "bucket": pa.array(
                [table["bucket"][0].as_py()] * len(blocks), pa.int32()), "values": pa.array(packed, pa.binary())})

        asks = self.blocks.groupBy("block").applyInArrow(ask, "bucket int, block int, words binary, counts binary")
        return asks.groupBy("bucket").applyInArrow(answer, "block int, bucket int, values binary")

    def join(self, answers: DataFrame, use: Callable[..., list[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
        """Call ``use`` on the rows of each block with the values of its words, as a dictionary.

        Where blocks are ``numbered`` it gets besides all words of the block's texts, as numbers of the dictionary's entries, and
        how many of them each text has.
        """
        n, text, lower, numbered, words_of = self.n, self.text, self.lower, self.numbered, self.words_of()

        def finish(packs: pa.Table, known_values: pa.Table) -> pa.Table:
            packed = packs["rows"].to_pylist() if packs.num_rows else []
            known: set[bytes] = set()
            values: dict[bytes, bytes] = {}
            more: tuple[np.ndarray, ...] = ()
            if numbered:
                words, sizes = split_words([unpack_rows(one).column(text) for one in packed], lower)
                distinct, numbers = distinct_words(words)
                # Entries stand by number, whichever packet holds their values.
                values, more = dict.fromkeys(distinct, b""), (numbers, sizes)
                lists = dealt_words(distinct, n)
                del words, distinct, numbers
            else:
                for one in packed:
                    for value in byte_values(unpack_rows(one).column(text)):
                        known.update(words_of(value))
                lists = dealt_words(known, n)
            del known
            for bucket, one in zip(known_values["bucket"].to_pylist(), known_values["values"].to_pylist()):
                values.update(zip(lists[bucket], unpack_values(one)))
            del lists
            made = use(values, map(unpack_rows, packed), *more) if packed else []
            del values, more
            trim()
            return pa.Table.from_batches(made) if made else to_arrow_schema(schema).empty_table()

        return self.blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, schema)
