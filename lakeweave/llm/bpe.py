"""BPE encoding and decoding through a table of distinct words.

``encode`` splits the texts into words, encodes every distinct word of the
corpus once, and joins the ids back by the position of the word in its text.
``decode`` joins ids with the pieces of the vocabulary. Both give what the
tokenizers library gives for the whole text with ``add_special_tokens=False``
and ``skip_special_tokens=False``.

That words can be encoded apart rests on the tokenizer: its normalizer and its
pre-tokenizer never join characters across white space. ``Words`` refuses files
of any other kind.

Null and empty texts have no ids and decode to the empty text. Repeated rows
are encoded each; equal rows give equal results. Other columns are not read.
"""

from __future__ import annotations

import functools
import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.llm.common import byte_values, named, sliced, with_columns
from lakeweave.llm.wordblocks import WordBlocks

#: Words and their ids, about 200 bytes each, that a worker process keeps.
MOST_PIECES = 400_000
#: The normalizers and the pattern of the tokenizer file that ``Words`` knows.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in table:
            table[b] = chr(0x100 + len(table) - len(plain))
    return table


class Words:
    """Encodes single words; words and pieces of words are looked up again within a call of ``encode``.

    With ``remember`` about ``MOST_PIECES`` of them are kept from call to call, then anew.

    Words of Latin letters and ASCII marks are cut by the file's own pattern (letters
    with marks behind them need no search) and only their pieces go to the library's
    model. All others, and words that may hold a special token, go through the whole library.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        pre = described.get("pre_tokenizer") or {}
        first, *others = pre.get("pretokenizers") or [{}]
        normal = [n.get("type") for n in (described.get("normalizer") or {}).get("normalizers") or []]
        if (normal != NORMALIZERS or [(o.get("type"), o.get("use_regex"), o.get("add_prefix_space")) for o in others] != [("ByteLevel", False, False)]
                or described.get("post_processor") or described.get("decoder") or first.get("behavior") != "Removed"
                or not first.get("invert") or first.get("pattern") != {"Regex": SPLIT}):
            raise ValueError(f"{path}: not a tokenizer whose words can be encoded apart")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.pattern = regex.compile(SPLIT)
        special = "".join(sorted({regex.escape(t["content"][0]) for t in described.get("added_tokens", [])}))
        self.simple = regex.compile(rf"(?V1)[[!-~¡-ɏ]--[{special}]]+" if special else r"[!-~¡-ɏ]+")
        self.marks = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c not in special)
        self.known: dict[str, bytes] = {}
        self.letters = byte_letters()
        size = max(self.library.get_vocab().values()) + 1
        self.width = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.letters = [self.letters[b] for b in range(256)]

    def encode(self, words: list[bytes], remember: bool = False) -> list[bytes]:
        """Packed ids (``width`` each) of each word."""
        if not remember or len(self.known) > MOST_PIECES:
            self.known = {}
        known = self.known if remember else {}
        model, width, letters, code = self.library.model, self.width, self.letters, self.width.char
        found, rest = [b""] * len(words), []
        for i, raw in enumerate(words):
            word = raw.decode("utf-8", "replace")
            # A remembered piece is what it is as a word, too.
            lowered = word.lower()
            packed = known.get(lowered)
            if packed is None:
                stem = lowered.rstrip(self.marks)
                plain = stem.isalpha()
                if not (plain and raw.isascii()) and not self.simple.fullmatch(word):
                    rest.append((i, word))
                    continue
                ids = []
                # The pattern keeps letters together, and the marks behind them, which no letters follow.
                if not plain:
                    pieces = self.pattern.findall(lowered)
                else:
                    pieces = [stem] if len(stem) == len(lowered) else [stem, lowered[len(stem):]]
                for piece in pieces:
                    own = known.get(piece)
                    if own is None:
                        text = piece if piece.isascii() else "".join([letters[b] for b in piece.encode()])
                        own = known[piece] = array(code, [t.id for t in model.tokenize(text)]).tobytes()
                    ids.append(own)
                packed = known[lowered] = b"".join(ids)
            found[i] = packed
        for start in range(0, len(rest), 4096):
            part = rest[start:start + 4096]
            encoded = self.library.encode_batch([word for _, word in part], add_special_tokens=False)
            for (i, _), one in zip(part, encoded):
                found[i] = np.array(one.ids, width).tobytes()
        return found


@functools.lru_cache(maxsize=2)
def words_of_file(path: str) -> Words:
    """One encoder for each worker process, which outlives its tasks."""
    return Words(path)


def pieces_of_file(path: str) -> list[str | None]:
    """The vocabulary by id, as large as the file says."""
    library = words_of_file(path).library
    return [library.id_to_token(i) for i in range(max(library.get_vocab().values()) + 1)]


def widened(packed: bytes, width: np.dtype) -> bytes:
    """Ids of any width as little-endian unsigned 32-bit integers."""
    return packed if width.itemsize == 4 else np.frombuffer(packed, width).astype("<u4").tobytes()


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns of ``keep``, and ``ids``: packed little-endian unsigned 32-bit integers."""
    names = [doc_id, *keep]
    inner = docs.select(*[named(c).alias(f"c{i}") for i, c in enumerate(names)], named(text).alias("text"))
    kinds = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(names)]

    width = words_of_file(path).width

    def value_of(words: list[bytes], counts: list[int]) -> list[bytes]:
        return words_of_file(path).encode(words)

    def use(values: dict[bytes, bytes], parts: Iterator[pa.RecordBatch]) -> list[pa.RecordBatch]:
        get, made = values.__getitem__, []
        for rows in parts:
            ids = [widened(b"".join(map(get, value.split())), width) for value in byte_values(rows.column("text"))]
            made.append(pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(ids, pa.binary())],
                                                   [*rows.schema.names[:-1], "ids"]))
        return made

    schema = T.StructType([*kinds, T.StructField("ids", T.BinaryType())])
    blocks = WordBlocks(inner, "text")
    done = blocks.join(blocks.answers(value_of), use, schema)
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "ids")


def decode(encoded: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the text of packed ids: a join with the vocabulary, whose size is that of the file.

    Null ids give a null text; an id that the vocabulary lacks gives nothing, as in the library.
    """
    pieces = pieces_of_file(path)
    column = f"c{encoded.columns.index(ids)}"

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        for batch in sliced(batches, column, 1 << 20):
            texts = []
            for packed in batch.column(column).to_pylist():
                own = None if packed is None else [
                    pieces[i] for i in np.frombuffer(packed, "<u4").tolist() if i < len(pieces)]
                texts.append(None if own is None else " ".join([p for p in own if p is not None]))
            yield batch, [pa.array(texts, pa.string())]

    return with_columns(encoded, join, T.StructType([T.StructField(decoded, T.StringType())]))
