"""Removal of long repeated passages, byte by byte and exact, with a run-length index.

A byte goes if it lies in a passage of ``length`` bytes that also starts earlier.
Windows of that length are brought together by content: of all short grams in a
window the one of smallest hash, the first if several, names it; neighbouring
windows that one gram names make a run. Equal windows have one name, so all that
can match meet in one task, and no two windows of a run are equal.

1. Tasks name the runs of their texts. Runs of equal content count once in a
   task; later ones are repeats for certain.
2. By name, runs of equal content of all tasks count once too. A name with one
   content is done. Those with several have windows that may or may not agree;
   the first run of each content is asked for.
3. Their bytes meet by name again in an index: the suffixes in order, the
   Burrows-Wheeler transform cut into runs, and the text position of each run's
   head. The match with the suffix before is compared in the text at heads only
   and streamed on through the text from head to head, one byte less for each
   step. Suffixes whose matches are long enough make classes; all windows of a
   class but the first are repeats.
4. Spans go back to their texts.

The runs of a name with very many contents, as beside a line that many documents
share, are taken apart into single windows. Each is named by all its bytes and
goes through step 2 once more, so no task holds the runs of all those documents,
and what they share is counted once in each task.

Documents are ordered by id, null ids first, and by text where rows share an
id. Rows that agree in both are one document: each is treated as the first.
Null and short texts keep all they have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakeweave.llm.common import byte_values, named, pieces, sliced, stored, trim, utf8
from lakeweave.llm.shingles import P, mix
from lakeweave.llm.wordblocks import pack_rows, unpack_rows

GRAM = 24
#: A byte that UTF-8 does not use.
SEPARATOR = b"\xff"
NO_ID = -(1 << 63)
#: Bytes of text whose windows are named at a time; a longer text is named in pieces that overlap by a window.
SLICE = 1 << 19
#: So many runs are told apart at once in a task; those of more text meet in the next step only.
HELD_RUNS = 120_000
#: Bytes of runs that one index holds; names are dealt out to as many as it takes.
INDEXED = 1 << 20
INVERSE = np.uint64(pow(int(P), -1, 1 << 64))
BYTES = np.random.default_rng(2).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OTHER_BYTES = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LAST = np.uint64((1 << 64) - 1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """The first powers of the multiplier and of its inverse."""
    if len(_powers[0]) < n:
        for i, base in enumerate((P, INVERSE)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _powers[i] = np.cumprod(factors)
    return _powers


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Runs of windows of one name: first window, windows, name, and a hash of the bytes."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    up, down = [p[:n] for p in powers(n)]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTES[data] * up, dtype=np.uint64)])
    grams = mix((total[gram:] - total[:-gram]) * down[:n - gram + 1])
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
    grams[left[:len(grams)] < gram] = LAST
    names = smallest(grams, length - gram + 1)
    valid = left[:len(names)] >= length
    same = np.zeros(len(names) + 1, bool)
    # The gram that names a window leaves where it is the first of the window.
    same[1:-1] = valid[1:] & valid[:-1] & (names[1:] == names[:-1]) & (grams[:len(names) - 1] != names[:-1])
    starts = np.flatnonzero(valid & ~same[:-1])
    counts = np.flatnonzero(valid & ~same[1:]) - starts + 1
    content = mix((total[starts + counts - 1 + length] - total[starts]) * down[starts] + counts.astype(np.uint64))
    return starts, counts, names[starts], content


def second_hash(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Another hash of the windows that begin at ``starts``, so that name and content are 128 bits together."""
    up, down = [p[:len(data)] for p in powers(len(data))]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(OTHER_BYTES[data] * up, dtype=np.uint64)])
    return mix((total[starts + length] - total[starts]) * down[starts])


def firsts(columns: list[np.ndarray], key: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows sorted by all columns, and whether each is the first that has its first ``key`` values.

    Rows that repeat an id and a text repeat their runs, which are no copies of each other.
    """
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    other = np.ones(len(order), bool)
    new = np.ones(len(order), bool)
    if len(order):
        other[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns[:key]], axis=0)
    return [c[other] for c in columns], new[other]


def packets(keys: np.ndarray, columns: dict[str, np.ndarray | pa.Array], kind: int) -> pa.RecordBatch:
    """One packed row for each key."""
    order = np.argsort(keys, kind="stable")
    starts = np.flatnonzero(np.diff(keys[order], prepend=-1))
    batch = pa.RecordBatch.from_pydict({n: c if isinstance(c, pa.Array) else pa.array(c) for n, c in columns.items()})
    packed = [pack_rows(batch.take(pa.array(own))) for own in np.split(order, starts[1:])] if len(order) else []
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(packed), kind), pa.int32()), pa.array(keys[order[starts]], pa.int32()),
                                       pa.array(packed, pa.binary())], ["kind", "number", "rows"])


def unpacked(packed: list[bytes]) -> pa.Table:
    return pa.Table.from_batches([unpack_rows(p) for p in packed])


def spans(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, end: np.ndarray) -> dict[str, np.ndarray]:
    """Spans of the documents, overlapping and touching ones joined."""
    order = np.lexsort((start, tie, doc))
    doc, tie, start, end = doc[order], tie[order], start[order], end[order]
    if not len(doc):
        return {"doc": doc, "tie": tie, "start": start, "end": end}
    other = np.ones(len(doc), bool)
    other[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])
    # Each document's ends are lifted above those of the one before, so that one running maximum serves all.
    lift = np.cumsum(other) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift) - lift
    new = other.copy()
    new[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return {"doc": doc[first], "tie": tie[first], "start": start[first], "end": np.append(reach[first[1:] - 1], reach[-1])}


def places(n: int) -> np.dtype:
    """The smaller of the integers that number the bytes of a text."""
    return np.dtype(np.int32 if n < 1 << 30 else np.int64)


def index_parts(size: int) -> int:
    """How many indexes it takes for so many bytes of runs, none of more than ``INDEXED`` where they are dealt evenly."""
    return max(1, -(-size // INDEXED))


class RunIndex:
    """Suffixes of a text in order, the run-compressed transform, and the text positions of the run heads."""

    def __init__(self, text: np.ndarray):
        self.text, n = text, len(text)
        kind = places(n)
        padded = np.concatenate([text, np.zeros(16, np.uint8)])
        eight = np.zeros(n, np.uint64)
        for i in range(8):
            eight <<= np.uint64(8)
            eight |= padded[i:i + n]
        order = np.argsort(eight, kind="stable").astype(kind)
        new = np.ones(n, bool)
        eight = eight[order]
        new[1:] = eight[1:] != eight[:-1]
        del eight, padded
        rank = np.empty(n, kind)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=kind), kind.type(0)))
        depth = 8
        # Prefixes double; only suffixes that still tie are sorted on.
        open_ = np.flatnonzero(~new | np.append(~new[1:], False)).astype(kind)
        del new
        while len(open_):
            at = order[open_]
            ahead = np.where(at + depth < n, rank[np.minimum(at + depth, n - 1)] + 1, kind.type(0))
            own = np.lexsort((ahead, rank[at]))
            at, ahead = at[own], ahead[own]
            del own
            group = rank[at]
            order[open_] = at
            fresh = np.ones(len(at), bool)
            fresh[1:] = (group[1:] != group[:-1]) | (ahead[1:] != ahead[:-1])
            rank[at] = np.maximum.accumulate(np.where(fresh, open_, 0))
            open_ = open_[~fresh | np.append(~fresh[1:], False)]
            depth *= 2
        self.order = order
        before = np.where(order > 0, text[order - 1], np.int16(256))
        self.heads = np.flatnonzero(np.diff(before, prepend=np.int16(-1))).astype(kind)
        # A suffix that begins the text has no byte before it, so its neighbours head runs of their own.

    def matches(self) -> np.ndarray:
        """Length of the match of each text position with the suffix before it in order, streamed from the heads."""
        n, order = len(self.text), self.order
        kind = places(n)
        padded = np.concatenate([self.text, np.zeros(16, np.uint8)])
        heads = self.heads[self.heads > 0]
        x, y = order[heads], order[heads - 1]
        size = np.zeros(len(heads), kind)
        open_ = np.arange(len(heads), dtype=kind)
        del heads
        while len(open_):
            a, b = x[open_] + size[open_], y[open_] + size[open_]
            inside = (a < n) & (b < n)
            open_, a, b = open_[inside], a[inside], b[inside]
            agree = np.ones(len(open_), bool)
            grown = np.zeros(len(open_), np.int8)
            for i in range(8):
                agree &= (padded[a + i] == padded[b + i]) & (a + i < n) & (b + i < n)
                grown += agree
            size[open_] += grown
            open_ = open_[agree]
        reach = np.zeros(n, kind)
        reach[x] = size + x
        reach[order[0]] = order[0]
        np.maximum.accumulate(reach, out=reach)
        reach -= np.arange(n, dtype=kind)
        return np.maximum(reach, 0, out=reach)

    def repeated(self, valid: np.ndarray, length: int) -> np.ndarray:
        """Valid positions at which ``length`` bytes begin that also begin at an earlier valid position."""
        match = self.matches()[self.order]
        first = np.flatnonzero(match < length)
        first = first if len(first) and first[0] == 0 else np.concatenate([[0], first])
        del match
        at = np.where(valid[self.order], self.order, places(len(self.text)).type(len(self.text)))
        least = np.repeat(np.minimum.reduceat(at, first), np.diff(np.append(first, len(at))))
        out = np.zeros(len(self.text), bool)
        out[self.order] = valid[self.order] & (self.order != least)
        return out


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 100, most_contents: int = 2048,
           keep: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """``doc_id``, the columns of ``keep``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` of every row.

    ``kept`` is bytes, or with ``as_text`` a string without the parts of
    characters that a cut has left. The rows of ``docs`` need no order.
    The windows of a name with more than ``most_contents`` contents are told apart singly.
    """
    gram = min(GRAM, length)
    base = docs.select(F.coalesce(named(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"), named(text).alias("text"),
                       *[named(c).alias(f"c{i}") for i, c in enumerate(keep)])
    n = pieces(base, "text", 8 << 20)
    # 32 bits of a hash of the text stand for the text among rows that share an id; they also say the block.
    base = base.withColumn("tie", F.xxhash64("doc", "text").bitwiseAND(0xFFFFFFFF))

    def block_of(tie: np.ndarray) -> np.ndarray:
        return tie % n

    def once(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Runs of equal content count once; the later ones are spans to strike."""
        columns, new = firsts(columns, 2)
        names, content, doc, tie, start, count = columns
        yield packets((names % np.uint64(n)).astype(np.int64)[new], {
            k: c[new] for k, c in zip(("name", "content", "doc", "tie", "start", "count"), columns)}, 0)
        own = spans(doc[~new], tie[~new], start[~new], (start + count - 1 + length)[~new])
        yield packets(block_of(own["tie"]), own, 1)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                columns = [np.concatenate(c) for c in zip(*held)]
                held.clear()
                yield from once(columns)
                trim()

        for batch in sliced(batches, "text", SLICE):
            data, offsets = utf8(batch.column("text"))
            doc, tie = batch.column("doc").to_numpy(), batch.column("tie").to_numpy()
            # A batch is one text, or many that are short together.
            for shift in range(0, max(1, len(data)), SLICE) if len(doc) == 1 else [0]:
                part = data[shift:shift + SLICE + length - 1] if len(doc) == 1 else data
                start, count, names, content = runs(part, offsets if len(doc) > 1 else np.array([0, len(part)]), length, gram)
                owner = np.searchsorted(offsets, start, "right") - 1 if len(doc) > 1 else np.zeros(len(start), np.int64)
                held.append([names, content, doc[owner], tie[owner], start - offsets[owner] + shift, count])
                if sum(len(h[0]) for h in held) > HELD_RUNS:
                    yield from flush()
        yield from flush()

    def gather(table: pa.Table) -> pa.Table:
        kind, number = table["kind"][0].as_py(), table["number"][0].as_py()
        rows = unpacked(table["rows"].to_pylist())
        if kind == 1:
            own = spans(*[rows[c].to_numpy() for c in ("doc", "tie", "start", "end")])
            return pa.Table.from_batches([packets(block_of(own["tie"]), own, 1)])
        columns, new = firsts([rows[c].to_numpy() for c in ("name", "content", "doc", "tie", "start", "count")], 2)
        names, content, doc, tie, start, count = columns
        own = spans(doc[~new], tie[~new], start[~new], (start + count - 1 + length)[~new])
        kinds, at, contents = np.unique(names[new], return_inverse=True, return_counts=True)
        several = np.flatnonzero(new)[contents[at] > 1]
        many = contents[at][contents[at] > 1] > most_contents
        asked = {"name": names[several], "doc": doc[several], "tie": tie[several], "start": start[several],
                 "count": count[several], "many": many}
        return pa.Table.from_batches([packets(block_of(own["tie"]), own, 1), packets(block_of(tie[several]), asked, 2)])

    def cut(packs: pa.Table, requests: pa.Table) -> pa.Table:
        made = []
        if requests.num_rows and packs.num_rows:
            asked = unpacked(requests["rows"].to_pylist())
            order = np.lexsort((asked["tie"].to_numpy(), asked["doc"].to_numpy()))
            names, doc, tie, start, count, many = [asked[c].to_numpy()[order] for c in ("name", "doc", "tie", "start", "count", "many")]
            texts = texts_of(packs)
            values, out, apart, size = [], [[], [], [], [], []], [], 0

            def windows() -> Iterator[pa.RecordBatch]:
                data = np.frombuffer(b"".join(piece for _, piece in apart), np.uint8)
                offsets = np.cumsum([0, *[len(piece) for _, piece in apart]])
                at, counts, own_names, _ = runs(data, offsets, length, length)
                owner = np.searchsorted(offsets, at, "right") - 1
                run = np.array([i for i, _ in apart], np.int64)[owner]
                apart.clear()
                yield from once([own_names, second_hash(data, at, length), doc[run], tie[run], start[run] + at - offsets[owner], counts])

            for i, (d, t, s, c, m) in enumerate(zip(doc.tolist(), tie.tolist(), start.tolist(), count.tolist(), many.tolist())):
                piece = texts[d, t][s:s + c - 1 + length]
                if m:
                    apart.append((i, piece))
                    size += len(piece)
                    if size > HELD_RUNS:
                        made.extend(windows())
                        size = 0
                else:
                    for column, value in zip(out, (int(names[i]), d, t, s, c)):
                        column.append(value)
                    values.append(piece)
            if apart:
                made.extend(windows())
            columns = dict(zip(("name", "doc", "tie", "start", "count"),
                               (np.array(c, k) for c, k in zip(out, (np.uint64, *[np.int64] * 4)))))
            made.append(packets((columns["name"] % np.uint64(n)).astype(np.int64), {**columns, "bytes": pa.array(values, pa.binary())}, 3))
        trim()
        return pa.Table.from_batches(made) if made else empty

    def index(table: pa.Table) -> pa.Table:
        rows = unpacked(table["rows"].to_pylist())
        # All runs of a name are in one index.
        parts = index_parts(rows["bytes"].nbytes)
        part = (rows["name"].to_numpy() // np.uint64(n)) % np.uint64(parts)
        made = []
        for own in range(parts):
            made.append(indexed_spans(rows.filter(pa.array(part == own)) if parts > 1 else rows))
            trim()
        found = spans(*[np.concatenate([m[c] for m in made]) for c in ("doc", "tie", "start", "end")])
        return pa.Table.from_batches([packets(block_of(found["tie"]), found, 1)])

    def indexed_spans(rows: pa.Table) -> dict[str, np.ndarray]:
        doc, tie, start, count = [rows[c].to_numpy() for c in ("doc", "tie", "start", "count")]
        if not len(doc):
            return spans(doc, tie, start, start)
        order = np.lexsort((start, tie, doc))
        doc, tie, start, count = doc[order], tie[order], start[order], count[order]
        values = rows["bytes"].take(pa.array(order)).to_pylist()
        sizes = np.array([len(v) + 1 for v in values])
        joined = np.frombuffer(b"".join([v + SEPARATOR for v in values]), np.uint8)
        del values
        kind = places(len(joined))
        owner = np.repeat(np.arange(len(sizes), dtype=kind), sizes)
        place = np.arange(len(joined), dtype=kind) - np.repeat((np.cumsum(sizes) - sizes).astype(kind), sizes)
        again = np.flatnonzero(RunIndex(joined).repeated(place < count[owner], length))
        own = owner[again]
        at = start[own] + place[again]
        return spans(doc[own], tie[own], at, at + length)

    def texts_of(packs: pa.Table) -> dict[tuple[int, int], bytes]:
        out = {}
        for packed in packs["rows"].to_pylist():
            rows = unpack_rows(packed)
            out.update(zip(zip(rows.column("doc").to_pylist(), rows.column("tie").to_pylist()), byte_values(rows.column("text"))))
        return out

    names = [f"c{i}" for i in range(len(keep))]
    schema = T.StructType([T.StructField("doc", T.LongType()), *[T.StructField(c, docs.schema[k].dataType) for c, k in zip(names, keep)],
                           *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
                           T.StructField("kept", T.StringType() if as_text else T.BinaryType())])

    def strike(packs: pa.Table, struck: pa.Table) -> pa.Table:
        spots: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        if struck.num_rows:
            rows = unpacked(struck["rows"].to_pylist())
            own = spans(*[rows[c].to_numpy() for c in ("doc", "tie", "start", "end")])
            new = np.flatnonzero(np.append(True, (np.diff(own["doc"]) != 0) | (np.diff(own["tie"]) != 0)))
            for a, b in zip(new.tolist(), [*new[1:].tolist(), len(own["doc"])]):
                spots[int(own["doc"][a]), int(own["tie"][a])] = own["start"][a:b], own["end"][a:b]
        made = []
        for packed in packs["rows"].to_pylist() if packs.num_rows else []:
            rows = unpack_rows(packed)
            kept, removed, counts, sizes = [], [], [], []
            for d, t, value in zip(rows.column("doc").to_pylist(), rows.column("tie").to_pylist(), byte_values(rows.column("text"))):
                first, end = spots.get((d, t), ((), ()))
                parts, at = [], 0
                for a, b in zip(first, end):
                    parts.append(value[at:a])
                    at = b
                parts.append(value[at:])
                rest = b"".join(parts)
                kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
                sizes.append(len(value))
                removed.append(len(value) - len(rest))
                counts.append(len(first))
            made.append(pa.RecordBatch.from_arrays(
                [rows.column("doc"), *[rows.column(c) for c in names], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(counts, pa.int64()), pa.array(kept, pa.string() if as_text else pa.binary())],
                ["doc", *names, "n_bytes", "n_removed", "n_spans", "kept"]))
        trim()
        return pa.Table.from_batches(made) if made else to_arrow_schema(schema).empty_table()

    packed = "kind int, number int, rows binary"
    empty = pa.schema([("kind", pa.int32()), ("number", pa.int32()), ("rows", pa.binary())]).empty_table()
    named_runs = base.select("doc", "tie", "text").mapInArrow(name, packed)
    found = stored(named_runs.groupBy("kind", "number").applyInArrow(gather, packed), "repeats")

    def blocks(columns: list[str]) -> DataFrame:
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield packets(block_of(batch.column("tie").to_numpy()), {c: batch.column(c) for c in columns}, 4)

        return base.select(columns).mapInArrow(pack, packed).groupBy("number")

    pieces_cut = stored(
        blocks(["doc", "tie", "text"]).cogroup(found.filter("kind = 2").groupBy("number")).applyInArrow(cut, packed), "repeats")
    indexed = stored(pieces_cut.filter("kind = 3").groupBy("number").applyInArrow(index, packed), "repeats")
    # Windows have one content each, so nothing is asked for a second time.
    windows = stored(pieces_cut.filter("kind = 0").groupBy("kind", "number").applyInArrow(gather, packed), "repeats")
    struck = found.filter("kind = 1").unionByName(pieces_cut.filter("kind = 1")).unionByName(indexed).unionByName(windows).groupBy("number")
    done = blocks(["doc", "tie", "text", *names]).cogroup(struck).applyInArrow(strike, schema)
    return done.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias(doc_id), *[F.col(c).alias(k) for c, k in zip(names, keep)],
                       "n_bytes", "n_removed", "n_spans", "kept")
