"""Language-model scores from a gated recurrent network.

The network reads a text word by word and gives the probability of the next
word in two steps: of its class, and of the word within the class. Frequent
words share classes of like frequency and are chosen within them by a softmax
over the same state; all other words fall into classes by their ending, within
which their share is that of the counts over the whole corpus.

Every learning document adds to the counts. The network learns from all words
of every learning document in each round, in windows of a few words through
which errors are sent back (truncated backpropagation); tasks learn apart from
the same weights and their weights are averaged, for a few rounds. Scores carry
the state across the windows of a text from its first word to its end.

Null texts are empty and consist of the end alone. Equal texts get equal
scores. Without any learning document the counts are zero and scores come from
the untrained network.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.llm.common import keep_memory, named, one_thread, stored, trim
from lakeweave.llm.wordblocks import WordBlocks, distinct_words, split_words

END = b" "
FREQUENT, FREQUENT_CLASSES, ENDING_CLASSES = 2000, 40, 32
EMBEDDING, STATE = 16, 24
LN10 = float(np.log(10))
#: A task learns from so many words at a time.
HELD_WORDS = 1 << 20


def own_weights(distinct: int) -> int:
    """How many of so many distinct words have weights of their own."""
    return max(FREQUENT, 8 * math.isqrt(distinct))


def ending_class(word: bytes) -> int:
    return zlib.crc32(word.strip(b".,;:!?\"'()")[-3:]) % ENDING_CLASSES


class Lexicon:
    """Frequent words with their classes, and the count mass of each ending class."""

    def __init__(self, words: list[tuple[bytes, int]], ending_mass: np.ndarray):
        words = [(END, dict(words).get(END, 0)), *[(w, c) for w, c in words if w != END]]
        self.number = {w: i for i, (w, _) in enumerate(words)}
        self.counts = np.array([c for _, c in words], np.float64) + 0.5
        share = np.cumsum(np.sqrt(self.counts)) / np.sqrt(self.counts).sum()
        # As many classes as the root of the words: neither choice, of class or word, grows faster than that.
        self.frequent_classes = max(FREQUENT_CLASSES, math.isqrt(len(words)))
        self.word_class = np.minimum((share * self.frequent_classes * 0.999999).astype(np.int64), self.frequent_classes - 1)
        #: The members of class c are the words from ``firsts[c]`` to before ``firsts[c + 1]``.
        self.firsts = np.searchsorted(self.word_class, np.arange(self.frequent_classes + 1)).tolist()
        self.class_of = np.concatenate([self.word_class, self.frequent_classes + np.arange(ENDING_CLASSES)]).astype(
            np.int16 if self.frequent_classes < 1 << 14 else np.int64)
        self.ending_mass = ending_mass
        self.class_mass = np.concatenate([[self.counts[a:b].sum() for a, b in zip(self.firsts, self.firsts[1:])], ending_mass])

    def codes(self, words: list[bytes]) -> np.ndarray:
        """The number of a frequent word; of the ending class, above those, for others."""
        top = len(self.counts)
        return np.array([self.number[w] if w in self.number else top + ending_class(w) for w in words], np.int64)


def runs_of(lexicon: Lexicon, column: pa.Array) -> Iterator[np.ndarray]:
    """The numbers of the words of each text, in lower case, between two ends; each distinct word is looked up once."""
    words, sizes = split_words([column], lower=True)
    distinct, numbers = distinct_words(words)
    codes = lexicon.codes(distinct).astype(np.int32)[numbers]
    for start, end in zip((np.cumsum(sizes) - sizes).tolist(), np.cumsum(sizes).tolist()):
        run = np.full(end - start + 2, lexicon.number[END], np.int32)
        run[1:-1] = codes[start:end]
        yield run


def layer(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Weights of one output a row with the bias behind them, shifted so that scores lie around zero."""
    out = np.empty((len(weights), weights.shape[1] + 1), weights.dtype)
    out[:, :-1] = weights
    out[:, -1] = bias - (bias.min() + bias.max()) / 2
    return out


def in_range(sums: np.ndarray) -> bool:
    """Whether sums of exponentials neither overflowed nor came near to vanishing in 32 bits."""
    return not len(sums) or bool(sums.min() > 1e-30 and sums.max() < 1e30)


class ByClass:
    """States of words, one a row, in the order of their targets' classes, and the choices they lead to.

    A class is then a piece of the rows, and its members, numbered by frequency, one of the weights. Frequent
    targets come first. Exponentials and their sums are kept apart: rows are divided, not the many shares of each.
    """

    #: So many rows at a time have the scores of all classes, which then stay in the processor's cache.
    ROWS = 1024

    def __init__(self, network: Network, states: np.ndarray, targets: np.ndarray):
        lexicon, w = network.lexicon, network.weights
        classes = lexicon.class_of[targets]
        self.order = np.argsort(classes, kind="stable")
        self.classes, self.targets = classes[self.order], targets[self.order]
        self.states = np.ones((len(states), states.shape[1] + 1), states.dtype)
        self.states[:, :-1] = np.take(states, self.order, axis=0)
        self.to_class, self.to_word = layer(w["to_class"].T, w["class_bias"]), layer(w["to_word"], w["word_bias"])
        ends = np.searchsorted(self.classes, np.arange(lexicon.frequent_classes), "right")
        starts = np.concatenate([[0], ends[:-1]])
        self.frequent = int(ends[-1])
        firsts = np.array(lexicon.firsts)
        members, counts = np.diff(firsts), ends - starts
        offsets = np.concatenate([[0], np.cumsum(members * counts)])
        #: Of each class with targets: its rows, its members, and where its scores stand.
        self.pieces = [(slice(a, b), slice(c, d), slice(e, f), (b - a, d - c)) for a, b, c, d, e, f in zip(
            starts.tolist(), ends.tolist(), lexicon.firsts, lexicon.firsts[1:], offsets.tolist(), offsets[1:].tolist()) if b > a]
        own = self.classes[:self.frequent]
        self.begins = offsets[own] + members[own] * (np.arange(self.frequent) - starts[own])
        self.places = self.begins + self.targets[:self.frequent] - firsts[own]
        self.size = int(offsets[-1])

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For frequent targets: exponentials of the scores of their classes' members, class by class, their sums, and the targets' scores.

        Only where exponentials leave the range of 32 bits are the scores lessened by their greatest first, here and
        in ``of_classes``.
        """
        out = np.empty(self.size, self.to_word.dtype)
        for shifted in (False, True):
            for rows, members, scores, shape in self.pieces:
                np.matmul(self.states[rows], self.to_word[members].T, out=out[scores].reshape(shape))
            if shifted:
                out -= np.repeat(np.maximum.reduceat(out, self.begins), np.diff(self.begins, append=len(out)))
            wanted = out[self.places]
            with np.errstate(over="ignore"):
                np.exp(out, out=out)
                sums = np.add.reduceat(out, self.begins) if len(out) else wanted
            if in_range(sums):
                break
        return out, sums, wanted

    def of_classes(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """For some rows at a time: exponentials of the scores of all classes, their sums, and the targets' scores."""
        ones = np.ones(len(self.to_class), self.to_class.dtype)
        for start in range(0, len(self.states), self.ROWS):
            rows = slice(start, start + self.ROWS)
            for shifted in (False, True):
                out = self.states[rows] @ self.to_class.T
                if shifted:
                    out -= out.max(axis=1, keepdims=True)
                wanted = out[np.arange(len(out)), self.classes[rows]]
                with np.errstate(over="ignore"):
                    np.exp(out, out=out)
                    sums = out @ ones
                if in_range(sums):
                    break
            yield rows, out, sums, wanted

    def logs(self) -> np.ndarray:
        """Natural log probability of each target, of its class alone where it is not frequent, in the order of the rows given."""
        logs = np.empty(len(self.states))
        for rows, _, sums, wanted in self.of_classes():
            logs[rows] = wanted - np.log(sums.astype(np.float64))
        _, sums, wanted = self.words()
        logs[:self.frequent] += wanted - np.log(sums.astype(np.float64))
        out = np.empty_like(logs)
        out[self.order] = logs
        return out

    def errors(self) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the weights, and of the states in the order of the rows given."""
        h = self.states.shape[1] - 1
        to_class, to_word = np.zeros_like(self.to_class), np.zeros_like(self.to_word)
        back = np.empty((len(self.states), h), self.to_class.dtype)
        for rows, out, sums, _ in self.of_classes():
            out[np.arange(len(out)), self.classes[rows]] -= sums
            share = (1 / sums)[:, None]
            to_class += out.T @ (self.states[rows] * share)
            np.multiply(out @ self.to_class[:, :h], share, out=back[rows])
        out, sums, _ = self.words()
        out[self.places] -= sums
        share = (1 / sums)[:, None]
        states, own = self.states[:self.frequent] * share, np.empty((self.frequent, h), self.to_word.dtype)
        for rows, members, scores, shape in self.pieces:
            errors = out[scores].reshape(shape)
            np.matmul(errors.T, states[rows], out=to_word[members])
            np.matmul(errors, self.to_word[members, :h], out=own[rows])
        own *= share
        back[:self.frequent] += own
        unsorted = np.empty_like(back)
        unsorted[self.order] = back
        return {"to_class": to_class[:, :h].T, "class_bias": to_class[:, h], "to_word": to_word[:, :h],
                "word_bias": to_word[:, h]}, unsorted


def descend(weights: np.ndarray, sums: np.ndarray, gradient: np.ndarray, streams: int, rate: float, rows: int = 2048) -> None:
    """A step of AdaGrad in place, by the mean gradient of the streams; some rows at a time stay in the processor's cache."""
    for start in range(0, len(weights), rows):
        part = slice(start, start + rows)
        step = gradient[part] * np.float32(1 / streams)
        square = step * step
        sums[part] += square
        np.sqrt(sums[part], out=square)
        step /= square
        step *= np.float32(rate)
        weights[part] -= step


class Network:
    """Weights and one window of words forward and back."""

    def __init__(self, lexicon: Lexicon, seed: int = 5):
        rng, n = np.random.default_rng(seed), len(lexicon.counts)
        draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        self.lexicon = lexicon
        self.sums: dict[str, np.ndarray] = {}
        self.weights = {
            "embed": (0.3 * rng.normal(size=(n + ENDING_CLASSES, EMBEDDING))).astype(np.float32),
            "into": draw(EMBEDDING, 3 * STATE), "bias": np.zeros(3 * STATE, np.float32),
            "across": draw(STATE, 3 * STATE),
            "to_class": np.zeros((STATE, lexicon.frequent_classes + ENDING_CLASSES), np.float32),
            "class_bias": np.log(lexicon.class_mass + 1e-3).astype(np.float32),
            "to_word": np.zeros((n, STATE), np.float32), "word_bias": np.log(lexicon.counts).astype(np.float32)}

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights.values()])

    def load(self, flat: np.ndarray) -> Network:
        at = 0
        for name, w in self.weights.items():
            self.weights[name] = flat[at:at + w.size].reshape(w.shape).astype(np.float32)
            at += w.size
        return self

    def forward(self, inputs: np.ndarray, state: np.ndarray, fresh: np.ndarray):
        """States after each word of a window (time, stream); ``fresh`` marks words before which the state is cleared."""
        states, after, _ = self.run(inputs, state.T, fresh)
        return states.transpose(1, 2, 0), after.T, None

    def run(self, inputs: np.ndarray, state: np.ndarray, fresh: np.ndarray, keep: bool = False):
        """``forward`` with the streams along the last axis, so that each gate of all streams is one piece of memory."""
        w, h = self.weights, STATE
        # The gates' sign is turned beforehand, as they are 1 / (1 + exp(-x)).
        sign = np.repeat(np.array([-1, 1], np.float32), [2 * h, h])[:, None]
        across = w["across"].T * sign
        given = (w["into"].T * sign) @ np.take(w["embed"], inputs.ravel(), axis=0).T
        given += w["bias"][:, None] * sign
        given = given.reshape(3 * h, *inputs.shape)
        states = np.empty((h, *inputs.shape), np.float32)
        kept = []
        any_fresh = fresh.any(axis=1)
        for t in range(len(inputs)):
            if any_fresh[t]:
                state = np.where(fresh[t], np.float32(0), state)
            moved = across @ state
            gates = moved[:2 * h]
            gates += given[:2 * h, t]
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            new = gates[h:] * moved[2 * h:]
            new += given[2 * h:, t]
            np.tanh(new, out=new)
            if keep:
                kept.append((state, moved[2 * h:], gates, new))
            state = state - new
            state *= gates[:h]
            state += new
            states[:, t] = state
        return states, state, kept

    def log_shares(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log probability of each target; for words outside the frequent ones, of their class."""
        return ByClass(self, states, targets).logs()

    def gradients(self, inputs: np.ndarray, targets: np.ndarray, state: np.ndarray, fresh: np.ndarray):
        """Gradients of all weights, and the states after the window."""
        w, h, time = self.weights, STATE, len(inputs)
        states, after, kept = self.run(inputs, state.T, fresh, keep=True)
        grads, back = ByClass(self, np.ascontiguousarray(states.reshape(h, -1).T), targets.ravel()).errors()
        back = np.ascontiguousarray(back.T).reshape(states.shape)
        moved_back = np.zeros((h, inputs.shape[1]), np.float32)
        given_errors = np.empty((3 * h, *inputs.shape), np.float32)
        grads["across"] = np.zeros_like(w["across"])
        for t in range(time - 1, -1, -1):
            before, moved, gates, new = kept[t]
            error = back[:, t] + moved_back
            update, reset = gates[:h], gates[h:]
            kept_back = error * update
            error -= kept_back
            through = np.empty((3 * h, error.shape[1]), kept_back.dtype)
            np.subtract(before, new, out=through[:h])
            through[:h] *= update
            through[:h] *= error
            d_new = through[2 * h:]
            np.multiply(new, new, out=d_new)
            np.subtract(1, d_new, out=d_new)
            d_new *= error
            given_errors[2 * h:, t] = d_new
            d_new *= reset
            np.subtract(1, reset, out=through[h:2 * h])
            through[h:2 * h] *= moved
            through[h:2 * h] *= d_new
            given_errors[:2 * h, t] = through[:2 * h]
            grads["across"] += before @ through.T
            moved_back = w["across"] @ through
            moved_back += kept_back
            if fresh[t].any():
                moved_back[:, fresh[t]] = 0
        flat_errors = given_errors.reshape(3 * h, -1)
        number = inputs.ravel()
        read = np.ones((len(number), w["embed"].shape[1] + 1), w["embed"].dtype)
        read[:, :-1] = np.take(w["embed"], number, axis=0)
        into = flat_errors @ read
        grads["into"], grads["bias"] = into[:, :-1].T, into[:, -1]
        own = self.read_words(inputs)
        place = np.empty(len(w["embed"]), np.intp)
        place[own] = np.arange(len(own))
        number = place[number]
        grads["embed"] = np.zeros_like(w["embed"])
        grads["embed"][own] = np.stack([np.bincount(number, one, len(own)) for one in (flat_errors.T @ w["into"].T).T], axis=1)
        return grads, after.T

    def read_words(self, inputs: np.ndarray) -> np.ndarray:
        """The distinct numbers of the words that a window reads, in order."""
        met = np.zeros(len(self.weights["embed"]), bool)
        met[inputs] = True
        return np.flatnonzero(met)

    def learn(self, tokens: np.ndarray, fresh: np.ndarray, streams: int = 512, window: int = 20, rate: float = 0.15) -> int:
        """AdaGrad over parallel streams of (input, target) words; ``fresh`` marks the first of each run.

        The words that fill no row of all streams go on where the last stream ends. Sums of squares stay for further calls.
        """
        inputs, targets = tokens[:-1], tokens[1:]
        starts = fresh[:-1]
        usable = ~fresh[1:]  # the word before a run is no input of it
        inputs, targets = inputs[usable], targets[usable]
        starts = starts[usable]
        words = len(inputs)
        length = words // streams
        if length == 0:
            streams, length = 1, words
        if length == 0:
            return 0
        whole = streams * length
        shape = lambda x: x[:whole].reshape(streams, length).T
        parts = [(shape(inputs), shape(targets), shape(starts).copy())]
        parts[0][2][0] = True
        if whole < words:
            parts.append(tuple(x[whole:, None] for x in (inputs, targets, starts)))
        if not self.sums:
            self.sums = {name: np.full_like(w, 1e-2) for name, w in self.weights.items()}
        state = np.zeros((streams, STATE), np.float32)
        for part in parts:
            state = state[-part[0].shape[1]:]
            for t in range(0, len(part[0]), window):
                inputs = part[0][t:t + window]
                grads, state = self.gradients(inputs, part[1][t:t + window], state, part[2][t:t + window])
                for name, g in grads.items():
                    if name == "embed":
                        # Words that the window does not read have no gradient.
                        own = self.read_words(inputs)
                        weights, sums = self.weights[name][own], self.sums[name][own]
                        descend(weights, sums, g[own], streams, rate)
                        self.weights[name][own], self.sums[name][own] = weights, sums
                    else:
                        descend(self.weights[name], self.sums[name], g, streams, rate)
        return words

    def score(self, texts: list[np.ndarray], streams: int = 1024, window: int = 32, rows: int = 1 << 14) -> np.ndarray:
        """Natural log probability of every text's words up to the class for words that are not frequent.

        Texts run side by side, the longest first; each carries its state from window to window.
        The states of about ``rows`` words are turned into probabilities at a time.
        """
        out = np.zeros(len(texts))
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def settle() -> None:
            states, targets, owners = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            out[:] += np.bincount(owners, self.log_shares(states, targets), len(out))

        sizes = np.array([len(t) for t in texts])
        order = np.argsort(-sizes, kind="stable")
        flat = np.concatenate([np.concatenate([[0], texts[i]]) for i in order]) if len(order) else np.zeros(0, np.int64)
        first = np.cumsum(sizes[order] + 1) - (sizes[order] + 1)
        for start in range(0, len(order), streams):
            own = order[start:start + streams]
            at, length = first[start:start + streams], sizes[own]
            state = np.zeros((STATE, len(own)), np.float32)
            for t in range(0, int(length[0]) if len(length) else 0, window):
                alive = int(np.searchsorted(-length, -t, "left"))
                steps = min(window, int(length[0]) - t)
                where = at[None, :alive] + t + np.arange(steps)[:, None]
                inside = t + np.arange(steps)[:, None] < length[None, :alive]
                inputs = np.where(inside, flat[np.minimum(where, len(flat) - 1)], 0)
                states, state, _ = self.run(inputs, state[:, :alive], np.zeros(inputs.shape, bool))
                inner = np.flatnonzero(inside)
                rows_of = np.ascontiguousarray(states.reshape(STATE, -1).T)
                held.append((rows_of if len(inner) == len(rows_of) else np.take(rows_of, inner, axis=0),
                             flat[where.ravel()[inner] + 1], own[inner % alive]))
                if sum(len(h[1]) for h in held) >= rows:
                    settle()
        if held:
            settle()
        return out


# Corpus statistics

SUMMARY = pa.schema([("kind", pa.int8()), ("word", pa.binary()), ("count", pa.int64())])


def summarize(words: list[bytes], counts: list[int]) -> bytes:
    """A packet's totals: its most frequent words, tokens, distinct words, and count mass by ending."""
    known = [(w, c) for w, c in zip(words, counts) if c]
    top = sorted(known, key=lambda x: (-x[1], x[0]))[:own_weights(len(known))]
    endings: dict[int, list[int]] = {}
    for w, c in known:
        own = endings.setdefault(ending_class(w), [0, 0])
        own[0] += c
        own[1] += 1
    rows = [(0, w, c) for w, c in top] + [(1, b"", sum(c for _, c in known)), (2, b"", len(known))]
    for number, (c, n) in endings.items():
        rows += [(3, b"%d" % number, c), (4, b"%d" % number, n)]
    batch = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), SUMMARY)], schema=SUMMARY)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, SUMMARY, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def totals(answers: DataFrame) -> tuple[list[tuple[bytes, int]], int, int, np.ndarray]:
    """Frequent words, tokens, distinct words, and mass by ending class; few rows more come back than the root of the distinct words."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task names its own most frequent words and sums; a word stands in one packet only.
        top: list[tuple[int, bytes]] = []
        sums: Counter = Counter()
        for batch in batches:
            for packed in batch.column("values").to_pylist():
                rows = pa.ipc.open_stream(packed).read_next_batch()
                for kind, word, count in zip(*[c.to_pylist() for c in rows.columns]):
                    if kind:
                        sums[kind, word] += count
                    else:
                        top.append((-count, word))
                top = heapq.nsmallest(own_weights(sums[2, b""]), top)
        rows = [(0, word, -count) for count, word in top] + [(kind, word, count) for (kind, word), count in sums.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), SUMMARY)], schema=SUMMARY)

    rows = answers.filter("block = -1").select("values").mapInArrow(unpack, "kind byte, word binary, count long")
    sums = {(r["kind"], bytes(r["word"])): r["count"] for r in
            rows.filter("kind > 0").groupBy("kind", "word").agg(F.sum("count").alias("count")).collect()}
    most = own_weights(sums.get((2, b""), 0))
    top = [(bytes(r["word"]), r["count"]) for r in rows.filter("kind = 0").orderBy(F.desc("count"), "word").limit(most).collect()]
    mass = np.full(ENDING_CLASSES, 0.5)
    for (kind, word), count in sums.items():
        if kind > 2:
            mass[int(word)] += count * (1 if kind == 3 else 0.5)
    for word, count in top:
        mass[ending_class(word)] -= count + 0.5
    return top, sums.get((1, b""), 0), sums.get((2, b""), 0), mass


def averaged(docs: DataFrame, network: Network, slots: int = 64) -> Network:
    """One round: every task learns from all words of its documents, the weights are averaged by the words they saw."""
    start, lexicon = network.flat(), network.lexicon

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        keep_memory()
        own, runs, seen = Network(lexicon).load(start), [], 0

        def pass_on() -> int:
            fresh = np.zeros(sum(map(len, runs)), bool)
            fresh[np.cumsum([0, *map(len, runs[:-1])])] = True
            tokens = np.concatenate(runs)
            runs.clear()
            return own.learn(tokens, fresh)

        held = 0
        for batch in batches:
            for run in runs_of(lexicon, batch.column("text")):
                runs.append(run)
                held += len(run)
                if held >= HELD_WORDS:
                    seen += pass_on()
                    held = 0
        if runs:
            seen += pass_on()
        if not seen:
            return
        parts = np.array_split(own.flat() * np.float32(seen), slots)
        del own
        trim()
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(slots), pa.int32()), pa.array([seen] * slots, pa.int64()),
             pa.array([p.astype("<f4").tobytes() for p in parts], pa.binary())], ["slot", "seen", "weights"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p, "<f4").astype(np.float64) for p in table["weights"].to_pylist())
        seen = sum(table["seen"].to_pylist())
        return pa.table({"slot": table["slot"].slice(0, 1), "weights": pa.array(
            [(total / max(seen, 1)).astype("<f4").tobytes()], pa.binary())})

    made = docs.mapInArrow(learn, "slot int, seen long, weights binary").filter("seen > 0").groupBy("slot").applyInArrow(
        add, "slot int, weights binary").orderBy("slot").collect()
    return network.load(np.concatenate([np.frombuffer(r["weights"], "<f4") for r in made])) if made else network


def score(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", rounds: int = 2,
          block_bytes: int = 24 << 20) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10) of every text.

    Rows that fulfil ``learn`` teach: all their words pass through the network
    in each round. A block of texts is scored at once: larger ones keep more
    texts side by side.
    """
    rows = docs.select(named(doc_id).alias("id"), learn.alias("learn"), named(text).alias("text"))
    blocks = WordBlocks(rows, "text", lower=True, block_bytes=block_bytes, numbered=True)
    ends = rows.filter("learn").count()
    answers = stored(blocks.answers(
        lambda words, counts: [np.uint64(c).tobytes() for c in counts], counted="learn", summary=summarize), "counts")
    top, tokens, distinct, mass = totals(answers)
    n, v = tokens + ends, distinct + (1 if ends else 0)
    lexicon = Lexicon([(END, ends), *top], np.maximum(mass, 0.5))
    network = Network(lexicon)
    for _ in range(rounds):
        network = averaged(rows.filter("learn").select("text"), network)
    weights = network.flat()
    fixed = float(np.log10(n + 0.5 * (v + 1)))
    end_log, end_known = float(np.log10(ends + 0.5)), int(ends > 0)

    def use(values: dict[bytes, bytes], parts: Iterator[pa.RecordBatch], numbers: np.ndarray, sizes: np.ndarray) -> list[pa.RecordBatch]:
        one_thread()
        keep_memory()
        own = Network(lexicon).load(weights)
        counts = np.frombuffer(b"".join(values.values()), np.uint64).astype(np.float64)
        codes = lexicon.codes(list(values))
        base = np.log10(counts + 0.5)
        rare = codes >= len(lexicon.counts)
        within = np.zeros(len(codes))
        within[rare] = np.log((counts[rare] + 0.5) / lexicon.ending_mass[codes[rare] - len(lexicon.counts)])
        batches = list(parts)
        owners = np.repeat(np.arange(len(sizes)), sizes)
        summed = lambda of: np.bincount(owners, of[numbers], len(sizes))
        ends = np.cumsum(sizes)
        coded = codes[numbers]
        texts = [np.concatenate([coded[a:b], [0]]) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
        full = (own.score(texts) + summed(within)) / LN10
        plain = summed(base) + end_log - (sizes + 1) * fixed
        return [pa.RecordBatch.from_arrays([
            pa.concat_arrays([b.column("id") for b in batches]), pa.concat_arrays([b.column("learn") for b in batches]),
            pa.array(sizes + 1, pa.int64()),
            pa.array(summed(counts > 0).astype(np.int64) + end_known, pa.int64()),
            pa.array(plain, pa.float64()), pa.array(full, pa.float64())],
            ["id", "learn", "n_tokens", "n_known", "base_score", "score"])]

    schema = T.StructType([rows.schema["id"], rows.schema["learn"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()),
                           T.StructField("score", T.DoubleType())])
    made = blocks.join(answers.filter("block >= 0"), use, schema)
    return made.select(F.col("id").alias(doc_id), (~F.col("learn")).alias("held_out"), "n_tokens", "n_known",
                       F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
