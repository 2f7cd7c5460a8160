"""Language identification with a linear-chain conditional random field over words.

Each word has features: byte n-grams, affixes, and its place in a lexicon of
frequent training words. Their weights and those of the transitions between the
languages of neighbouring words are learned together by maximum conditional
likelihood. Training sequences change the language now and then, so the model
labels the words of code-switched text. Forward-backward over all words of a
text gives each word's distribution; their sum gives the language of the text.

The fit takes at most ``most_docs`` labelled documents (an equal number of each
language, by hash) to the driver; everything else runs on every whole text.

Null texts and texts without a letter get ``und`` and a score of 0. Rows
without a language are labelled like others but teach nothing; without any
labelled row every text gets ``und``. Equal texts get equal answers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.llm.common import byte_values, named, sliced, trim, with_columns

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
GRAMS = (2, 3, 4)
AFFIXES = (1, 2, 3)
MARKS = b".,;:!?\"'()[]{}|-_*#/\\"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: So many words that a task has not met before are looked at together, as their features take far more room than what is kept.
FRESH_WORDS = 1 << 13


def hashed(parts: np.ndarray, salt: int, bits: int) -> np.ndarray:
    x = (parts + np.uint64(salt + 1)) * MULTIPLIER
    return ((x ^ (x >> np.uint64(29))) * MULTIPLIER >> np.uint64(64 - bits)).astype(np.int64)


class Features:
    """Features of many words at once: arrays of feature numbers, each with the ends of the words' runs."""

    def __init__(self, words: list[bytes], bits: int):
        cleaned = [word.lower().strip(MARKS) for word in words]
        sizes = np.fromiter(map(len, cleaned), np.int64, len(words))
        data = np.frombuffer(b"".join([b"\1" + w + b"\2" for w in cleaned]), np.uint8).astype(np.uint64)
        starts = np.cumsum(sizes + 2) - (sizes + 2)
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        place = np.arange(len(data)) - np.repeat(starts, sizes + 2)
        room = np.repeat(sizes + 2, sizes + 2)
        grams = data
        for n in range(2, max(GRAMS) + 1):
            grams = (grams[:-1] << np.uint64(8)) | data[n - 1:] if len(data) >= n else grams[:0]
            if n in GRAMS:
                inside = (place + n <= room)[:len(grams)]
                count = np.maximum(sizes + 3 - n, 0)
                self.runs.append((hashed(grams[inside], n, bits), np.cumsum(count)))
        for n in AFFIXES:
            for salt, at in ((10 + n, starts + 1), (20 + n, starts + 1 + np.maximum(sizes - n, 0))):
                value = np.zeros(len(words), np.uint64)
                for i in range(n):
                    byte = np.where(i < sizes, data[np.minimum(at + i, max(len(data) - 1, 0))], 0) if len(data) else value
                    value = (value << np.uint64(8)) | byte.astype(np.uint64)
                self.runs.append((hashed(value, salt, bits), np.arange(1, len(words) + 1)))
        # A word as a whole, by a hash of all its bytes.
        powers = np.cumprod(np.full(int(sizes.max(initial=0)) + 2, MULTIPLIER, np.uint64))
        total = np.concatenate([[np.uint64(0)], np.cumsum((data + np.uint64(1)) * powers[place], dtype=np.uint64)])
        self.whole = total[starts + sizes + 2] - total[starts]
        latin = np.concatenate([[0], np.cumsum((data >= 97) & (data <= 122))])
        self.letters = latin[starts + sizes + 2] > latin[starts]
        for i in np.flatnonzero(~self.letters).tolist():
            self.letters[i] = LETTER.search(words[i].decode("utf-8", "replace")) is not None

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of each word's n-grams and affixes."""
        out = np.zeros((len(self.whole), weights.shape[1]))
        for numbers, ends in self.runs:
            total = np.concatenate([np.zeros((1, weights.shape[1])), np.cumsum(weights[numbers], axis=0, dtype=np.float64)])
            out += np.diff(total[np.concatenate([[0], ends])], axis=0)
        return out

    def spread(self, errors: np.ndarray, size: int) -> np.ndarray:
        """The gradient: each word's errors added to its features."""
        out = np.zeros((size, errors.shape[1]))
        for numbers, ends in self.runs:
            owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            for label in range(errors.shape[1]):
                out[:, label] += np.bincount(numbers, errors[owner, label], size)
        return out


class Chain:
    """Forward-backward for many sequences at once, the longest first."""

    def __init__(self, start: np.ndarray, steps: np.ndarray):
        self.start, self.steps = np.exp(start - start.max(initial=-1e9)), np.exp(steps - steps.max(initial=-1e9))

    def run(self, emissions: np.ndarray, sizes: np.ndarray, first: np.ndarray, last: np.ndarray, pairs: bool = False):
        """Marginals of each position (time, sequence, label); with ``pairs`` also the summed marginals of steps.

        ``first`` weighs the labels before the first emission, ``last`` after the last.
        """
        time, count, labels = emissions.shape
        alive = np.searchsorted(-sizes, -np.arange(time), "left")  # sequences longer than t
        forward = np.empty((time, count, labels), emissions.dtype)
        now = first * emissions[0] if time else None
        for t in range(time):
            n = alive[t]
            if t:
                now = (now[:n] @ self.steps) * emissions[t, :n]
            now = now / now.sum(axis=1, keepdims=True)
            forward[t, :n] = now
        marginals = np.zeros_like(forward)
        between = np.zeros((labels, labels))
        back = last.copy()
        for t in range(time - 1, -1, -1):
            n = alive[t]
            own = forward[t, :n] * back[:n]
            marginals[t, :n] = own / own.sum(axis=1, keepdims=True)
            if t:
                ahead = emissions[t, :n] * back[:n]
                if pairs:
                    joint = forward[t - 1, :n, :, None] * self.steps * ahead[:, None, :]
                    between += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                ahead = ahead @ self.steps.T
                back[:n] = ahead / ahead.sum(axis=1, keepdims=True)
        return (marginals, between) if pairs else marginals

    def products(self, emissions: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For each sequence the matrix from the labels' weights before it to those at its end, up to a factor."""
        time, count, labels = emissions.shape
        alive = np.searchsorted(-sizes, -np.arange(time), "left")
        state = np.eye(labels, dtype=emissions.dtype) * emissions[0][:, None, :]
        for t in range(1, time):
            n = alive[t]
            now = (state[:n] @ self.steps) * emissions[t, :n, None, :]
            state[:n] = now / now.max(axis=(1, 2), keepdims=True)
        return state

    def whole(self, table: np.ndarray, texts: list[np.ndarray], piece: int = 128):
        """Words and marginals of all texts, in pieces: (word numbers, marginals, text of each piece).

        Texts are cut into pieces that all run side by side. What a piece hands
        to the next and to the one before is worked out first from the products
        of the pieces, so the result is that of one run over the whole text.
        """
        counts = np.array([-(-len(t) // piece) for t in texts])
        owner = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        sizes = np.minimum(piece, np.array([len(t) for t in texts])[owner] - place * piece)
        order = np.argsort(-sizes, kind="stable")
        owner, place, sizes = owner[order], place[order], sizes[order]
        at = np.empty(len(order), np.int64)
        at[order] = np.arange(len(order))
        starts = np.cumsum(counts) - counts
        words = np.zeros((int(sizes[0]), len(order)), np.int64)
        for i, text in enumerate(texts):
            padded = np.zeros(counts[i] * piece, np.int64)
            padded[:len(text)] = text
            words[:, at[starts[i]:starts[i] + counts[i]]] = padded.reshape(counts[i], piece).T[:len(words)]
        emissions = table[words]
        labels = emissions.shape[2]
        first = np.tile(self.start.astype(emissions.dtype), (len(order), 1))
        last = np.ones((len(order), labels), emissions.dtype)
        many = np.flatnonzero(counts > 1)
        if len(many):
            products = self.products(emissions, sizes)
            for j in range(1, int(counts.max())):
                open_ = many[counts[many] > j]
                now, before = at[starts[open_] + j], at[starts[open_] + j - 1]
                handed = (first[before][:, None, :] @ products[before])[:, 0] @ self.steps
                first[now] = handed / handed.sum(axis=1, keepdims=True)
            for j in range(int(counts.max()) - 1, 0, -1):
                open_ = many[counts[many] > j]
                now, before = at[starts[open_] + j], at[starts[open_] + j - 1]
                handed = (products[now] @ last[now][:, :, None])[:, :, 0] @ self.steps.T
                last[before] = handed / handed.sum(axis=1, keepdims=True)
        return words, self.run(emissions, sizes, first, last), owner


class Model:
    """Labels and weights; small enough to send to every task."""

    def __init__(self, labels: list[str], bits: int, lexicon: np.ndarray):
        n = len(labels)
        self.labels, self.bits, self.lexicon = labels, bits, lexicon
        self.weights = np.zeros((1 << bits, n), np.float32)
        self.words = np.zeros((len(lexicon) + 1, n), np.float32)
        self.start, self.steps = np.zeros(n), np.zeros((n, n))

    def lexical(self, features: Features) -> np.ndarray:
        """Row of each word in the lexicon; the last row stands for all other words."""
        at = np.searchsorted(self.lexicon, features.whole)
        at = np.minimum(at, len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == features.whole, at, len(self.lexicon)) if len(self.lexicon) else np.zeros(len(features.whole), np.int64)

    def emissions(self, features: Features) -> np.ndarray:
        """Factors of each word for each label; words without a letter say nothing."""
        scores = features.scores(self.weights) + self.words[self.lexical(features)]
        scores[~features.letters] = 0
        return np.maximum(np.exp(scores - scores.max(axis=1, keepdims=True, initial=-np.inf)), 1e-12).astype(np.float32)


def fit(samples: list[tuple[str, str]], bits: int = 15, lexicon: int = 20_000, rounds: int = 240, batch: int = 64,
        length: int = 48, switch: float = 0.02, rate: float = 0.3, seed: int = 7) -> Model:
    """Learn from (text, language) pairs: AdaGrad on sequences of ``length`` words, cut from the texts and
    joined to others at the rate ``switch``."""
    rng = np.random.default_rng(seed)
    labels = sorted({lang for _, lang in samples})
    texts = {lang: [w for w in (text.encode().split() for text, own in samples if own == lang) if w] for lang in labels}
    labels = [lang for lang in labels if texts[lang]]
    seen = Counter(w for lang in labels for words in texts[lang] for w in words)
    vocabulary = list(seen)
    features = Features(vocabulary, bits) if vocabulary else None
    if not labels:
        return Model([], bits, np.zeros(0, np.uint64))
    number = {w: i for i, w in enumerate(vocabulary)}
    coded = {lang: [np.array([number[w] for w in words]) for words in texts[lang]] for lang in labels}
    often = [number[w] for w, n in seen.most_common(lexicon) if n > 1]
    model = Model(labels, bits, np.unique(features.whole[often]) if often else np.zeros(0, np.uint64))
    lexical = model.lexical(features)
    sums = [np.full_like(x, 1e-3, dtype=np.float64) for x in (model.weights, model.words, model.start, model.steps)]
    n = len(labels)
    for _ in range(rounds):
        words, truth = np.zeros((length, batch), np.int64), np.zeros((length, batch), np.int64)
        for b in range(batch):
            t, label = 0, int(rng.integers(n))
            while t < length:
                own = coded[labels[label]][int(rng.integers(len(coded[labels[label]])))]
                run = min(length - t, len(own), int(rng.geometric(switch)))
                at = int(rng.integers(len(own) - run + 1))
                words[t:t + run, b], truth[t:t + run, b] = own[at:at + run], label
                t += run
                label = (label + 1 + int(rng.integers(n - 1))) % n if n > 1 else label
        used, inverse = np.unique(words, return_inverse=True)
        part = Features([vocabulary[i] for i in used], bits)
        emissions = model.emissions(part)[inverse.reshape(words.shape)]
        chain = Chain(model.start, model.steps)
        marginals, between = chain.run(emissions, np.full(batch, length), np.tile(chain.start, (batch, 1)), np.ones((batch, n)), pairs=True)
        errors = marginals - np.eye(n)[truth]
        firsts = errors[0].sum(axis=0) / batch
        steps = (between - np.histogram2d(truth[:-1].ravel(), truth[1:].ravel(), bins=(range(n + 1), range(n + 1)))[0]) / batch
        by_word = np.zeros((len(used), n))
        np.add.at(by_word, inverse.ravel(), errors.reshape(-1, n) / batch)
        by_word[~part.letters] = 0
        lex = np.zeros_like(model.words, dtype=np.float64)
        np.add.at(lex, lexical[used], by_word)
        grads = [part.spread(by_word, 1 << bits), lex, firsts, steps]
        for x, g, s in zip((model.weights, model.words, model.start, model.steps), grads, sums):
            s += g * g
            x -= (rate * g / np.sqrt(s)).astype(x.dtype)
    return model


def label(model: Model, most_words: int = 150_000):
    """A function from texts to (language, share of the words' probability) pairs, which remembers words."""
    chain = Chain(model.start, model.steps)
    known: dict[bytes, int] = {}
    table = np.ones((1, len(model.labels)), np.float32)
    lettered = np.zeros(1, bool)

    def answer(texts: list[bytes]) -> list[tuple[str, float]]:
        nonlocal table, lettered
        out = [(UNKNOWN, 0.0)] * len(texts)
        if not model.labels:
            return out
        split = [text.split() for text in texts]
        if len(known) > most_words:  # only the memory of words starts anew
            known.clear()
            table, lettered = table[:1], lettered[:1]
        fresh = list({w for own in split for w in own} - known.keys())
        if fresh:
            known.update(zip(fresh, range(len(table), len(table) + len(fresh))))
            rows, letters = [table], [lettered]
            for start in range(0, len(fresh), FRESH_WORDS):
                features = Features(fresh[start:start + FRESH_WORDS], model.bits)
                rows.append(model.emissions(features))
                letters.append(features.letters)
            table, lettered = np.concatenate(rows), np.concatenate(letters)
            del features, rows, letters
        coded = [np.array([known[w] for w in own], np.int64) for own in split]
        heard = [i for i, own in enumerate(coded) if len(own) and lettered[own].any()]
        if heard:
            words, marginals, owner = chain.whole(table, [coded[i] for i in heard])
            marginals[~lettered[words]] = 0
            total = np.zeros((len(heard), len(model.labels)))
            np.add.at(total, owner, marginals.sum(axis=0, dtype=np.float64))
            share = total / total.sum(axis=1, keepdims=True)
            for i, own in zip(heard, share):
                best = int(own.argmax())
                out[i] = (model.labels[best], float(own[best]))
        return out

    return answer


def sample(docs: DataFrame, text: str, lang: str, usable: Column, most_docs: int) -> list[tuple[str, str]]:
    """At most ``most_docs`` labelled texts, as many of each language, chosen by hash."""
    rows = docs.filter(usable & named(text).isNotNull() & named(lang).isNotNull()).select(
        named(text).alias("text"), named(lang).alias("lang"), F.xxhash64(named(text)).alias("draw"))
    kinds = rows.agg(F.count_distinct("lang")).first()[0]
    each = max(1, most_docs // max(1, kinds))
    # The hashes alone are ranked first; texts are read again below the last hash of each language.
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    lots = rows.select("lang", "draw").withColumn("place", place).filter(F.col("place") <= each)
    cuts = lots.groupBy("lang").agg(F.max("draw").alias("cut"))
    # One row per language. Equal texts tie, so the window below sees few rows more than are wanted.
    near = rows.join(F.broadcast(cuts), "lang").filter(F.col("draw") <= F.col("cut"))
    chosen = near.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))).filter(
        F.col("place") <= each)
    return [(r["text"], r["lang"]) for r in chosen.select("text", "lang", "place").orderBy("lang", "place").collect()]


def identify(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", most_docs: int = 1600,
             predicted: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add the predicted language and its share of the words' probability to every row.

    Only rows that fulfil ``learn`` and have a language teach. Columns of the new names are replaced. Predictions look
    at nothing but the text.
    """
    model = fit(sample(docs, text, lang, learn, most_docs))
    # The driver, too, outlives the step: what learning took is half of what its Python holds.
    trim()
    column = f"c{docs.columns.index(text)}"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        answer = label(model)
        for batch in sliced(batches, column, 1 << 20):
            answers = answer(byte_values(batch.column(column)))
            yield batch, [pa.array([a for a, _ in answers], pa.string()), pa.array([s for _, s in answers], pa.float64())]
        del answer
        trim()

    return with_columns(docs, predict, T.StructType([T.StructField(predicted, T.StringType()), T.StructField(score, T.DoubleType())]))
