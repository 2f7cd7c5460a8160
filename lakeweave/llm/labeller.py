"""A bidirectional recurrent network that labels every leaf block of a page as main text or not.

Each block enters as the mean of vectors for its path (tags and the words of their classes), the mean of vectors for
its words, both looked up by hash, and a few measures of its text. Two LSTMs read the blocks of the whole page, one in
each direction; a logistic unit sees both states and the block itself.

The network learns from pages whose markup names its parts. Since few kinds of markup stand in one table, the pages are
varied as they are learned from: parts get other tags and classes or none, and parts that such pages lack (notices,
sidebars, forms, reader comments) are put in, made of blocks of other pages and of fixed phrases.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Sequence
from functools import lru_cache

import numpy as np

from lakeweave.llm.markup import Leaf
from lakeweave.llm.shingles import word_hashes

TOKENS, TOKEN_SIZE = 4096, 12
WORDS, WORD_SIZE = 4096, 8
MEASURES, STATE = 10, 24
INPUT = TOKEN_SIZE + WORD_SIZE + MEASURES

# What names the parts of a page, in markup as people write it.
MAIN_TAGS = frozenset("article main".split())
MAIN_WORDS = frozenset("article content post entry story".split())
OTHER_TAGS = frozenset("nav header footer aside form button dialog menu fieldset legend".split())
OTHER_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar aside widget widgets footer header masthead topbar toolbar cookie cookies consent gdpr notice alert popup "
    "modal overlay newsletter subscribe subscription signup login register form search share sharing social related recommended "
    "recommendations teaser comment comments respond reply replies discussion feedback pagination pager copyright legal disclaimer "
    "trending popular").split())
WRAPPERS = {
    "main": [("article", ""), ("main", ""), ("div", "content"), ("div", "post"), ("section", "entry content"), ("div", "article text"),
             ("div", "story body"), ("article", "post"), ("div", "main content"), ("div", ""), ("td", "")],
    "nav": [("nav", ""), ("div", "menu"), ("nav", "main menu"), ("div", "navbar"), ("header", ""), ("div", "breadcrumb"), ("div", "top")],
    "ad": [("div", "ad"), ("div", "ads"), ("div", "advert"), ("section", "sponsored"), ("div", "promo"), ("aside", "advertisement"), ("div", "banner"), ("ins", "ad")],
    "footer": [("footer", ""), ("div", "footer"), ("footer", "site footer"), ("div", "bottom"), ("div", "copyright")],
    "header": [("header", ""), ("div", "header"), ("header", "site header"), ("div", "masthead"), ("div", "topbar")],
    "sidebar": [("aside", ""), ("div", "sidebar"), ("aside", "sidebar"), ("div", "widget"), ("section", "related"), ("div", "recommended"), ("div", "right column")],
    "notice": [("div", "cookie notice"), ("div", "notice"), ("div", "alert"), ("div", "cookie consent"), ("section", "banner"), ("dialog", ""), ("div", "popup"), ("p", "notice")],
    "form": [("form", ""), ("form", "newsletter"), ("form", "search"), ("form", "comment form"), ("div", "subscribe"), ("fieldset", ""), ("div", "login")],
    "comments": [("section", "comments"), ("div", "comments"), ("ol", "comment list"), ("div", "reader comments"), ("section", "discussion"), ("div", "replies"), ("div", "respond")],
}
INNER = {"comments": [("div", "comment"), ("li", "comment"), ("article", "comment"), ("div", "reply"), ("div", ""), ("blockquote", "")],
         "sidebar": [("li", ""), ("div", ""), ("p", ""), ("h3", "")], "nav": [("li", ""), ("div", ""), ("td", "")], "form": [("label", ""), ("p", ""), ("button", ""), ("div", "")],
         "header": [("h2", ""), ("div", ""), ("p", ""), ("h1", "")], "notice": [("p", ""), ("div", ""), ("button", "")], "ad": [("p", ""), ("div", "")], "footer": [("p", ""), ("div", ""), ("li", "")]}
#: Elements that blocks of the main text stand in.
TEXT_ELEMENTS = [(("p", ""),), (("ul", ""), ("li", "")), (("ol", ""), ("li", "")), (("blockquote", ""), ("p", "")), (("blockquote", ""),), (("h2", ""),), (("h3", ""),),
                 (("pre", ""),), (("table", ""), ("tr", ""), ("td", "")), (("div", ""),), (("section", ""), ("p", "")), (("div", "text"), ("p", "")), (("dl", ""), ("dd", "")),
                 (("figure", ""), ("figcaption", "")), (("header", ""), ("h1", "")), ()]
PHRASES = {
    "notice": ["We use cookies to improve your experience.", "By continuing you accept our use of cookies.", "Accept all cookies", "Privacy notice: we have updated our terms.",
               "Nous utilisons des cookies.", "Wir verwenden Cookies.", "Usamos cookies propias y de terceros.", "This page was last updated."],
    "form": ["Subscribe to our newsletter", "Your e-mail address", "Sign up", "Search", "Submit", "Leave a comment", "Name", "Log in", "Newsletter abonnieren", "S'abonner", "Enviar", "Password"],
    "comments": ["Comments", "Reply", "3 comments", "Anonymous says:", "Posted by anna at 10:42", "Great article, thanks!", "I do not agree with this at all.", "Kommentare", "Commentaires", "Comentarios",
                 "First!", "Thank you for sharing."],
    "sidebar": ["Related articles", "Most read", "Popular posts", "Follow us", "Share this", "Tags", "Read more", "Archive", "You may also like", "Categories"],
    "header": ["Home", "Welcome to our site", "Daily News", "Menu", "Skip to content", "Sign in"],
    "ad": ["Advertisement", "Sponsored", "Buy now and save 20%!", "Anzeige", "Publicité", "Publicidad", "Special offer: order today."],
    "footer": ["All rights reserved.", "© 2024", "Terms of use", "Privacy policy", "Contact", "Imprint", "About us"],
}


def verdict(path: Sequence[tuple[str, Sequence[str]]]) -> bool | None:
    """What the markup says of a block: main text, not, or nothing."""
    inside = False
    titled = any(tag == "h1" for tag, _ in path)
    for tag, words in path:
        named = () if tag in ("html", "body", "main") else words
        if (tag in OTHER_TAGS and not (tag == "header" and inside and titled)) or not OTHER_WORDS.isdisjoint(named):
            return False
        inside = inside or tag in MAIN_TAGS or not MAIN_WORDS.isdisjoint(named)
    return True if inside else None


def teach(page: list[dict]) -> list[bool | None]:
    """Labels of a page's blocks; where no markup names the main text, blocks of a dozen words that are not links are."""
    labels = [verdict(leaf["path"]) for leaf in page]
    if True not in labels:
        labels = [label if label is not None else leaf["words"] >= 12 and leaf["measures"][2] < 0.34 for label, leaf in zip(labels, page)]
    return labels


@lru_cache(16384)
def path_tokens(path: tuple[tuple[str, tuple[str, ...]], ...]) -> tuple[int, ...]:
    """Rows of the token table: the innermost two tags by place, all tags, all words."""
    found = [f"{i}:{tag}" for i, (tag, _) in enumerate(reversed(path[-2:]))] + ["page"]
    for tag, words in path:
        found += [tag, *[f".{w}" for w in words]]
    return tuple(sorted({zlib.crc32(t.encode()) % TOKENS for t in found}))


def measures(leaf: Leaf) -> list[float]:
    text, size = leaf.text, len(leaf.text)
    words = text.count(" ") + 1
    return [np.log1p(size) / 5, np.log1p(words) / 3, leaf.linked / size, float(text[-1] in ".!?:;…\"»"), min(1.0, text.count(",") / words),
            sum(map(str.isdigit, text[:200])) / min(size, 200), float(text[0].isupper()), float(words <= 3)]


class Blocks:
    """Blocks of several pages as arrays; ``sizes`` are the blocks of each page."""

    def __init__(self, paths: list[tuple[int, ...]], words: np.ndarray, counts: np.ndarray, measured: np.ndarray, sizes: list[int]):
        self.kinds, self.kind = {}, np.empty(len(paths), np.int64)
        for i, path in enumerate(paths):
            self.kind[i] = self.kinds.setdefault(path, len(self.kinds))
        self.words, self.counts, self.sizes = words, counts, np.array(sizes, np.int64)
        place = np.arange(len(paths)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        own = np.repeat(self.sizes, self.sizes)
        self.measured = np.concatenate([measured.reshape(-1, MEASURES - 2), (place / np.maximum(own - 1, 1))[:, None], np.log1p(own)[:, None] / 5], axis=1).astype(np.float32)


def read_blocks(pages: list[list[Leaf]]) -> Blocks:
    every = [leaf for page in pages for leaf in page]
    texts = [leaf.text.encode() for leaf in every]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
    hashes, counts = word_hashes(np.frombuffer(b"".join(texts), np.uint8), offsets)
    return Blocks([path_tokens(leaf.path) for leaf in every], (hashes % np.uint64(WORDS)).astype(np.int64), counts,
                  np.array([measures(leaf) for leaf in every]), [len(p) for p in pages])


def sample_page(page: list[Leaf], most_blocks: int, most_words: int) -> str:
    """A page to learn from: its first and last blocks and the first words of each, as hashes."""
    if len(page) > most_blocks:
        page = page[:most_blocks // 2] + page[-(most_blocks // 2):]
    blocks = read_blocks([page])
    ends = np.cumsum(blocks.counts)
    return json.dumps([{"path": leaf.path, "hashes": blocks.words[end - n:end][:most_words].tolist(), "words": int(n), "measures": m}
                       for leaf, n, end, m in zip(page, blocks.counts.tolist(), ends.tolist(), np.round(blocks.measured[:, :MEASURES - 2].astype(float), 4).tolist())])


class Network:
    """Weights by name; ``token`` and ``word`` are the tables, ``f`` and ``b`` the two directions."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 1):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        self.w = weights or {
            "token": draw(TOKENS, TOKEN_SIZE) * 32, "word": draw(WORDS, WORD_SIZE) * 16,
            **{f"{d}x": draw(INPUT, 4 * STATE) for d in "fb"}, **{f"{d}h": draw(STATE, 4 * STATE) for d in "fb"},
            **{f"{d}0": np.repeat(np.array([0, 1, 0, 0], np.float32), STATE) for d in "fb"},
            "out": draw(2 * STATE + INPUT, 1)[:, 0], "out0": np.zeros(1, np.float32)}

    def inputs(self, blocks: Blocks) -> np.ndarray:
        paths = np.array([self.w["token"][list(p)].mean(axis=0) for p in blocks.kinds], np.float32).reshape(-1, TOKEN_SIZE)
        starts = np.cumsum(blocks.counts) - blocks.counts
        words = np.add.reduceat(self.w["word"][blocks.words], starts, axis=0) / blocks.counts[:, None] if len(starts) else np.zeros((0, WORD_SIZE))
        return np.concatenate([paths[blocks.kind], words.astype(np.float32), blocks.measured], axis=1)

    def run(self, d: str, x: np.ndarray) -> dict[str, np.ndarray]:
        """One direction over (steps, pages, INPUT): states and what errors need on their way back."""
        steps, pages = x.shape[:2]
        pre = (x.reshape(-1, INPUT) @ self.w[d + "x"] + self.w[d + "0"]).reshape(steps, pages, 4 * STATE)
        h = c = np.zeros((pages, STATE), np.float32)
        out = {k: np.empty((steps, pages, STATE), np.float32) for k in ("h", "c", "t")} | {"g": pre}
        for t in range(steps):
            z = pre[t]
            z += h @ self.w[d + "h"]
            z[:, :3 * STATE] = 1 / (1 + np.exp(-np.clip(z[:, :3 * STATE], -30, 30)))
            z[:, 3 * STATE:] = np.tanh(z[:, 3 * STATE:])
            c = z[:, STATE:2 * STATE] * c + z[:, :STATE] * z[:, 3 * STATE:]
            tc = np.tanh(c)
            h = z[:, 2 * STATE:3 * STATE] * tc
            out["h"][t], out["c"][t], out["t"][t] = h, c, tc
        return out

    def back(self, d: str, x: np.ndarray, ran: dict[str, np.ndarray], dh: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        steps, pages = x.shape[:2]
        dz = np.empty_like(ran["g"])
        later_h = later_c = np.zeros((pages, STATE), np.float32)
        for t in range(steps - 1, -1, -1):
            i, f, o, g = np.split(ran["g"][t], 4, axis=1)
            tc = ran["t"][t]
            dht = dh[t] + later_h
            dc = later_c + dht * o * (1 - tc * tc)
            before = ran["c"][t - 1] if t else 0
            dz[t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dht * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            later_h, later_c = dz[t] @ self.w[d + "h"].T, dc * f
        flat = dz.reshape(-1, 4 * STATE)
        past = np.concatenate([np.zeros((1, pages, STATE), np.float32), ran["h"][:-1]]).reshape(-1, STATE)
        return {d + "x": x.reshape(-1, INPUT).T @ flat, d + "h": past.T @ flat, d + "0": flat.sum(axis=0)}, (flat @ self.w[d + "x"].T).reshape(x.shape)

    @staticmethod
    def padded(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each block stands in (steps, pages), read forward and backward, and the shape."""
        page = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(page)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return place * len(sizes) + page, (np.repeat(sizes, sizes) - 1 - place) * len(sizes) + page, np.array([sizes.max(), len(sizes)])

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list]:
        """The logit of each block, and what ``learn`` needs."""
        *ways, shape = self.padded(sizes)
        kept, states = [], [x]
        for d, at in zip("fb", ways):
            laid = np.zeros((shape[0] * shape[1], INPUT), np.float32)
            laid[at] = x
            laid = laid.reshape(*shape, INPUT)
            ran = self.run(d, laid)
            kept.append((d, at, laid, ran))
            states.append(ran["h"].reshape(-1, STATE)[at])
        seen = np.concatenate(states, axis=1)
        return seen @ self.w["out"] + self.w["out0"], [seen, kept]

    def label(self, blocks: Blocks, cells: int = 60_000) -> np.ndarray:
        """The probability of each block; pages of like length run side by side, about ``cells`` blocks at once."""
        x, sizes = self.inputs(blocks), blocks.sizes
        found = np.zeros(len(x), np.float32)
        firsts = np.cumsum(sizes) - sizes
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] > 0]
        while len(order):
            # Longest pages last: take from the end as many as fit into the cells.
            take = max(1, min(len(order), cells // int(sizes[order[-1]])))
            own, order = order[-take:], order[:-take]
            rows = np.concatenate([np.arange(firsts[p], firsts[p] + sizes[p]) for p in own])
            logits, _ = self.forward(x[rows], sizes[own])
            found[rows] = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
        return found

    def gradients(self, blocks: Blocks, labels: np.ndarray, known: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The mean loss of the blocks that have a label, and its gradient."""
        x = self.inputs(blocks)
        logits, (seen, kept) = self.forward(x, blocks.sizes)
        p = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
        weight = known / max(1, known.sum())
        loss = float(-(weight * np.log(np.clip(np.where(labels, p, 1 - p), 1e-9, 1))).sum())
        delta = ((p - labels) * weight).astype(np.float32)
        grads = {"out": seen.T @ delta, "out0": delta.sum(keepdims=True)}
        dseen = delta[:, None] * self.w["out"]
        dx = dseen[:, :INPUT].copy()
        for n, (d, at, laid, ran) in enumerate(kept):
            dh = np.zeros((laid.shape[0] * laid.shape[1], STATE), np.float32)
            dh[at] = dseen[:, INPUT + n * STATE:INPUT + (n + 1) * STATE]
            own, dlaid = self.back(d, laid, ran, dh.reshape(*laid.shape[:2], STATE))
            grads |= own
            dx += dlaid.reshape(-1, INPUT)[at]
        token, word = np.zeros_like(self.w["token"]), np.zeros_like(self.w["word"])
        by_kind = np.zeros((len(blocks.kinds), TOKEN_SIZE), np.float32)
        np.add.at(by_kind, blocks.kind, dx[:, :TOKEN_SIZE])
        for path, own in zip(blocks.kinds, by_kind):
            token[list(path)] += own / len(path)
        owner = np.repeat(np.arange(len(x)), blocks.counts)
        np.add.at(word, blocks.words, (dx[:, TOKEN_SIZE:TOKEN_SIZE + WORD_SIZE] / blocks.counts[:, None])[owner])
        return loss, grads | {"token": token, "word": word}

    def learn(self, pages: list[list[dict]], rounds: int = 20, batch: int = 16, rate: float = 0.01, seed: int = 2) -> float:
        """Adam over varied pages, and the loss of the last round."""
        rng = np.random.default_rng(seed)
        taught = [(page, teach(page)) for page in pages if page]
        stock = [leaf for page, labels in taught for leaf, label in zip(page, labels) if label]
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.w.items()}
        step, losses = 0, []
        for round_ in range(rounds):
            losses = []
            order = rng.permutation(len(taught))
            for start in range(0, len(order), batch):
                varied = [vary(*taught[i], stock, rng) for i in order[start:start + batch]]
                every = [leaf for page, _ in varied for leaf in page]
                labels = [label for _, own in varied for label in own]
                hashes = [leaf["hashes"] for leaf in every]
                blocks = Blocks([path_tokens(leaf["path"]) for leaf in every], np.concatenate([np.array(h, np.int64) for h in hashes]),
                                np.array([len(h) for h in hashes]), np.array([leaf["measures"] for leaf in every]), [len(p) for p, _ in varied])
                loss, grads = self.gradients(blocks, np.array([bool(x) for x in labels]), np.array([x is not None for x in labels]))
                losses.append(loss)
                step += 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                now = rate * (1 - round_ / rounds) * min(1.0, 5 / (norm + 1e-9))
                for k, g in grads.items():
                    first, second = moments[k]
                    first += 0.1 * (g - first)
                    second += 0.01 * (g * g - second)
                    self.w[k] -= now * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-6)
        return float(np.mean(losses)) if losses else 0.0


def element(choice: tuple[str, str]) -> tuple[str, tuple[str, ...]]:
    return choice[0], tuple(choice[1].split())


@lru_cache(None)
def phrase_leaves(kind: str) -> list[dict]:
    found = []
    for text in PHRASES[kind]:
        page = json.loads(sample_page([Leaf((), text, 0)], 8, 64))
        found += page
    return found


def vary(page: list[dict], labels: list[bool | None], stock: list[dict], rng: np.random.Generator) -> tuple[list[dict], list[bool | None]]:
    """The page as it is, or with other markup and with parts put in."""
    pick = lambda options: options[int(rng.integers(len(options)))]
    fixed = lambda path: tuple((tag, tuple(words)) for tag, words in path)
    page = [{**leaf, "path": fixed(leaf["path"])} for leaf in page]
    labels = list(labels)
    if rng.random() < 0.25:
        return page, labels
    if rng.random() < 0.7:
        # Whole parts get another wrapper; one choice a page and part.
        chosen = {kind: element(pick(options)) for kind, options in WRAPPERS.items()}
        swap = {}
        for leaf in page:
            for at in leaf["path"]:
                tag, words = at
                if at not in swap:
                    kind = ("main" if tag in MAIN_TAGS or not MAIN_WORDS.isdisjoint(words) else "nav" if tag == "nav" else "footer" if tag == "footer"
                            else "ad" if not OTHER_WORDS.isdisjoint(words) else None)
                    swap[at] = chosen[kind] if kind and rng.random() < 0.9 else at
        page = [{**leaf, "path": tuple(swap[at] for at in leaf["path"])} for leaf in page]
    frame = page[0]["path"][:2]
    if rng.random() < 0.5:
        # Blocks of the main text in other elements, short ones among them, and phrases that elsewhere are not main text.
        share = rng.random() * 0.6
        for i in [i for i, label in enumerate(labels) if label and rng.random() < share]:
            page[i] = {**page[i], "path": page[i]["path"][:-1] + tuple(map(element, pick(TEXT_ELEMENTS)))}
    if rng.random() < 0.5 and True in labels:
        for _ in range(int(rng.integers(1, 4))):
            at = pick([i for i, label in enumerate(labels) if label])
            leaf = {**pick(phrase_leaves(pick(list(PHRASES)))), "path": page[at]["path"]}
            at += int(rng.integers(2))
            page.insert(at, leaf)
            labels.insert(at, True)

    def part(kind: str, base: tuple) -> list[dict]:
        wrapper, inner = element(pick(WRAPPERS[kind])), element(pick(INNER[kind]))
        if rng.random() < 0.15:
            wrapper = (wrapper[0], ())
        path = base + ((wrapper,) if rng.random() < 0.9 else ()) + ((inner,) if rng.random() < 0.8 else ())
        links = kind in ("nav", "sidebar", "header") and rng.random() < 0.8
        own = []
        for _ in range(int(rng.integers(1, 7))):
            if stock and rng.random() < (0.6 if kind == "comments" else 0.25):
                leaf, ends = pick(stock), 0.5
            else:
                leaf, ends = pick(phrase_leaves(kind if kind in PHRASES else "sidebar")), 0.3
            measured = [*leaf["measures"][:2], 1.0, *leaf["measures"][3:]] if links else leaf["measures"]
            own.append({**leaf, "measures": measured, "path": path + ((("p", ()),) if rng.random() < ends else ())})
        return own

    main = [i for i, label in enumerate(labels) if label]
    inside = page[main[0]]["path"][:-1] if main else frame
    spots = []
    for kind in ("header", "nav", "notice", "sidebar", "form", "comments", "ad", "footer"):
        if rng.random() < 0.35:
            before, after = (main[0], main[-1] + 1) if main else (0, len(page))
            if kind == "comments":
                spots.append((after, kind, inside if rng.random() < 0.3 else frame))
            elif kind in ("header", "nav"):
                spots.append((0, kind, frame))
            elif kind == "footer":
                spots.append((len(page), kind, frame))
            elif rng.random() < 0.3 and main:
                spots.append((int(rng.integers(before, after + 1)), kind, inside))
            else:
                spots.append((pick([0, before, after, len(page)]), kind, frame))
    for at, kind, base in sorted(spots, key=lambda s: -s[0]):
        own = part(kind, base)
        page[at:at], labels[at:at] = own, [False] * len(own)
    return page, labels
