"""Evaluation texts leaking into training texts.

The normalised test items are put into generalised suffix automata.  The tokens
of every text are streamed through them, tracking the length of the longest
match.  Wherever the match is at least a run long, every place of the items at
which that run ends is credited, not only that of the longest match, so that
items which share passages do not hide each other.  The credited places of an
item are chained in the order of both the item and the text; what the chain
covers of the item decides, and nothing else: neither the length of the text
nor how far the parts lie apart nor how many items share a run.  Spans beyond
the limits of coverage or length can be removed.

Tokens are words or numbers of alphabetic scripts and single Han characters.
Normalisation drops case, width, marks, invisible characters and the order of
letters inside a word, so that small alterations of the writing do not break
a run.

Scale: items are counted before any of them is read.  Up to a number of
characters they make one automaton; beyond, they are dealt into as many shards
as it takes, each built by the Python workers that use it and forgotten after,
so a test suite of any size is handled exactly, at one pass of the texts a
shard.  Texts are processed where they lie, in Arrow batches, without a
shuffle.  Time is linear in the text; only items of which a text holds enough
places at all, in whatever order, are chained.

Defined results: null, empty and blank texts leak nothing; an item without
tokens leaks nowhere; an item shorter than a run leaks where it is held whole;
repeated texts are each reported; equal items are each reported; an empty table
on either side gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.session import spread

#: Characters of test items that one automaton takes; more items are dealt into shards.
SHARD_CHARS = 1_000_000
#: Share of an item that a text must hold.
COVERAGE = 0.5
#: Least length of a run: words, Han characters.
RUN_WORDS, RUN_HAN = 3, 4
#: A run of this many tokens is removed although the text holds little else of the item.
LONGEST_RUN = 40
#: Removed spans that lie at most this many tokens apart are one.
BETWEEN = 4
#: Stands for a removed span; as a token it is no part of any item, so that a cut makes no new run.
MARK = "[leak removed]"
#: Words whose number a worker keeps.
KEPT_WORDS = 500_000

_HAN = "㐀-䶿一-鿿豈-﫿"
_TOKEN = re.compile(rf"{re.escape(MARK)}|[{_HAN}]|[^\W_{_HAN}]+")
_INVISIBLE = re.compile("[­​-‏⁠⁡-⁤﻿‪-‮]")


def normalise(text: str) -> str:
    if text.isascii():
        return text.casefold()
    text = unicodedata.normalize("NFKD", _INVISIBLE.sub("", text)).casefold()
    marks = {ord(c): None for c in set(text) if unicodedata.combining(c)}
    return text.translate(marks) if marks else text


def _key(token: str) -> str:
    """Letters within a word are sorted, so that swapped ones do not matter."""
    return token if len(token) < 4 or not token.isalpha() else "".join(sorted(token))


def tokens(text: str) -> list[str]:
    """Han characters and words."""
    return [_key(t) for t in _TOKEN.findall(normalise(text)) if t != MARK]


def placed_words(text: str) -> list[tuple[str, int, int]]:
    """The words as normalised, with the places of their first and behind their last character in the text as written."""
    chars, places = [], []
    for at, c in enumerate(text):
        if not _INVISIBLE.match(c):
            for x in unicodedata.normalize("NFKD", c).casefold():
                if not unicodedata.combining(x):
                    chars.append(x)
                    places.append(at)
    return [(m[0], places[m.start()], places[m.end() - 1] + 1) for m in _TOKEN.finditer("".join(chars))]


def _is_han(t: str) -> bool:
    return "㐀" <= t[0] <= "鿿"


class Automaton:
    """A generalised suffix automaton of token lists, as flat tables over numbered tokens.

    A place is an item's token, numbered through all items.  A state stands for token runs that end
    at the same places; ``home`` of a state is the shortest of its ancestors that is at least a run
    long, and ``ends`` of that one are all places where the run ends: together no more than there
    are tokens."""

    def __init__(self, lists: list[tuple[int, list[str]]]):
        self.ids = [item for item, _ in lists]
        sizes = [len(ts) for _, ts in lists]
        self.sizes = np.array(sizes, np.int64)
        self.item_of = np.repeat(np.arange(len(lists)), sizes)
        self.first = np.cumsum([0, *sizes])[:-1] if sizes else np.zeros(0, np.int64)
        self.words: dict[str, int] = {}
        self.known: dict[str, int] = {}
        self.need: list[int] = []
        for _, ts in lists:
            for t in ts:
                if t not in self.words:
                    self.words[t] = len(self.words)
                    self.need.append(RUN_HAN if _is_han(t) else RUN_WORDS)
        self.width = max(len(self.words), 1)
        self.next: dict[int, int] = {}
        self.out: list[list[int]] = [[]]
        self.link, self.length, last_word = [-1], [0], [-1]
        self.short: dict[tuple[int, ...], list[int]] = {}
        own: list[int] = []
        for k, (_, ts) in enumerate(lists):
            last, numbers = 0, [self.words[t] for t in ts]
            if numbers and len(numbers) < self.need[numbers[-1]]:
                self.short.setdefault(tuple(numbers), []).append(k)
            for w in numbers:
                last = self._extend(last, w, last_word)
                own.append(last)
        self._settle(own, last_word)
        del self.out

    def _extend(self, last: int, w: int, last_word: list[int]) -> int:
        link, length, width, nxt = self.link, self.length, self.width, self.next
        q = nxt.get(last * width + w)
        if q is not None:
            return q if length[q] == length[last] + 1 else self._clone(last, w, q, last_word)
        cur = self._state(length[last] + 1, w, last_word)
        p = last
        while p != -1 and p * width + w not in nxt:
            self._put(p, w, cur)
            p = link[p]
        if p == -1:
            link[cur] = 0
        else:
            q = nxt[p * width + w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q, last_word)
        return cur

    def _put(self, p: int, w: int, to: int) -> None:
        if p * self.width + w not in self.next:
            self.out[p].append(w)
        self.next[p * self.width + w] = to

    def _state(self, length: int, w: int, last_word: list[int]) -> int:
        self.link.append(0)
        self.length.append(length)
        self.out.append([])
        last_word.append(w)
        return len(self.length) - 1

    def _clone(self, p: int, w: int, q: int, last_word: list[int]) -> int:
        c, width = self._state(self.length[p] + 1, w, last_word), self.width
        for x in self.out[q]:
            self._put(c, x, self.next[q * width + x])
        self.link[c] = self.link[q]
        while p != -1 and self.next.get(p * width + w) == q:
            self.next[p * width + w] = c
            p = self.link[p]
        self.link[q] = c
        return c

    def _settle(self, own: list[int], last_word: list[int]) -> None:
        states = len(self.length)
        home = [-1] * states
        for s in sorted(range(1, states), key=self.length.__getitem__):
            up = home[self.link[s]]
            home[s] = up if up >= 0 else s if self.length[s] >= self.need[last_word[s]] else -1
        self.home = home
        self.ends: dict[int, list[int]] = {}
        for place, s in enumerate(own):
            if home[s] >= 0:
                self.ends.setdefault(home[s], []).append(place)
        # the places that a run ending at a home covers
        self.cover = {h: np.unique(np.array(ps)[:, None] - np.arange(self.need[last_word[h]])) for h, ps in self.ends.items()}

    def number(self, words: list[str]) -> list[int]:
        """The numbers of words as normalised, -1 for those of no item."""
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        out = []
        for t in words:
            w = known.get(t)
            if w is None:
                w = known[t] = self.words.get(_key(t), -1)
            out.append(w)
        return out

    def runs(self, numbers: list[int], least: int = 0) -> list[tuple[int, int, int]]:
        """(place in the text, state, length) of the longest match that ends at each token; without
        ``least``, of those matches that are at least a run."""
        out = []
        state = n = 0
        get, link, length, width, need = self.next.get, self.link, self.length, self.width, self.need
        for at, w in enumerate(numbers):
            if w < 0:
                state = n = 0
                continue
            to = get(state * width + w)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = get(state * width + w)
            if to is not None:
                state, n = to, n + 1
                if n >= (least or need[w]):
                    out.append((at, state, n))
        return out

    def held(self, numbers: list[int], at_least: float) -> dict[int, list[tuple[int, int]]]:
        """For each item (by its number) of which the text holds ``at_least``: the chain of (place in the
        text, place in the item)."""
        need, home = self.need, self.home
        hits = [(at, home[s]) for at, s, _ in self.runs(numbers)]
        out: dict[int, list[tuple[int, int]]] = {}
        if self.short:
            for size in {len(x) for x in self.short}:
                for at in range(len(numbers) - size + 1):
                    for k in self.short.get(tuple(numbers[at : at + size]), ()):
                        out.setdefault(k, [(at + j, j) for j in range(size)])
        if not hits:
            return out
        homes = {h for _, h in hits}
        covered = np.unique(np.concatenate([self.cover[h] for h in homes]))
        enough = np.bincount(self.item_of[covered], minlength=len(self.ids)) >= np.maximum(at_least * self.sizes, 1)
        if not enough.any():
            return out
        item_of, first = self.item_of, self.first
        mine = {h: [(int(item_of[p]), p) for p in self.ends[h] if enough[item_of[p]]] for h in homes}
        cells: dict[int, set[tuple[int, int]]] = {}
        for at, h in hits:
            for k, p in mine[h]:
                cells.setdefault(k, set()).update((at - j, p - j) for j in range(need[numbers[at]]))
        for k, xs in cells.items():
            kept = chain(xs)
            if len(kept) >= at_least * self.sizes[k]:
                out[k] = [(d, p - int(first[k])) for d, p in kept]
        return out

    def long_runs(self, numbers: list[int], longest: int) -> list[tuple[int, int]]:
        """(from, to) in the text of the matches of at least ``longest`` tokens."""
        return [(at - n + 1, at + 1) for at, _, n in self.runs(numbers, longest)]


def chain(cells: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest sequence of (place in text, place in item) that increases in both."""
    order = sorted(cells, key=lambda x: (x[0], -x[1]))
    tails: list[int] = []
    last: list[int] = []
    before = [-1] * len(order)
    for k, (_, i) in enumerate(order):
        at = bisect.bisect_left(tails, i)
        before[k] = last[at - 1] if at else -1
        if at == len(tails):
            tails.append(i)
            last.append(k)
        else:
            tails[at], last[at] = i, k
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(order[k])
        k = before[k]
    return out[::-1]


def leaks(auto: Automaton, text: str | None, at_least: float = COVERAGE) -> list[tuple[int, float]]:
    """(item, share of the item held) of one text, from ``at_least`` on."""
    if not text:
        return []
    numbers = auto.number(_TOKEN.findall(normalise(text)))
    return [(auto.ids[k], len(x) / int(auto.sizes[k])) for k, x in auto.held(numbers, at_least).items()]


def without_leaks(auto: Automaton, text: str, at_least: float = COVERAGE, longest: int = LONGEST_RUN) -> tuple[str, int]:
    """The text without the spans that hold ``at_least`` of an item, or a run of ``longest`` tokens, and the
    number of characters removed.  What is left holds neither."""
    removed = 0
    while True:
        numbers = auto.number(_TOKEN.findall(normalise(text)))
        out = sorted({d for x in auto.held(numbers, at_least).values() for d, _ in x} | {d for a, b in auto.long_runs(numbers, longest) for d in range(a, b)})
        if not out:
            return text, removed
        placed = placed_words(text)
        spans: list[list[int]] = []
        for d in out:
            if spans and d - spans[-1][1] <= BETWEEN:
                spans[-1][1] = d
            else:
                spans.append([d, d])
        parts, last = [], 0
        for a, b in spans:
            parts.append(text[last : placed[a][1]])
            last = placed[b][2]
            removed += last - placed[a][1]
        text = f" {MARK} ".join([*parts, text[last:]])


def _automata(items: DataFrame, shard_chars: int) -> Iterator[Broadcast]:
    """The automaton of each shard of the items, on the executors.  The driver holds one shard at a time."""
    rows = items.select("item_id", "text").where("text is not null and text != ''")
    shards = (rows.agg(F.sum(F.length("text"))).first()[0] or 0) // shard_chars + 1
    for k in range(shards):
        mine = rows if shards == 1 else rows.where(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == k)
        yield items.sparkSession.sparkContext.broadcast(Automaton(sorted((r["item_id"], tokens(r["text"])) for r in mine.toLocalIterator())))


def find_leaks(documents: DataFrame, items: DataFrame, coverage: float = COVERAGE, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """doc_id, item_id, share: the items of which a document holds at least ``coverage``.

    documents: doc_id, text; items: item_id, text."""
    rows = spread(documents.select("doc_id", "text").where("text is not null and text != ''"))

    def found_in(auto: Broadcast) -> DataFrame:
        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            a = auto.value
            for b in batches:
                found = [(doc, item, share) for doc, text in zip(b["doc_id"], b["text"], strict=True) for item, share in leaks(a, text, coverage)]
                yield pd.DataFrame(found, columns=["doc_id", "item_id", "share"])

        return rows.mapInPandas(scan, "doc_id long, item_id long, share double")

    return functools.reduce(DataFrame.unionAll, (found_in(auto) for auto in _automata(items, shard_chars)))


def remove_leaks(documents: DataFrame, items: DataFrame, coverage: float = COVERAGE, longest: int = LONGEST_RUN, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """doc_id, text, removed_chars: every document without the spans that leak, a mark in their place.

    What is left holds less than ``coverage`` of any item and no run of ``longest`` of its tokens; null
    texts stay null."""
    rows = spread(documents.select("doc_id", "text")).withColumn("removed_chars", F.lit(0).cast("long"))

    def cleaned(rows: DataFrame, auto: Broadcast) -> DataFrame:
        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            a = auto.value
            for b in batches:
                new = [(None, 0) if text is None else without_leaks(a, text, coverage, longest) for text in b["text"]]
                yield pd.DataFrame({"doc_id": b["doc_id"], "text": [t for t, _ in new], "removed_chars": b["removed_chars"] + [n for _, n in new]})

        return rows.mapInPandas(scan, "doc_id long, text string, removed_chars long")

    return functools.reduce(cleaned, _automata(items, shard_chars), rows)


def leaking_documents(found: DataFrame) -> DataFrame:
    """doc_id, items (sorted array of item ids), most (largest share held): a row per affected document."""
    return found.groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("share").alias("most"))
