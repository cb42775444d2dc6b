"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Every n-gram of the test items is counted over all training texts. In each stretch of consecutive
n-grams of an item the rarest is a seed, so an unedited run of `stretch + n - 1` words holds one
however often it was copied. Seeds join passages to items; a passage is aligned with its item, and the score
says how much of the item it holds, edits, insertions and omissions counted off. A long item is copied in part as well:
a fixed score suffices, whatever the length of the item.

The items are taken in blocks of a bounded number of words; a block's tables are what is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import bounded_batches


@dataclass(frozen=True)
class AlignConfig:
    """A passage is a copy if its alignment scores at least `least` of the item's score with itself, or as much as
    `exact` words in a row do, whatever share of the item that is."""

    n: int = 3
    stretch: int = 4
    match: int = 2
    mismatch: int = -1
    gap: int = -1
    least: float = 0.5
    exact: int = 13
    slack: float = 0.5
    block_words: int = 1_000_000


#: Letters and digits stay, other ASCII characters part words.
_TABLE = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
_SCHEMA = "doc_id bigint, item_id bigint, score double, points int, first_word int, last_word int"


def tokens(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_TABLE).split()


class Items:
    """A block of test items as word numbers; 0 is any word that no item has."""

    def __init__(self, rows: list[tuple[int, list[bytes]]], config: AlignConfig) -> None:
        self.config = config
        self.words: dict[bytes, int] = {}
        self.items = [(i, np.array([self.words.setdefault(w, len(self.words) + 1) for w in ws], np.int64)) for i, ws in rows if ws]
        #: n-grams as numbers below base ** n; an item shorter than n words is filled up with 0.
        self.base = len(self.words) + 1
        if self.base ** config.n >= 1 << 63:
            raise ValueError("a block has too many different words for its n-grams")
        made = [(self.grams(np.pad(ws, (0, max(0, config.n - len(ws)))))) for _, ws in self.items]
        self.all = np.unique(np.concatenate(made)) if made else np.zeros(0, np.int64)
        self.own = made

    def grams(self, ids: np.ndarray) -> np.ndarray:
        n = self.config.n
        out = np.zeros(max(len(ids) - n + 1, 0), np.int64)
        for k in range(n):
            out = out * self.base + ids[k : len(ids) - n + 1 + k]
        return out

    def numbers(self, words: list[bytes]) -> np.ndarray:
        get = self.words.get
        return np.array([get(w, 0) for w in words], np.int64)

    def short(self) -> bool:
        return any(len(ws) < self.config.n for _, ws in self.items)

    def hits(self, ids: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in `ids` of n-grams in the sorted `table`, and their rows there."""
        if not len(table) or not len(ids):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        n = self.config.n
        ids = np.concatenate((ids, np.zeros(n - 1, np.int64)))
        at = np.flatnonzero(ids[: len(ids) - n + 1] > 0)
        if not self.short():
            for k in range(1, n):
                at = at[ids[at + k] > 0]
        found = np.zeros(len(at), np.int64)
        for k in range(n):
            found = found * self.base + ids[at + k]
        row = np.minimum(np.searchsorted(table, found), len(table) - 1)
        same = table[row] == found
        if self.short():
            # a short item is looked for by its words alone, whatever follows them
            for short in {len(ws) for _, ws in self.items if len(ws) < n}:
                cut = self.base ** (n - short)
                head = found // cut * cut
                place = np.minimum(np.searchsorted(table, head), len(table) - 1)
                also = table[place] == head
                at, row, same = np.concatenate((at, at[also])), np.concatenate((row, place[also])), np.concatenate((same, np.ones(int(also.sum()), bool)))
        return at[same], row[same]


def aligned(item: np.ndarray, words: np.ndarray, config: AlignConfig) -> tuple[int, int, int]:
    """The best local alignment: its score, and the first and last place in `words` that it touches."""
    m = len(words)
    steps = np.arange(m + 1) * -config.gap
    above, origin = np.zeros(m + 1, np.int64), np.arange(m + 1)
    best, first, last = 0, 0, 0
    for x in item:
        diagonal = above[:-1] + np.where(words == x, config.match, config.mismatch)
        up = above[1:] + config.gap
        row = np.maximum(0, np.maximum(diagonal, up))
        start = np.where(row == 0, np.arange(1, m + 1), np.where(row == diagonal, origin[:-1], origin[1:]))
        # gaps along the row: the running maximum of the score with the steps so far added back
        full = np.concatenate(([0], row)) + steps
        most = np.maximum.accumulate(full)
        source = np.maximum.accumulate(np.where(full == most, np.arange(m + 1), 0))
        new = most - steps
        start = np.concatenate(([0], start))[source]
        start = np.where(new == 0, np.arange(m + 1), start)
        above, origin = new, start
        j = int(new.argmax())
        if new[j] > best:
            best, first, last = int(new[j]), int(start[j]), j - 1
    return best, first, last


def rare_seeds(items: Items, counts: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """The seeds, sorted, and for each the (item row, place in the item) it stands for."""
    seeds: dict[int, set[tuple[int, int]]] = {}
    for row, grams in enumerate(items.own):
        rare = counts[np.searchsorted(items.all, grams)]
        width = min(items.config.stretch, len(grams))
        for at in range(len(grams) - width + 1):
            k = at + int(rare[at : at + width].argmin())
            seeds.setdefault(int(grams[k]), set()).add((row, k))
    table = np.array(sorted(seeds), np.int64)
    return table, [sorted(seeds[s]) for s in table.tolist()]


def copies_in(items: Items, seeds: np.ndarray, places: list, ids: np.ndarray) -> list[tuple[int, float, int, int, int]]:
    """(item id, score, points, first word, last word) of the copies in one text, the best of each item."""
    config, best = items.config, {}
    at, row = items.hits(ids, seeds)
    starts: dict[int, list[int]] = {}
    for p, r in zip(at.tolist(), row.tolist(), strict=True):
        for item, k in places[r]:
            starts.setdefault(item, []).append(p - k)
    for item, begins in starts.items():
        item_id, words = items.items[item]
        size, (own, times) = len(words), np.unique(words, return_counts=True)
        slack = max(4, int(size * config.slack))
        full, done = config.match * size, None
        enough = min(config.least * full, config.match * config.exact)
        for begin in sorted(begins):
            if done is not None and begin + size <= done:
                continue  # the passage around an earlier seed covers it
            low, high = max(0, begin - slack), min(len(ids), begin + size + 2 * slack)
            done = high - slack
            part = ids[low:high]
            # no alignment has more matches than the passage has words of the item, each as often as the item at most
            place = np.minimum(np.searchsorted(own, part), len(own) - 1)
            there = np.bincount(place[own[place] == part], minlength=len(own))
            if config.match * int(np.minimum(there, times).sum()) < enough:
                continue
            score, first, last = aligned(words, part, config)
            if score >= enough and score > best.get(item_id, (0,))[0]:
                best[item_id] = (score, full, low + first, low + last)
    return [(i, s / f, s, a, b) for i, (s, f, a, b) in sorted(best.items())]


def _blocks(benchmark: DataFrame, config: AlignConfig, item_id: str, text: str) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items in the order of their ids, at most `block_words` words at once (or one item)."""
    block, held = [], 0
    rows = benchmark.select(F.col(item_id).cast("bigint").alias("i"), F.col(text).alias("t")).distinct()
    for row in rows.orderBy("i", "t").toLocalIterator():
        words = tokens(row["t"])
        if block and held + len(words) > config.block_words:
            yield block
            block, held = [], 0
        block.append((row["i"], words))
        held += len(words)
    if block:
        yield block


def copies(
    docs: DataFrame,
    benchmark: DataFrame,
    config: AlignConfig = AlignConfig(),
    key: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
) -> DataFrame:
    """(doc_id, item_id, score, points, first_word, last_word): texts that hold a copy of a test item.

    `score` is the alignment's share of the item's full score, `points` the score itself, `first_word` and `last_word` where it lies among the text's
    words. Words are lower-cased letters and digits. Null and empty texts or items have no words and match nothing;
    an item in several places of a text is one row, the best of them; repeated rows give a row each. Texts
    are read twice for every block of items and never shuffled.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    given = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    found = spark.createDataFrame([], _SCHEMA)
    for block in _blocks(benchmark, config, item_id, text):
        items = Items(block, config)
        shared = spark.sparkContext.broadcast(items)

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            total = np.zeros(len(items.all), np.int64)
            for batch in batches:
                for t in batch.column("text"):
                    _, rows = items.hits(items.numbers(tokens(t.as_py())), items.all)
                    total[np.unique(rows)] += 1
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "texts"])

        # as many rows as the block has n-grams, whatever the corpus
        counted = given.mapInArrow(count, "gram bigint, texts bigint").groupBy("gram").agg(F.sum("texts").alias("texts"))
        counts = np.zeros(len(items.all), np.int64)
        for row in counted.collect():
            counts[row["gram"]] = row["texts"]
        ready = spark.sparkContext.broadcast((items, *rare_seeds(items, counts)))

        def align(batches: Iterator[pa.RecordBatch], ready=ready) -> Iterator[pa.RecordBatch]:
            items, seeds, places = ready.value
            for batch in batches:
                out = [[] for _ in range(6)]
                for doc_id, t in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                    for copy in copies_in(items, seeds, places, items.numbers(tokens(t.as_py()))):
                        for column, value in zip(out, (doc_id, *copy), strict=True):
                            column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(out, kinds, strict=True)],
                    ["doc_id", "item_id", "score", "points", "first_word", "last_word"],
                )

        found = found.unionByName(given.mapInArrow(align, _SCHEMA))
    return found


def without_copies(
    docs: DataFrame, benchmark: DataFrame, config: AlignConfig = AlignConfig(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` without the rows whose id has a copy of a test item; rows without an id count as one id here."""
    marked = copies(docs, benchmark, config, key, text).select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(marked, docs[key].cast("bigint").eqNullSafe(marked["_id"]), "left_anti")
