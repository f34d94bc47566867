"""Benchmark decontamination by the q-gram lemma.

An alignment of an item of m characters with at most e edits keeps at least m + 1 - q (e + 1) of its q-grams, all on diagonals at
most e apart. Shared q-grams of a document and an item are counted in overlapping bands of diagonals: a band begins every
WIDTH diagonals and goes on for e more, so each such alignment lies in one band whole. Bands that reach the bound are verified by
banded alignment of the whole item against the text around the band. Characters are the UTF-8 bytes of letters and digits, A-Z as
a-z: spacing, line breaks and punctuation don't count.

The items are the query set: the plan carries their texts to the tasks in blocks of about BLOCK_BYTES, and each task indexes a block at
a time; so the plan grows with the benchmark's text, a task's memory with a block (or one longer item), and nothing with the documents.
Every document is read whole.

Defined cases: null and empty texts and items match nothing; items of fewer than q characters match nothing; repeated items and rows
match each for itself; without items nothing is contaminated; extra columns pass through ``drop_contaminated``; a document is
removed for its own text, whatever its doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.tokens import _BASE, _INVERSE, _powers, mixed, slices

Q = 12
#: Edits allowed, as a share of an item's characters; fewer where the lemma would give no bound.
EDIT_SHARE = 0.05
WIDTH = 16
BLOCK_BYTES = 4 << 20
#: Shared q-grams that are listed at once; cells of alignments that are filled at once, unless one item has more.
HITS, CELLS = 1 << 20, 1 << 20
TABLE_BITS = 22


def solid(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and digits of the texts in lower case, their new offsets, and where each was."""
    keep = np.zeros(256, bool)
    keep[48:58] = keep[65:91] = keep[97:123] = keep[128:] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    where = np.flatnonzero(keep[data])
    return lower[data[where]], np.searchsorted(where, offsets), where


def gram_hashes(chars: np.ndarray) -> np.ndarray:
    n = len(chars)
    if n < Q:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(np.arange(256, dtype=np.uint64), 7)[chars] * _powers(n, _BASE)[:n], out=sums[1:])
    return mixed((sums[Q:] - sums[:-Q]) * _powers(n, _INVERSE)[: n - Q + 1], 31)


class Items:
    """Index of a block of items: characters, edit budgets, bounds, and q-grams with their places."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids, self.chars, self.budget, self.bound, keys, where = [], [], [], [], [], []
        for i, text in zip(ids, texts, strict=True):
            data = np.frombuffer(text.encode(), np.uint8)
            chars = solid(data, np.array([0, len(data)]))[0]
            if len(chars) >= Q:
                e = min(int(EDIT_SHARE * len(chars)), (len(chars) - Q) // Q)
                h = gram_hashes(chars)
                keys.append(h)
                where.append(np.stack([np.full(len(h), len(self.ids)), np.arange(len(h))], 1))
                self.ids.append(i), self.chars.append(chars), self.budget.append(e), self.bound.append(len(chars) + 1 - Q * (e + 1))
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        self.where = np.concatenate(where) if where else np.zeros((0, 2), np.int64)
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.where = self.keys[order], self.where[order]
        self.budget, self.bound = np.array(self.budget, np.int64), np.array(self.bound, np.int64)

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, index of item, edits, start, end) of the best match of each row and item; start and end in bytes of data."""
        if not len(self.keys):
            return []
        if not hasattr(self, "bits"):
            self.bits = np.zeros(1 << TABLE_BITS, bool)
            self.bits[self.keys >> np.uint64(64 - TABLE_BITS)] = True
        chars, ends, where = solid(data, offsets)
        h = gram_hashes(chars)
        at = np.flatnonzero(self.bits[h >> np.uint64(64 - TABLE_BITS)])
        low = np.searchsorted(self.keys, h[at], "left")
        many = np.searchsorted(self.keys, h[at], "right") - low
        at, low, many = at[many > 0], low[many > 0], many[many > 0]
        row = np.searchsorted(ends, at, "right") - 1
        inside = at + Q <= ends[row + 1]
        at, low, many, row = at[inside], low[inside], many[inside], row[inside]
        # Shared q-grams are listed so many at a time, and only counted: a common one may stand in every item.
        n_items, ends_of = len(self.ids), np.cumsum(many)

        def shared() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            a = 0
            while a < len(at):
                done = ends_of[a - 1] if a else 0
                b = max(int(np.searchsorted(ends_of, done + HITS, "right")), a + 1)
                each = np.repeat(np.arange(a, b), many[a:b])
                nth = np.arange(len(each)) - np.repeat(ends_of[a:b] - many[a:b] - done, many[a:b])
                item, place = self.where[low[each] + nth].T
                yield row[each] * n_items + item, at[each] - place
                a = b

        # Rows and items with too few shared q-grams in all go first.
        pair, total = counted(np.unique(p, return_counts=True) for p, _ in shared())
        good = pair[total >= self.bound[pair % n_items]] if len(pair) else pair
        if not len(good):
            return []
        span, back_to = len(chars) // WIDTH + 4096, int(self.budget.max()) // WIDTH + 2

        def bands() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for pair, diagonal in shared():
                ok = good[np.minimum(np.searchsorted(good, pair), len(good) - 1)] == pair
                pair, diagonal = pair[ok], diagonal[ok]
                e, band = self.budget[pair % n_items], diagonal // WIDTH + 2048
                keys = [pair * span + band]
                for back in range(1, back_to):  # earlier bands that go on to here
                    there = diagonal - (band - 2048 - back) * WIDTH < WIDTH + e
                    keys.append((pair * span + band - back)[there])
                yield np.unique(np.concatenate(keys), return_counts=True)

        key, count = counted(bands())
        pair, band = key // span, key % span - 2048
        ok = count >= self.bound[pair % n_items]
        pair, band = pair[ok], band[ok]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        # Items of like length together, so many at once as have a bounded number of cells.
        sizes = np.array([len(c) for c in self.chars])
        order = np.argsort(sizes[pair % n_items], kind="stable")
        pair, band = pair[order], band[order]
        cells = WIDTH + 3 * self.budget[pair % n_items] + 1 + sizes[pair % n_items]  # of the band and of the item
        a = 0
        while a < len(pair):
            b = a + 1
            while b < len(pair) and (b + 1 - a) * cells[b] <= CELLS:
                b += 1
            rows, items, lows = pair[a:b] // n_items, pair[a:b] % n_items, band[a:b] * WIDTH
            edits, last = self.aligned(chars, ends[rows], ends[rows + 1], items, lows)
            for r, i, d, j in zip(rows.tolist(), items.tolist(), edits.tolist(), last.tolist(), strict=True):
                if d <= self.budget[i] and d < best.get((r, i), (1 << 30,))[0]:
                    start = max(j - len(self.chars[i]), int(ends[r]))
                    best[r, i] = d, int(where[start]), int(where[j - 1]) + 1
            a = b
        return [(r, i, *found) for (r, i), found in sorted(best.items())]

    def aligned(self, chars: np.ndarray, begin: np.ndarray, end: np.ndarray, items: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fewest edits of whole items against any part of texts [begin, end) within e diagonals around [low, low + WIDTH + e), and where in chars the part ends."""
        size = np.array([len(self.chars[i]) for i in items])
        item = np.zeros((len(items), size.max()), np.uint8)
        for k, i in enumerate(items):
            item[k, : size[k]] = self.chars[i]
        pad = int(self.budget[items].max())
        width = WIDTH + 3 * pad + 1
        first = low - pad  # text position of the band's first diagonal for item position 0
        steps = np.arange(width)
        cost = np.where((first[:, None] + steps >= begin[:, None]) & (first[:, None] + steps <= end[:, None]), 0, 1 << 20)
        edits, last = np.full(len(items), 1 << 20), np.zeros(len(items), np.int64)
        for i in range(1, item.shape[1] + 1):
            j = first[:, None] + i + steps  # text position after this step
            there = (j > begin[:, None]) & (j <= end[:, None])
            text = chars[np.clip(j - 1, 0, len(chars) - 1)]
            step = np.where(there, cost + (text != item[:, i - 1, None]), 1 << 20)
            step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)  # an item's character without partner
            step = np.where((j >= begin[:, None]) & (j <= end[:, None]), step, 1 << 20)
            cost = np.minimum.accumulate(step - steps, axis=1) + steps  # characters of the text without partner
            cost = np.where(j <= end[:, None], cost, 1 << 20)
            done = np.flatnonzero(size == i)
            if len(done):
                k = cost[done].argmin(1)
                edits[done], last[done] = cost[done, k], j[done, k]
        return edits, last


def counted(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers and their counts over parts of (distinct numbers, counts)."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for k, n in parts:
        keys, which = np.unique(np.concatenate([keys, k]), return_inverse=True)
        counts = np.bincount(which, np.concatenate([counts, n]), len(keys)).astype(np.int64)
    return keys, counts


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list[int], list[str]]]:
    """Ids and texts of the items, in blocks of bounded size. Their indexes, many times as large, are made in the tasks."""
    ids, texts, size = [], [], 0
    for r in benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").orderBy("item_id", "text").toLocalIterator():
        ids.append(r["item_id"])
        texts.append(r["text"])
        size += len(r["text"])
        if size > BLOCK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
    yield ids, texts


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item it contains: doc_id, item_id, edits, first_char, last_char (code points of the text, last exclusive)."""
    def search(block: tuple[list[int], list[str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(*block)
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                for row, data, offsets in slices(batch.column("text")):
                    out = [[], [], [], [], []]
                    for r, i, edits, start, end in items.matches(data, offsets):
                        text = data[offsets[r] : offsets[r + 1]]
                        points = [int(((text[: x - offsets[r]] & 0xC0) != 0x80).sum()) for x in (start, end)]
                        for column, value in zip(out, (ids[row + r], items.ids[i], edits, *points), strict=True):
                            column.append(value)
                    if out[0]:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["doc_id", "item_id", "edits", "first_char", "last_char"])

        return run

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = None
    for block in _blocks(benchmark):
        part = slim.mapInArrow(search(block), "doc_id long, item_id long, edits long, first_char long, last_char long")
        found = part if found is None else found.unionByName(part)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no item, with their own columns."""
    def sift(block: tuple[list[int], list[str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(*block)
            for batch in batches:
                keep = np.ones(len(batch), bool)
                for row, data, offsets in slices(batch.column("text")):
                    keep[[row + m[0] for m in items.matches(data, offsets)]] = False
                yield batch.filter(pa.array(keep))

        return run

    for block in _blocks(benchmark):
        docs = docs.mapInArrow(sift(block), docs.schema)
    return docs
