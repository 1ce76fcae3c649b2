"""Benchmark passages in documents by the q-gram lemma.

A passage of m characters that occurs with at most k edits shares at least m - q + 1 - k * q of its q-grams with
the place where it occurs, on diagonals that lie within k of each other. Shared q-grams are counted in overlapping
bands of 2 (k + 1) diagonals, so that one band holds them all; bands that reach the bound are
verified by banded alignment. Documents are mapped without a shuffle; the benchmark goes to
the tasks in blocks of bounded size.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q = 8
ERROR_RATE = 0.1
#: Characters of benchmark text that one pass over the documents compares with.
BLOCK_CHARS = 4_000_000
_CHUNK_CHARS = 1 << 19
#: Cells of q-grams and regions of a text that one step handles at once.
_ROWS, _REGIONS = 1 << 20, 1 << 11
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 21
_IS_SPACE = np.zeros(0x3002, bool)
_IS_SPACE[[*range(33), 133, 160, 0x2007, 0x202F, 0x2028, 0x2029, 0x3000]] = True


def normalized(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points with runs of white space as one space, and the place of each in the text."""
    text = text or ""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = _IS_SPACE[np.minimum(codes, 0x3001)] if not text.isascii() else codes <= 32
    first = space & np.concatenate(([True], space[:-1])) if len(codes) else space
    places = np.flatnonzero(~first)
    codes = np.where(space[places], np.uint32(32), codes[places])
    end = len(codes) - (len(codes) > 0 and codes[-1] == 32)
    return codes[:end], places[:end]


def _grams(codes: np.ndarray) -> np.ndarray:
    """Rolling hashes of q code points, by doubling."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    h, power = codes.astype(np.uint64), np.array([_BASE])  # arrays wrap around silently
    for step in (1, 2, 4):
        h = h[:-step] + h[step:] * power
        power = power * power
    return h * np.uint64(0xD1342543DE82EF95)


def edit_budget(m: int, rate: float) -> int:
    """The edits allowed in a passage of m characters; the bound on shared q-grams stays at least one."""
    return min(int(rate * m), (m - Q) // Q)


def _verbatim(item: np.ndarray, region: np.ndarray) -> int:
    """Where the item stands in the region without edits, or -1."""
    whole, part, at = region.tobytes(), item.tobytes(), -1
    while (at := whole.find(part, at + 1)) >= 0:
        if at % item.itemsize == 0:
            return at // item.itemsize
    return -1


def _align(item: np.ndarray, regions: list[np.ndarray], band: int) -> list[tuple[int, int, int]]:
    """(edits, start, end) of the best occurrence of the item in each region, row by row over all regions at once.

    Cell j of row i compares the item's first i characters with the region's up to i + j - band.
    Cost and start are one number, so that the fewest edits win, then the shortest occurrence.
    """
    width, n, m = 2 * band + 1, len(regions), len(item)
    padded = np.full((n, m + 2 * width), -1, np.int64)
    lengths = np.array([len(r) for r in regions])
    for r, region in enumerate(regions):
        padded[r, band : band + len(region)] = region
    one, at = np.int64(1 << 32), np.arange(width)
    never = np.int64(1 << 50)
    start = at - band
    row = np.broadcast_to(np.where(start >= 0, (1 << 31) - start, never), (n, width)).copy()
    row[start[None, :] > lengths[:, None]] = never
    for i in range(m):
        window = padded[:, i : i + width]
        straight = row + np.where(window == item[i], 0, one)
        skip = np.concatenate([row[:, 1:], np.full((n, 1), never)], axis=1) + one
        row = np.minimum(straight, skip)
        end = i + 1 + start
        row[(end[None, :] < 0) | (end[None, :] > lengths[:, None])] = never
        row = np.minimum.accumulate(row - at * one, axis=1) + at * one
    best = row.argmin(axis=1)
    out = []
    for r, j in enumerate(best):
        v = int(row[r, j])
        cost, rest = v >> 32, v & 0xFFFFFFFF
        out.append((cost, (1 << 31) - rest, m + int(j) - band))
    return out


class _Index:
    """q-grams of a block of benchmark texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.texts, self.ids, self.budget, grams, owner, place = [], [], [], [], [], []
        for item_id, text in items:
            codes = normalized(text)[0]
            if len(codes) < Q:
                continue
            g = _grams(codes)
            grams.append(g), owner.append(np.full(len(g), len(self.ids))), place.append(np.arange(len(g)))
            self.texts.append(codes), self.ids.append(item_id), self.budget.append(edit_budget(len(codes), rate))
        grams = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(grams, kind="stable")
        self.owner = np.concatenate(owner)[order] if owner else np.zeros(0, int)
        self.place = np.concatenate(place)[order] if place else np.zeros(0, int)
        self.grams, first = np.unique(grams[order], return_index=True)
        self.first = np.append(first, len(grams))
        self.seen = np.zeros(1 << _TABLE_BITS, bool)
        self.seen[self.grams >> np.uint64(64 - _TABLE_BITS)] = True
        self.m = np.array([len(t) for t in self.texts], int)
        self.k = np.array(self.budget, int)
        self.bound = np.maximum(1, self.m - Q + 1 - self.k * Q)

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the codes whose q-gram is in the index, and the number of that q-gram."""
        found = []
        for a in range(0, max(1, len(codes) - Q + 1), _CHUNK_CHARS):
            g = _grams(codes[a : a + _CHUNK_CHARS + Q - 1])
            at = np.flatnonzero(self.seen[g >> np.uint64(64 - _TABLE_BITS)])
            where = np.searchsorted(self.grams, g[at])
            ok = self.grams[np.minimum(where, len(self.grams) - 1)] == g[at]
            found.append((at[ok] + a, where[ok]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def regions(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """Item, first diagonal and shared q-grams of the bands that reach the bound.

        Memory grows with the text and the index, not with their product: repeats of a q-gram are first gathered into cells.
        """
        at, gram = self.hits(codes)
        if not len(at):
            return []
        order = np.argsort(gram, kind="stable")
        at, gram = at[order], gram[order]
        grams = gram[np.r_[True, gram[1:] != gram[:-1]]]
        many = self.first[grams + 1] - self.first[grams]
        entry = np.repeat(self.first[grams] - np.cumsum(many) + many, many) + np.arange(many.sum())
        # An item whose q-grams are found at too few of its places falls short in every band.
        entry = entry[(np.bincount(self.owner[entry], minlength=len(self.m)) >= self.bound)[self.owner[entry]]]
        entry = entry[np.argsort(self.owner[entry], kind="stable")]
        owner, keep = self.owner[entry], []
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else []
        for a, b in zip(starts, [*starts[1:], len(owner)]):
            own, places = int(owner[a]), self.place[entry[a:b]]
            ids = np.searchsorted(self.first, entry[a:b], side="right") - 1
            first, counts = _band_counts(at, gram, ids, places, int(self.k[own]) + 1)
            keep += [(own, (first + int(i)) * (int(self.k[own]) + 1), int(counts[i])) for i in np.flatnonzero(counts >= self.bound[own])]
        return keep


def _band_counts(at: np.ndarray, gram: np.ndarray, ids: np.ndarray, places: np.ndarray, width: int) -> tuple[int, np.ndarray]:
    """Number of the first band, and in how many places of an item each band shares a q-gram with the text.

    `at` are places in the text, sorted by `gram` and place; the item has q-gram `ids[i]` at `places[i]`. Band b holds the diagonals
    b * width up to (b + 2) * width, so each diagonal is in two. Of the occurrences of a q-gram in a cell of `width` places
    the first and the last reach every band that any of them reaches.
    """
    wanted = np.unique(ids)
    low, n = np.searchsorted(gram, wanted), np.searchsorted(gram, wanted, side="right")
    n -= low
    some = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
    at, gram = at[some], gram[some]
    cell = at // width
    new = np.r_[True, (cell[1:] != cell[:-1]) | (gram[1:] != gram[:-1])]
    ends, cells = (at[new], at[np.r_[new[1:], True]]), gram[new]
    low, high = np.searchsorted(cells, ids), np.searchsorted(cells, ids, side="right")
    lengths = high - low
    first = (int(at.min()) - int(places.max())) // width - 1
    counts = np.zeros((int(at.max()) - int(places.min())) // width - first + 1, np.int64)
    upto = np.cumsum(lengths)
    begin = 0
    while begin < len(ids):
        done = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, done + _ROWS, side="right")))
        n = lengths[begin:end]
        row = np.repeat(low[begin:end] - np.cumsum(n) + n, n) + np.arange(n.sum())
        who, place = np.repeat(np.arange(begin, end), n), np.repeat(places[begin:end], n)
        # Both ends of each cell, in order: numbers rise within a place of the item.
        band = np.stack([(e[row] - place) // width - first for e in ends], axis=1).ravel()
        who = np.repeat(who, 2)
        apart = np.r_[True, who[1:] != who[:-1]]
        fresh = apart | np.r_[True, band[1:] != band[:-1]]
        band, apart = band[fresh], apart[fresh]
        lower = apart | np.r_[True, band[1:] - band[:-1] > 1]
        counts += np.bincount(band, minlength=len(counts)) + np.bincount(band[lower] - 1, minlength=len(counts))
        begin = end
    return first, counts


def passages(documents: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, start, end, edits, shared_qgrams: every occurrence of a benchmark item in a document (doc_id, text).

    Case and runs of white space don't count; start and end are code points of the text. An item may differ by
    a tenth of its characters. Overlapping occurrences of one item count once, as the one with the
    fewest edits. Items of fewer than eight characters, null or blank ones match nothing, as do null and empty texts. Repeated
    rows are compared row by row, repeated items give their rows again; null ids stay null. An empty table gives no rows.
    Further columns are left out. Long and repetitive texts take memory in proportion to their length.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("length(text) >= 1")
    docs = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNotNull().alias("known"),
        F.col("text").cast("string").alias("text"),
    )
    schema = "doc_id long, known boolean, item_id long, start long, end long, edits long, shared_qgrams long, named boolean"

    def matcher(block: list[tuple[int | None, str]]):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index = _Index(block, error_rate)
            for batch in batches:
                rows = []
                if len(index.ids):
                    for doc_id, known, text in zip(batch["doc_id"], batch["known"], batch["text"]):
                        for item, *rest in _matches(index, text):
                            name = index.ids[item]
                            rows.append((doc_id, known, name or 0, *rest, name is not None))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

        return run

    out, block, size = None, [], 0
    for row in items.toLocalIterator():
        if block and size + len(row["text"]) > block_chars:
            part = docs.mapInPandas(matcher(block), schema)
            out, block, size = part if out is None else out.union(part), [], 0
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
    part = docs.mapInPandas(matcher(block), schema)
    out = part if out is None else out.union(part)
    return out.select(
        F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), F.when(F.col("named"), F.col("item_id")).alias("item_id"), "start", "end", "edits", "shared_qgrams"
    )


def _matches(index: _Index, text: str | None) -> list[tuple[int, int, int, int, int]]:
    if not isinstance(text, str):
        return []
    codes, places = normalized(text)
    found: dict[int, list] = {}
    for item, low, shared in index.regions(codes):
        k, m = index.k[item], index.m[item]
        # Diagonals low .. low + 2k + 1 start the item; k more on either side are reachable by edits.
        a, b = max(0, low - k), min(len(codes), low + 2 * k + 1 + m + k)
        found.setdefault(item, []).append((a, b, shared))
    out = []
    for item, regions in found.items():
        k = int(index.k[item])
        text, best, seen = index.texts[item], [], {}
        for a, b, shared in sorted(set(regions)):
            seen.setdefault(codes[a:b].tobytes(), []).append((a, shared))
        # Regions of the same characters, as repeats have them, are compared once.
        left = []
        for key, places_of in seen.items():
            s = _verbatim(text, np.frombuffer(key, codes.dtype))
            if s >= 0:
                best += [(0, a + s, a + s + len(text), shared) for a, shared in places_of]
            else:
                left.append(key)
        for at in range(0, len(left), _REGIONS):
            part = left[at : at + _REGIONS]
            for key, (cost, s, e) in zip(part, _align(text, [np.frombuffer(x, codes.dtype).astype(np.int64) for x in part], 4 * k + 2)):
                if cost <= k:
                    best += [(cost, a + s, a + e, shared) for a, shared in seen[key]]
        best.sort()
        # Taken occurrences do not overlap: only the neighbours of a new one can.
        starts: list[int] = []
        ends: list[int] = []
        for cost, s, e, shared in best:
            i = bisect_left(starts, s)
            if (i == 0 or ends[i - 1] <= s) and (i == len(starts) or starts[i] >= e):
                starts.insert(i, s), ends.insert(i, e)
                out.append((item, int(places[s]), int(places[e - 1]) + 1, cost, shared))
    return out
