"""Packing of token sequences into few windows by a grouping genetic algorithm on islands.

Every text becomes ids and an end id. A text longer than a window is cut into windows; the rests are dealt to blocks of
bounded size. A block is packed by several islands. An individual is a grouping of the block's rests into windows; crossover
injects whole well-filled windows of one parent into the other, removes the windows that hold a document twice, and
places the displaced documents by best fit. After each epoch every island gets the best individual of the one before it.
A block ends when it needs no more windows than its tokens do. Windows that stay open are dissolved and packed once
more, over all blocks.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import stage
from clinlake.llm.packing import token_encoder

CAPACITY = 4096
END_ID = 1
#: Documents in a block, on average: what one task packs at a time.
ROWS_PER_BLOCK = 4096
ISLANDS = 3
EPOCHS = 4
GENERATIONS = 40
INDIVIDUALS = 6
#: At most this share of a parent's windows is injected, and this share of a child's is dissolved by a mutation.
INJECTED = 0.1
DISSOLVED = 0.2
#: A window emptier than this is dissolved and its documents are packed once more with those of other blocks.
CLOSED = 0.995


def best_fit(items: Iterable[int], lengths: list[int], bin_of: np.ndarray, rooms: np.ndarray, capacity: int) -> None:
    """Put the items, in their order, each into the window with the least room that suffices, or into a new one.

    Windows are kept by their room; a bit mask over rooms finds the least one that suffices.
    """
    by_room: dict[int, list[int]] = {}
    for b, room in enumerate(rooms.tolist()):
        by_room.setdefault(room, []).append(b)
    mask, n = 0, len(rooms)
    for room in by_room:
        mask |= 1 << room
    for i in items:
        length = lengths[i]
        enough = mask >> length
        if enough:
            room = length + (enough & -enough).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
        else:
            room, b, n = capacity, n, n + 1
        bin_of[i] = b
        mask |= 1 << (room - length)
        by_room.setdefault(room - length, []).append(b)


class Block:
    """The lengths of a block's documents, longest first, and the operations on groupings of them (a window number for each)."""

    def __init__(self, lengths: np.ndarray, capacity: int, rng: np.random.Generator):
        self.lengths, self.capacity, self.rng = lengths.astype(np.int64), capacity, rng
        self.as_list = self.lengths.tolist()
        self.bound = max(-(-int(self.lengths.sum()) // capacity), int((self.lengths * 2 > capacity).sum()))

    def fills(self, grouping: np.ndarray) -> np.ndarray:
        return np.bincount(grouping, weights=self.lengths).astype(np.int64)

    def fitness(self, grouping: np.ndarray) -> tuple[int, float]:
        """Fewer windows first, then fuller ones beside emptier ones."""
        share = self.fills(grouping) / self.capacity
        return -len(share), float((share**2).mean())

    def random(self) -> np.ndarray:
        grouping = np.zeros(len(self.lengths), np.int64)
        best_fit(self.rng.permutation(len(grouping)).tolist(), self.as_list, grouping, np.zeros(0, np.int64), self.capacity)
        return grouping

    def _without(self, grouping: np.ndarray, gone: np.ndarray, injected: np.ndarray | None = None) -> np.ndarray:
        """The grouping without the windows `gone`, with the injected ones (-1: none), their other documents placed by best fit."""
        kept = np.cumsum(~gone) - 1
        child = np.where(gone[grouping], -1, kept[grouping])
        windows = int((~gone).sum())
        if injected is not None:
            child = np.where(injected >= 0, windows + injected, child)
            windows = max(windows, int(child.max()) + 1)
        placed = child >= 0
        rooms = self.capacity - np.bincount(child[placed], weights=self.lengths[placed], minlength=windows).astype(np.int64)
        best_fit(np.flatnonzero(~placed).tolist(), self.as_list, child, rooms, self.capacity)
        return child

    def cross(self, into: np.ndarray, giver: np.ndarray) -> np.ndarray:
        """Inject some of the giver's better filled windows; windows that hold one of their documents go."""
        fills = self.fills(giver)
        good = np.argsort(-fills, kind="stable")[: max(1, len(fills) // 2)]
        some = self.rng.choice(good, size=int(self.rng.integers(1, max(1, int(len(fills) * INJECTED)) + 1)), replace=False)
        number = np.full(len(fills), -1)
        number[some] = np.arange(len(some))
        injected = number[giver]
        gone = np.zeros(int(into.max()) + 1, bool)
        gone[into[injected >= 0]] = True
        return self._without(into, gone, injected)

    def mutate(self, grouping: np.ndarray) -> np.ndarray:
        """Dissolve the emptiest windows and some others."""
        fills = self.fills(grouping)
        gone = self.rng.random(len(fills)) < DISSOLVED / 2
        gone[np.argsort(fills, kind="stable")[: max(2, int(len(fills) * DISSOLVED / 2))]] = True
        return self._without(grouping, gone)

    def evolve(self, population: list[np.ndarray], generations: int) -> list[np.ndarray]:
        """The population after some generations, the best first; it ends where the lower bound is reached."""
        ranked = sorted(((self.fitness(g), i, g) for i, g in enumerate(population)), key=lambda x: (x[0], -x[1]), reverse=True)
        for turn in range(generations):
            if -ranked[0][0][0] <= self.bound or len(self.lengths) < 2:
                break
            first, second = (min(self.rng.integers(0, len(ranked), 2)) for _ in range(2))
            child = self.cross(ranked[first][2], ranked[second][2])
            if self.rng.random() < 0.5:
                child = self.mutate(child)
            score = self.fitness(child)
            if score > ranked[-1][0]:
                ranked[-1] = (score, len(population) + turn, child)
                ranked.sort(key=lambda x: (x[0], -x[1]), reverse=True)
        return [g for _, _, g in ranked]


def _stored(grouping: np.ndarray) -> bytes:
    return grouping.astype("<u4").tobytes()


def _read(stored: bytes) -> np.ndarray:
    return np.frombuffer(stored, "<u4").astype(np.int64)


def _evolved(state: DataFrame, capacity: int, generations: int, individuals: int, seed: int) -> DataFrame:
    """One epoch of every island: block, island, lengths, its population, best first, and the best one's windows and fitness."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for block, island, lengths, population, guest in zip(*(batch[c] for c in ("block", "island", "lengths", "population", "guest"))):
                held = Block(np.asarray(lengths), capacity, np.random.default_rng([seed, int(block), int(island)]))
                groups = [_read(g) for g in population] or [held.random() for _ in range(individuals)]
                if guest is not None:
                    groups[-1] = _read(guest)
                groups = held.evolve(groups, generations)
                windows, fitness = held.fitness(groups[0])
                out.append((block, island, lengths, [_stored(g) for g in groups], -windows, fitness, -windows <= held.bound))
            yield pd.DataFrame(out, columns=["block", "island", "lengths", "population", "windows", "fitness", "done"])

    schema = "block long, island int, lengths array<int>, population array<binary>, windows long, fitness double, done boolean"
    return state.mapInPandas(run, schema)


def _packed(rests: DataFrame, capacity: int, rows_per_block: int, islands: int, epochs: int, generations: int, individuals: int, level: int) -> tuple[DataFrame, int]:
    """uid, block, window, offset, fill of each rest (uid, length), and the number of blocks."""
    blocks = max(1, -(-rests.count() // rows_per_block))
    dealt = rests.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(blocks)))
    # A block holds a bounded number of rests, whatever the documents are.
    grouped = dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("length", "uid")), asc=False).alias("held"))
    groups = stage(grouped.select("block", "held.length", "held.uid"), "blocks")
    tasks = min(blocks * islands, 4 * rests.sparkSession.sparkContext.defaultParallelism)
    island = F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island")
    state = groups.select("block", island, F.col("length").alias("lengths"))
    state = state.withColumns({"population": F.expr("cast(array() as array<binary>)"), "guest": F.lit(None).cast("binary")})
    for epoch in range(epochs):
        seed = 1 + epoch + level * epochs
        state = stage(_evolved(state.repartition(tasks, "block", "island"), capacity, generations, individuals, seed), "islands")
        if epoch + 1 == epochs or state.where("not done").isEmpty():
            break
        # The elite of an island moves to the next one of its block.
        elite = state.select("block", ((F.col("island") + 1) % islands).alias("island"), F.get("population", F.lit(0)).alias("guest"))
        state = state.drop("windows", "fitness", "done").join(elite, ["block", "island"])
    best = F.max(F.struct(-F.col("windows"), "fitness", -F.col("island"), F.get("population", F.lit(0)).alias("grouping")))
    best = state.groupBy("block").agg(best.alias("best")).select("block", "best.grouping")

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, uids, lengths, grouping in zip(batch["block"], batch["uid"], batch["length"], batch["grouping"]):
                windows, lengths = _read(grouping), np.asarray(lengths, np.int64)
                order = np.argsort(windows, kind="stable")
                ends = np.cumsum(lengths[order])
                firsts = np.flatnonzero(np.diff(windows[order], prepend=-1))
                starts = ends - lengths[order]
                offset = starts - np.repeat(starts[firsts], np.diff(firsts, append=len(order)))
                fill = np.bincount(windows, weights=lengths).astype(np.int64)
                yield pd.DataFrame(
                    {"uid": np.asarray(uids)[order], "block": block, "window": windows[order], "offset": offset, "fill": fill[windows[order]]}
                )

    schema = "uid long, block long, window long, offset long, fill long"
    return stage(groups.join(best, "block").mapInPandas(places, schema), "places"), blocks


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    rows_per_block: int = ROWS_PER_BLOCK,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    generations: int = GENERATIONS,
    individuals: int = INDIVIDUALS,
) -> DataFrame:
    """One row per piece of a document (doc_id, text): its number, start, length and checksum, its window and place there.

    Only documents longer than a window are cut. Null and empty texts are the end id alone. Repeated rows and null ids
    are packed row by row; equal lengths are told apart by an own number of each piece, so ties are settled. A very
    long text is encoded whole, by one task. An empty table gives no rows; further columns are left out, whatever
    their names. `with_ids` adds the ids themselves.
    """
    # Null ids travel as a flag: pandas would turn a column of numbers and nulls into floats.
    schema = "doc_id long, known boolean, piece int, start long, length int, ids_crc32 long, uid long" + ", ids binary" * with_ids

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, uid = token_encoder(tokenizer_path), TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for doc_id, known, text in zip(batch["doc_id"], batch["known"], batch["text"]):
                ids = np.append(encode(text) if isinstance(text, str) else np.zeros(0, np.uint32), np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity].tobytes()
                    rows.append((doc_id, known, piece, start, len(part) // 4, zlib.crc32(part), uid) + (part,) * with_ids)
                    uid += 1
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNotNull().alias("known"),
        F.col("text").cast("string").alias("text"),
    )
    pieces = stage(rows.mapInPandas(cut, schema), "pieces")
    settings = (capacity, rows_per_block, islands, epochs, generations, individuals)
    # A full piece is a window of its own and needs no packing.
    rests = pieces.where(F.col("length") < capacity).select("uid", "length")
    placed, blocks = _packed(rests, *settings, level=0)
    number = (F.col("block") * F.lit(1 << 24) + F.col("window")) * F.lit(2)
    closed = placed.select("uid", number.alias("sequence_id"), "offset", (F.col("fill") >= CLOSED * capacity).alias("closed"))
    if blocks > 1:
        again = rests.join(placed.where(F.col("fill") < CLOSED * capacity).select("uid"), "uid")
        second, _ = _packed(again, *settings, level=1)
        closed = closed.where("closed").drop("closed").unionByName(second.select("uid", (number + 1).alias("sequence_id"), "offset"))
    else:
        closed = closed.drop("closed")
    own = F.coalesce("sequence_id", -F.col("uid") - 1).alias("sequence_id")
    out = pieces.join(closed, "uid", "left").withColumn("doc_id", F.when(F.col("known"), F.col("doc_id")))
    shown = ["doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", own]
    return out.select(*shown, F.coalesce("offset", F.lit(0).cast("long")).alias("offset"), *["ids"] * with_ids)
