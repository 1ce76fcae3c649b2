"""Phrase collocations from counts in burstable hash containers.

A task keeps its counts in a shallow trie over word ids: a container is a hash table of phrases; one that grows beyond
its size bursts into containers by the next bits of the ids. When the task's tables are full, whole subtrees are written out as sorted runs
and freed. The runs are dealt by ranges of phrases, so that each partition holds the runs of some prefixes, and merged there.
Words and pairs are counted first. Triples are counted in a second pass, where both pairs are frequent: a
bit map of the frequent pairs, of bounded size, leaves out most others, and the merge drops those that it lets through.
"""

from __future__ import annotations

import itertools
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import mix, stage

MIN_COUNT = 10
TOP = 2000
INSIDE_PCT = 50
#: A container with more phrases bursts; a task with more phrases writes subtrees out until half of them are gone.
BURST = 16384
MAX_PHRASES = 1_200_000
#: Words are numbered anew when a task has met this many, or this many bytes of them.
MAX_WORDS, MAX_WORD_BYTES = (1 << 21) - 2, 64 << 20
#: Text is read in chunks of about this many bytes.
CHUNK_BYTES = 1 << 20
ROWS_PER_BATCH = 100_000
#: The bit map has some bits for each frequent pair, at most 2^28 (32 MB): with more pairs it lets more triples through.
BITS_PER_PAIR, MOST_BITS = 16, 28
_ID_BITS = 21
_PLACES = (2 * _ID_BITS, _ID_BITS, 0)
_BLOCK_BITS = 15
#: A level of the trie takes this many bits of the word ids, a third of a word; no node is deeper than two words.
_STEP_BITS, DEEPEST = 7, 6


def _letters() -> bytes:
    """Bytes of text to bytes in which all ends of pieces are line feeds and all gaps spaces, A-Z in lower case."""
    table = bytearray(range(256))
    for b in range(65, 91):
        table[b] = b + 32
    for b in b".,;:!?\x0a\x0b\x0c\x0d":
        table[b] = 10
    table[9] = 32
    return bytes(table)


class Words(dict):
    """Numbers of words, from 1; 0 ends a piece and -1 is nothing. Their hashes are kept beside them."""

    def __init__(self) -> None:
        super().__init__({b"": -1, b"\n": 0})
        self.names, self.hashes, self.n_bytes = [b""], array("Q", [0]), 0

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.names)
        self.names.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        self.n_bytes += len(word)
        return n


class Trie:
    """A node: a hash container of phrases with their counts, or, once burst, children by the next bits of the word ids."""

    __slots__ = ("depth", "table", "children")

    def __init__(self, depth: int = 0):
        self.depth, self.table, self.children = depth, {}, None

    def add(self, keys: np.ndarray, counts: np.ndarray, burst: int) -> int:
        """Add sorted distinct keys; gives how many were new."""
        if self.children is not None:
            return self._deal(keys, counts, burst)
        table = self.table
        before = len(table)
        for key, n in zip(keys.tolist(), counts.tolist()):
            table[key] = table.get(key, 0) + n
        new = len(table) - before
        if len(table) > burst and self.depth < DEEPEST:
            held = self.arrays()
            order = np.argsort(held[0])
            self.table, self.children = {}, {}
            self._deal(held[0][order], held[1][order], burst)
        return new

    def _deal(self, keys: np.ndarray, counts: np.ndarray, burst: int) -> int:
        words = keys >> 63 - _STEP_BITS * (self.depth + 1)
        cuts = [0, *(np.flatnonzero(np.diff(words)) + 1).tolist(), len(keys)]
        new = 0
        for a, b, word in zip(cuts, cuts[1:], words[cuts[:-1]].tolist()):
            child = self.children.get(word)
            if child is None:
                child = self.children[word] = Trie(self.depth + 1)
            new += child.add(keys[a:b], counts[a:b], burst)
        return new

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """All phrases below this node and their counts."""
        tables = [node.table for node in self._containers()]
        n = sum(map(len, tables))
        keys = np.fromiter(itertools.chain.from_iterable(tables), np.int64, n)
        return keys, np.fromiter(itertools.chain.from_iterable(t.values() for t in tables), np.int64, n)

    def _containers(self) -> Iterator[Trie]:
        if self.children is None:
            yield self
        else:
            for child in self.children.values():
                yield from child._containers()

    def size(self) -> int:
        return sum(len(node.table) for node in self._containers())


class Counter:
    """Counts of a task: a trie for each language, fed with streams of text, emptied as sorted runs."""

    def __init__(self, sizes: tuple[int, ...], pairs: np.ndarray | None, max_phrases: int, burst: int):
        self.sizes, self.pairs, self.max_phrases, self.burst = sizes, pairs, max_phrases, burst
        self.letters, self.words, self.tries, self.held = _letters(), Words(), {}, 0

    def feed(self, lang: str, texts: list[str]) -> Iterator[pa.RecordBatch]:
        data = "\n".join(texts).encode("utf-8", "surrogatepass").translate(self.letters)
        at, carry = 0, np.zeros(0, np.int64)
        while at < len(data):
            end = len(data)
            if end - at > CHUNK_BYTES:
                # A chunk ends behind a gap; a word longer than a chunk stays whole.
                found = max(data.rfind(b" ", at, at + CHUNK_BYTES), data.rfind(b"\n", at, at + CHUNK_BYTES))
                if found < at:
                    found = min((p for p in (data.find(b" ", at), data.find(b"\n", at)) if p >= 0), default=len(data) - 1)
                end = found + 1
            ids = np.fromiter(map(self.words.__getitem__, data[at:end].replace(b"\n", b" \n ").split(b" ")), np.int64)
            at, ids = end, ids[ids >= 0]
            self._count(lang, np.concatenate([carry, ids]), len(carry))
            carry = np.concatenate([carry, ids])[-2:]
            if self.held > self.max_phrases:
                yield from self._write(self.held // 2)
            if len(self.words.names) > MAX_WORDS - CHUNK_BYTES or self.words.n_bytes > MAX_WORD_BYTES:
                # New numbers from here on; those in the carry are kept.
                names = [self.words.names[i] if i else b"\n" for i in carry.tolist()]
                yield from self._write(0)
                self.words = Words()
                carry = np.array([self.words[w] for w in names], np.int64)

    def _count(self, lang: str, ids: np.ndarray, known: int) -> None:
        """Count the phrases whose last word is not among the first `known`."""
        for size in self.sizes:
            first = max(0, known - size + 1)
            windows = len(ids) - first - size + 1
            if windows <= 0:
                continue
            parts = [ids[first + i : first + i + windows] for i in range(size)]
            whole = np.all([p > 0 for p in parts], axis=0)
            if size == 3 and self.pairs is not None:
                hashes = np.array(self.words.hashes)
                for a, b in (parts[:2], parts[1:]):
                    at = pair_places(lang, hashes[a], hashes[b], len(self.pairs) * 8)
                    whole &= (self.pairs[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            key = np.zeros(int(whole.sum()), np.int64)
            for i, part in enumerate(parts):
                key |= part[whole] << _PLACES[i]
            if len(key):
                keys, counts = np.unique(key, return_counts=True)
                self.held += self.tries.setdefault(lang, Trie()).add(keys, counts, self.burst)

    def _write(self, keep: int) -> Iterator[pa.RecordBatch]:
        """Write out and free whole subtrees, largest first, until at most `keep` phrases are held."""
        branches = []
        for lang, root in self.tries.items():
            inner = root.children.items() if root.children is not None else [(None, root)]
            branches += [(node.size(), lang, word, node) for word, node in inner]
        branches.sort(key=lambda b: -b[0])
        names, mask = pa.array(self.words.names, pa.binary()).cast(pa.string()), (1 << _ID_BITS) - 1
        chosen: dict[str, list[Trie]] = {}
        for size, lang, word, node in branches:
            if self.held <= keep:
                break
            self.held -= size
            chosen.setdefault(lang, []).append(node)
            if word is None:
                del self.tries[lang]
            else:
                del self.tries[lang].children[word]
        for lang in sorted(chosen):
            held = [node.arrays() for node in chosen.pop(lang)]
            keys, counts = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(keys)
            keys, counts = keys[order], counts[order]
            ids = [keys >> _PLACES[0], keys >> _ID_BITS & mask, keys & mask]
            for size in self.sizes:
                which = np.flatnonzero(sum(i > 0 for i in ids) == size)
                for a in range(0, len(which), ROWS_PER_BATCH):
                    at = which[a : a + ROWS_PER_BATCH]
                    phrase = pc.binary_join_element_wise(*[names.take(pa.array(i[at])) for i in ids[:size]], " ")
                    columns = [pa.array([lang]).take(pa.array(np.zeros(len(at), np.int32))), phrase, pa.array(np.full(len(at), size, np.int32)), pa.array(counts[at])]
                    yield pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], ["lang", "phrase", "size", "f"])

    def close(self) -> Iterator[pa.RecordBatch]:
        yield from self._write(0)


def pair_places(lang: str, first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """Places in the bit map of pairs of words, given by their hashes."""
    start = np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")))
    return mix(mix(first ^ start) * np.uint64(0x9E3779B97F4A7C15) + second) & np.uint64(bits - 1)


def _counts(rows: DataFrame, sizes: tuple[int, ...], pairs: object, max_phrases: int, burst: int) -> DataFrame:
    """Sorted runs of the phrases of these sizes, as tasks wrote them: lang, phrase, size, f."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(sizes, None if pairs is None else np.frombuffer(pairs.value, np.uint8), max_phrases, burst)
        for batch in batches:
            texts: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, said in texts.items():
                yield from counter.feed(lang, said)
        yield from counter.close()

    return stage(rows.mapInArrow(run, "lang string, phrase string, size int, f long"), "runs")


def _merged(runs: DataFrame) -> DataFrame:
    """The runs merged, partition by partition: each holds a range of phrases. No further shuffle is needed."""
    dealt = runs.repartitionByRange("lang", "phrase")
    return dealt.groupBy("lang", "phrase").agg(F.first("size").alias("size"), F.sum("f").alias("f"))


def _pair_map(frequent: DataFrame, count: int) -> bytes:
    """The bit map of the frequent pairs (lang, phrase): at most 32 MB, made in blocks by Spark."""
    bits = 1 << min(MOST_BITS, max(_BLOCK_BITS, (count * BITS_PER_PAIR).bit_length()))

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, phrases in batch.groupby("lang")["phrase"]:
                words = [p.encode("utf-8", "surrogatepass").split(b" ") for p in phrases]
                hashes = np.array([[xxhash.xxh64_intdigest(w) for w in pair] for pair in words], np.uint64)
                at = np.unique(pair_places(lang, hashes[:, 0], hashes[:, 1], bits)).astype(np.int64)
                yield pd.DataFrame({"block": (at >> _BLOCK_BITS).astype(np.int32), "at": (at & ((1 << _BLOCK_BITS) - 1)).astype(np.int32)})

    def blocks(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros(1 << _BLOCK_BITS, np.uint8)
        held[rows["at"].to_numpy()] = 1
        return pd.DataFrame({"block": [key[0]], "bits": [np.packbits(held, bitorder="little").tobytes()]})

    each = frequent.select("lang", "phrase").mapInPandas(places, "block int, at int").distinct()
    whole = bytearray(bits // 8)
    for row in each.groupBy("block").applyInPandas(blocks, "block int, bits binary").toLocalIterator():
        size = 1 << _BLOCK_BITS - 3
        whole[row["block"] * size : (row["block"] + 1) * size] = row["bits"]
    return bytes(whole)


def _key(phrase: Column) -> Column:
    """One text of language and phrase, made for a join alone: adaptive execution can then split a hot one."""
    return F.concat("lang", F.lit("\n"), phrase)


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    """The first `top` rows of each language with their rank. Languages are numbered range by range, so that no task holds a whole one."""
    order = [F.col("lang"), F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    dealt = scored.repartitionByRange(*order).sortWithinPartitions(*order)

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, seen, part = None, 0, TaskContext.get().partitionId()
        for batch in batches:
            if len(batch):
                place = batch.groupby("lang").cumcount() + 1 + seen * (batch["lang"] == last)
                last, seen = batch["lang"].iloc[-1], int(place.iloc[-1])
                yield batch.assign(part=part, place=place)[place <= top]

    schema = "lang string, phrase string, a long, l long, r long, score long, part int, place long"
    numbered = stage(dealt.mapInPandas(number, schema), "ranked")
    held = numbered.groupBy("lang", "part").agg(F.max("place").alias("held"))
    before = held.alias("x").join(held.alias("y"), (F.col("x.lang") == F.col("y.lang")) & (F.col("y.part") < F.col("x.part")), "left")
    before = before.groupBy("x.lang", "x.part").agg(F.coalesce(F.sum("y.held"), F.lit(0)).alias("before"))
    ranked = numbered.join(before, ["lang", "part"]).withColumn("rank", F.col("before") + F.col("place"))
    return ranked.where(F.col("rank") <= top).drop("part", "place", "before")


def phrases(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    inside_pct: int = INSIDE_PCT,
    max_phrases: int = MAX_PHRASES,
    burst: int = BURST,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first phrases of two and three words of each language (lang, text).

    Texts are lower-cased (A-Z) and split at punctuation into pieces and at blanks into words; nothing crosses a piece, a row or a chunk
    of a long text is crossed as if it were whole. Counts are over all rows, repeated ones as often as they stand. Null languages are `und`, null and
    empty texts have no words. The score of a cut is exact to 38 digits (counts to 10^15); ties go to the higher count, then to the phrase
    in byte order. An empty table, or one without frequent phrases, gives no rows; further columns are left out.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    runs = _counts(rows, (1, 2), None, max_phrases, burst)
    words = runs.where("size = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    short = stage(_merged(runs).where(F.col("f") >= min_count), "short")
    frequent = short.where("size = 2")
    pairs = spark.sparkContext.broadcast(_pair_map(frequent, frequent.count()))
    long = stage(_merged(_counts(rows, (3,), pairs, max_phrases, burst)).where(F.col("f") >= min_count), "long")

    split = F.split("phrase", " ")
    inner = F.explode(F.array(F.array_join(F.slice(split, 1, 2), " "), F.array_join(F.slice(split, 2, 2), " ")))
    inside = long.select("lang", inner.alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = short.where("size = 2").join(inside, ["lang", "phrase"], "left")
    kept = kept.where(F.coalesce(100 * F.col("longer") < inside_pct * F.col("f"), F.lit(True))).drop("longer")
    candidates = kept.select("lang", "phrase", "size", F.col("f").alias("a")).unionByName(long.select("lang", "phrase", "size", F.col("f").alias("a")))

    cut = candidates.select("lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    head = F.array_join(F.slice(split, F.lit(1), F.col("k")), " ")
    tail = F.array_join(F.slice(split, F.col("k") + 1, F.col("size") - F.col("k")), " ")
    cut = cut.select("lang", "phrase", "a", "k", _key(head).alias("head"), _key(tail).alias("tail"))
    known = short.select(_key(F.col("phrase")).alias("key"), "f")
    cut = cut.join(known.select(F.col("key").alias("head"), F.col("f").alias("l")), "head")
    cut = cut.join(known.select(F.col("key").alias("tail"), F.col("f").alias("r")), "tail")
    # Integral division of whole decimals: no rounding before the floor.
    wide = "cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast(1000000 as decimal(7,0))"
    score = F.expr(f"cast({wide} div (cast(l as decimal(18,0)) * cast(r as decimal(18,0))) as long)")
    lowest = cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("least"))
    scored = stage(lowest.select("lang", "phrase", "a", "least.l", "least.r", "least.score"), "scored")
    return _ranked(scored, top).join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
