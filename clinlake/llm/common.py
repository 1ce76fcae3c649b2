"""Helpers of the operators: tables, the shared folder, hashes of words and shingles."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

WORD_CHUNK_BYTES = 1 << 20
SHINGLE_WORDS = 5
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_WORD_BASE, _SHINGLE_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of its own where that is unset and the master is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="clinlake-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it again: lineage ends here, and a lost executor loses nothing."""
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def process_cache() -> dict:
    """A dictionary that lives as long as the Python process; functions sent by value have no lasting globals."""
    return sys.modules.setdefault("_clinlake_cache", types.ModuleType("_clinlake_cache")).__dict__


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _byte_table() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _WORD_BASE)


def _chunks(buffer: np.ndarray, space: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut a buffer that ends in white space into chunks that end in white space."""
    at, n = 0, len(buffer)
    while at < n:
        end = min(at + WORD_CHUNK_BYTES, n)
        while end < n and not space[end - 1]:
            step = space[end : end + WORD_CHUNK_BYTES]
            end += int(step.argmax()) + 1 if step.any() else len(step)
        yield at, end
        at = end


def word_hashes(texts: list[str | None], prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """64-bit hashes of all words ([^\\x20\\x09-\\x0D]+, A-Z lower-cased) of the texts, and each text's number of words.

    With `prefixes`, a third result has a row of hashes for each length: of the words' first bytes.
    """
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum(np.fromiter((len(e) + 1 for e in encoded), np.int64, len(encoded)))
    buffer = np.frombuffer(b" ".join(encoded) + b" ", np.uint8).copy() if encoded else np.zeros(0, np.uint8)
    if len(buffer):
        buffer[(buffer >= 65) & (buffer <= 90)] += 32
    space = (buffer == 32) | ((buffer >= 9) & (buffer <= 13))
    letters, hashes, heads, starts_all = _byte_table(), [], [], []
    for a, b in _chunks(buffer, space):
        part, blank = buffer[a:b], space[a:b]
        before = np.concatenate(([True], blank[:-1]))
        starts = np.flatnonzero(~blank & before)
        if not len(starts):
            continue
        inside = np.flatnonzero(~blank)
        word = np.cumsum(before & ~blank)[inside] - 1
        place = inside - starts[word]
        powers = np.multiply.accumulate(np.full(int(place.max()) + 1, _WORD_BASE | np.uint64(5), np.uint64))
        values = letters[part[inside]] * powers[place]
        first = np.searchsorted(inside, starts)
        hashes.append(mix(np.add.reduceat(values, first)))
        heads.append([mix(np.add.reduceat(np.where(place < n, values, np.uint64(0)), first) + np.uint64(n)) for n in prefixes])
        starts_all.append(starts + a)
    words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    where = np.concatenate(starts_all) if starts_all else np.zeros(0, np.int64)
    upto = np.searchsorted(where, ends)
    counts = np.diff(upto, prepend=0)
    if not prefixes:
        return words, counts
    return words, counts, np.concatenate(heads, axis=1) if heads else np.zeros((len(prefixes), 0), np.uint64)


def shingle_sets(texts: list[str | None], width: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its word shingles.

    With fewer words the whole sequence is one shingle; without words the set is empty.
    """
    words, counts = word_hashes(texts)
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for i in range(width):
        rolled = rolled * _SHINGLE_BASE + words[i : len(words) - width + 1 + i] if len(rolled) else rolled
    rolled = mix(rolled)
    sets, at = [], 0
    for n in counts.tolist():
        if n >= width:
            sets.append(np.unique(rolled[at : at + n - width + 1]))
        elif n:
            h = np.uint64(n)
            with np.errstate(over="ignore"):
                for w in words[at : at + n]:
                    h = h * _SHINGLE_BASE + w
            sets.append(mix(np.array([h ^ _M1], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += n
    return sets
