"""Packing of token sequences into windows by minimum bin slack.

Every text becomes ids and an end id; runs of `capacity` ids are windows of their own, and the rests
are packed. The rests are dealt to buckets of bounded size. In a bucket the multiset of lengths is a
table of counts; a subset-sum dynamic program over bitsets, seeded with the longest rest, finds the
multiset that fills a window closest to its capacity, backtracking gives the counts, and the pattern
is repeated as often as the counts allow.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import process_cache, stage

CAPACITY = 2048
END_ID = 1
ROWS_PER_BUCKET = 8192

# The settings of the tokenizer family whose merges `_merge_encoder` runs.
_FAMILY_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_FAMILY_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
# Letters and digits of Latin-1, lower case; texts within Latin-1 are in normal form already.
_LETTER, _DIGIT = r"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe"
_LATIN_WORDS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTER}]+|[{_DIGIT}]|[^\s{_LETTER}{_DIGIT}]+")
_LATIN_TEXT = re.compile(r"[\x01-\x1b\x20-\x7e\xa1-\xff]*")
_END = "\0"


def fill_windows(counts: dict[int, int], capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """Patterns (length: count) that fill windows closest to capacity, each with its number of repeats."""
    left = {n: c for n, c in counts.items() if c}
    order = sorted(left)
    while order:
        seed = order[-1]
        room = capacity - seed
        mask, reach, steps = (1 << (room + 1)) - 1, 1, []
        for n in order[bisect_right(order, room) - 1 :: -1] if order[0] <= room else []:
            most = min(left[n] - (n == seed), room // n)
            if most <= 0:
                continue
            steps.append((n, most, reach))
            some, rest = 1, most
            while rest:
                take = min(some, rest)
                reach |= (reach << (n * take)) & mask
                rest, some = rest - take, some * 2
            if reach >> room & 1:
                break
        total, used = reach.bit_length() - 1, {seed: 1}
        for n, most, before in reversed(steps):
            take = next(k for k in range(most + 1) if total >= k * n and before >> (total - k * n) & 1)
            if take:
                used[n] = used.get(n, 0) + take
                total -= take * n
        repeats = min(left[n] // k for n, k in used.items())
        yield used, repeats
        for n, k in used.items():
            left[n] -= k * repeats
        order = [n for n in order if left[n]]


def _merge_encoder(path: str) -> Callable[[str], list[int]] | None:
    """Ids of Latin-1 texts through the same merges as byte ranks, many times faster; None for another family.

    The end of a word is one more byte. Merging it to the last letter comes first, then the merges
    in their order. Tests compare the ids with the tokenizer's own.
    """
    import tiktoken

    spec = json.load(open(path, encoding="utf-8"))
    model, pre, norm = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    split = (pre.get("pretokenizers") or [{}])[0]
    if (
        model.get("type") != "BPE"
        or model.get("end_of_word_suffix") != "</w>"
        or split.get("pattern", {}).get("Regex") != _FAMILY_PATTERN
        or [n["type"] for n in norm.get("normalizers", [])] != _FAMILY_NORMALIZERS
    ):
        return None
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(kept)]
    letter = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(other)}
    byte = {c: b for b, c in letter.items()}
    vocab, ranks, ids = model["vocab"], {}, []

    def put(piece: bytes, token: str) -> None:
        if piece not in ranks:
            ranks[piece] = len(ranks)
            ids.append(vocab[token])

    def raw(token: str) -> bytes:
        whole = token.removesuffix("</w>")
        return bytes(byte[c] for c in whole) + _END.encode() * (whole != token)

    for b in range(256):
        put(bytes([b]), letter[b])
    for b in range(256):
        put(bytes([b]) + _END.encode(), letter[b] + "</w>")
    for merge in model["merges"]:
        a, b = merge if isinstance(merge, list) else merge.split(" ")
        put(raw(a) + raw(b), a + b)
    merged = tiktoken.Encoding("merges", pat_str="[^\\x00]*\\x00", mergeable_ranks=ranks, special_tokens={})
    to_id, special = np.array(ids, np.uint32), [t["content"] for t in spec.get("added_tokens", [])]

    def encode(text: str) -> np.ndarray | None:
        if not _LATIN_TEXT.fullmatch(text) or any(s in text for s in special):
            return None
        words = _LATIN_WORDS.findall(text.lower())
        return to_id[merged.encode_ordinary(_END.join(words) + _END)] if words else np.zeros(0, np.uint32)

    return encode


def token_encoder(path: str) -> Callable[[str], np.ndarray]:
    """A function from text to ids, as tokenizers gives them without special tokens; one per process."""
    cache = process_cache()
    if ("tokens", path) not in cache:
        fast, slow = _merge_encoder(path), []

        def encode(text: str) -> np.ndarray:
            ids = fast(text) if fast else None
            if ids is None:
                if not slow:
                    from tokenizers import Tokenizer

                    slow.append(Tokenizer.from_file(path))
                ids = np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)
            return ids

        cache["tokens", path] = encode
    return cache["tokens", path]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One row per piece of a document (doc_id, text): where it starts, its length and checksum, its window and place there.

    Null and empty texts are the end id alone. Repeated rows and null ids are packed row by row. An
    empty table gives no rows; further columns are left out. `with_ids` adds the ids themselves. The pieces are staged. Whole
    windows go to no bucket, so a bucket holds one rest of a document at most, whatever its length, and the rests are counted.
    """
    # Null ids travel as a flag: pandas would turn a column of numbers and nulls into floats.
    schema = "doc_id long, known boolean, start long, length long, ids_crc32 long, doc_tokens long, slot long" + ", ids binary" * with_ids

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, slot, task = token_encoder(tokenizer_path), 0, TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for doc_id, known, text in zip(batch["doc_id"], batch["known"], batch["text"]):
                ids = np.append(encode(text) if isinstance(text, str) else np.zeros(0, np.uint32), np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity].tobytes()
                    dealt = zlib.crc32(b"%d %d" % (task, slot))
                    rows.append((doc_id, known, start, len(part) // 4, zlib.crc32(part), len(ids), dealt) + (part,) * with_ids)
                    slot += 1
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    def windows(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        lengths = rows["length"].to_numpy()
        by_length = {int(n): list(np.flatnonzero(lengths == n))[::-1] for n in np.unique(lengths)}
        window, offset, at = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), 0
        for used, repeats in fill_windows({n: len(x) for n, x in by_length.items()}, capacity):
            for _ in range(repeats):
                filled = 0
                for n, k in used.items():
                    for _ in range(k):
                        i = by_length[n].pop()
                        window[i], offset[i] = at, filled
                        filled += n
                at += 1
        rows["sequence_id"], rows["offset"] = ((int(key[0]) << 32) + window) * 2, offset
        return rows.drop(columns=["slot", "bucket"])

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNotNull().alias("known"),
        F.col("text").cast("string").alias("text"),
    )
    cut = stage(rows.mapInPandas(pieces, schema), "pieces")
    rests = cut.where(F.col("length") < capacity)
    buckets = max(1, -(-rests.count() // rows_per_bucket))
    out = schema.replace(", slot long", "") + ", sequence_id long, offset long"
    packed = rests.withColumn("bucket", F.col("slot") % buckets).groupBy("bucket").applyInPandas(windows, out)
    # Whole windows have odd numbers, the others even ones.
    numbered = cut.where(F.col("length") == capacity).withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1)
    packed = packed.unionByName(numbered.withColumn("offset", F.lit(0).cast("long")).drop("slot"))
    return packed.withColumn("doc_id", F.when(F.col("known"), F.col("doc_id"))).drop("known")
