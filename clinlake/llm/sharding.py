"""Shards of bounded size by extendible hashing.

Documents hash to 60 bits. A directory over the leading bits begins with one shard; a shard over its byte limit splits on one more
bit, others stay, until every shard fits. What that process ends with follows from sums alone: the shard of a prefix
cell is its shortest prefix whose bytes fit. Sums are taken over cells far finer than shards, in Spark; only rows in cells that are still too large
go into another round on deeper bits, and rows with equal hashes go by their place in the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import stage

BYTE_LIMIT = 64 << 20
#: The limit of the query, at which the smallest of the given tables splits too.
QUERY_BYTE_LIMIT = 256 << 10
HASH_BITS = 60
#: Bits that a round adds beyond those an even spread would need.
SPARE_BITS = 3
#: Cells are broadcast only when counted below this.
BROADCAST_CELLS = 1_000_000


def key_hash() -> Column:
    """The leading 60 bits of the digest of id and text."""
    key = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x02")) for c in ("doc_id", "text")])
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def hashed(documents: DataFrame) -> DataFrame:
    """Staged row, doc_id, n_bytes (of the text) and hash."""
    size = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("n_bytes"), key_hash().alias("hash"))
    return stage(rows.withColumn("row", F.monotonically_increasing_id()), "hashed")


def _leaves(rows: DataFrame, depth: int, limit: int) -> DataFrame:
    """For each cell of `depth` bits below a prefix its shard's depth: the shortest one that fits, else null."""
    cells = rows.groupBy("prefix", "cell").agg(F.sum("n_bytes").alias("bytes"))
    # Each cell counts towards all prefixes of its own bits; sums are combined before the shuffle.
    up = cells.select("prefix", "cell", "bytes", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("d"))
    up = up.withColumn("node", F.expr(f"shiftright(cell, {depth} - d)"))
    fit = up.groupBy("prefix", "d", "node").agg(F.sum("bytes").alias("all")).where(F.col("all") <= limit).select("prefix", "d", "node")
    short = up.join(fit, ["prefix", "d", "node"]).groupBy("prefix", "cell").agg(F.min("d").alias("d"))
    return cells.join(short, ["prefix", "cell"], "left").select("prefix", "cell", "d")


def _bits(value: str, count: str) -> str:
    return f"case when {count} = 0 then '' else lpad(bin({value}), {count}, '0') end"


def shards(documents: DataFrame, byte_limit: int = BYTE_LIMIT) -> DataFrame:
    """doc_id, n_bytes, hash, shard (its leading bits, as text), depth: one row per document (doc_id, text).

    No shard holds more than `byte_limit` bytes of text. A document larger than that is set apart in a shard of its own, named by all its
    bits and its row after a `!`. Null texts have no bytes; null ids hash like any. Repeated rows hash alike: where
    they alone exceed the limit, the name goes on, after a dot, with bits hashed from the row. An empty table gives no rows; further columns are left out.
    """
    staged = hashed(documents)
    total = staged.agg(F.sum("n_bytes")).first()[0] or 0
    spare = max(1, -(-total // byte_limit)).bit_length() + SPARE_BITS
    alone = F.expr(f"concat(lpad(bin(hash), {HASH_BITS}, '0'), '!', row)")
    done = [staged.where(F.col("n_bytes") > byte_limit).select("doc_id", "n_bytes", "hash", alone.alias("shard"), F.lit(HASH_BITS).alias("depth"))]
    rest = staged.where(F.col("n_bytes") <= byte_limit).select("*", F.lit("").alias("prefix"), F.lit(0).alias("depth"), F.col("hash").alias("route"))
    left, by_row = HASH_BITS, False
    while True:
        take = min(left, spare)
        left -= take
        rest = rest.withColumn("cell", F.expr(f"shiftright(route, {left}) & {(1 << take) - 1}L"))
        cells = stage(_leaves(rest, take, byte_limit), "cells")
        if cells.count() <= BROADCAST_CELLS:
            cells = F.broadcast(cells)
        found = rest.join(cells, ["prefix", "cell"])
        name = F.expr(f"concat(prefix, {_bits(f'shiftright(cell, {take} - d)', 'd')})")
        done.append(found.where("d is not null").select("doc_id", "n_bytes", "hash", name.alias("shard"), (F.col("depth") + F.col("d")).alias("depth")))
        if not cells.where("d is null").limit(1).count():
            break
        mark = "." if left == 0 and not by_row else ""
        longer = F.expr(f"concat(prefix, {_bits('cell', str(take))}, '{mark}')")
        rest = stage(found.where("d is null").select("row", "doc_id", "n_bytes", "hash", longer.alias("prefix"), (F.col("depth") + take).alias("depth"), "route"), "rest")
        if left == 0 and by_row:
            done.append(rest.select("doc_id", "n_bytes", "hash", F.concat("prefix", F.lit("!"), "row").alias("shard"), "depth"))
            break
        if left == 0:
            rest = rest.withColumn("route", F.expr(f"shiftrightunsigned(xxhash64(row), {64 - HASH_BITS})"))
            left, by_row = HASH_BITS, True
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


def directory(placed: DataFrame) -> DataFrame:
    """shard, depth, shard_documents, shard_bytes: one row per shard of `shards`, none for an empty table."""
    sums = F.count("*").alias("shard_documents"), F.sum("n_bytes").alias("shard_bytes")
    return placed.groupBy("shard").agg(F.max("depth").alias("depth"), *sums)


def with_directory(documents: DataFrame, byte_limit: int = BYTE_LIMIT) -> DataFrame:
    """The rows of `shards` with the number of documents and bytes that the directory has for their shard."""
    placed = stage(shards(documents, byte_limit), "placed")
    entries = stage(directory(placed).drop("depth"), "directory")
    if entries.count() <= BROADCAST_CELLS:
        entries = F.broadcast(entries)
    return placed.join(entries, "shard")
