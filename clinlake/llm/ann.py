"""Nearest neighbours by adaptive dimension scan.

Vectors are rotated at random, which spreads their length evenly over the dimensions, and assigned to the
nearest of a list of centroids fitted on a bounded sample. A query first scans its nearest list whole, which
bounds its tenth distance, then the other lists it probes. There candidates are scanned in blocks of columns: after each block
the partial distance is tested against the bound, and candidates that would exceed it with high probability are abandoned.
Survivors are measured exactly, on the original vectors in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import stage

K = 10
#: The centroids are fitted on at most this many vectors, those with the smallest hashes of their id.
SAMPLE_ROWS = 20_000
#: There are this times the square root of the rows lists, at most MAX_LISTS.
LISTS_PER_ROOT = 0.5
MAX_LISTS = 4096
#: The share of the lists that a query probes. Vectors without clusters need a half for a recall of 0.95; clustered ones a tenth.
PROBE_SHARE = 0.5
#: Lists it probes besides: in small tables, all.
MORE_PROBES = 24
#: A list is scanned in parts of about this many rows, so that a list with a third of all rows is many tasks.
ROWS_PER_PART = 4_000
BLOCK = 16
#: Pairs of a query and a row that are tested at once.
PAIRS = 200_000
#: The test errs on a true neighbour with a chance that falls with exp(-EPSILON ** 2).
EPSILON = 2.1


def rotation(dim: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(64).standard_normal((dim, dim)))[0]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = "forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    return v.where(f"vec_id is not null and vector is not null and {finite} and exists(vector, x -> x <> 0)")


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(1)
    distinct = np.unique(sample, axis=0)
    centers = distinct[rng.permutation(len(distinct))[:lists]]
    for _ in range(rounds):
        own = _closest(sample, centers, 1)[:, 0]
        order = np.argsort(own, kind="stable")
        found, first = np.unique(own[order], return_index=True)
        size = np.diff(first, append=len(own))
        centers[found] = np.add.reduceat(sample[order], first, axis=0) / size[:, None]
    return centers


def _closest(rows: np.ndarray, centers: np.ndarray, n: int) -> np.ndarray:
    """For each row the places of n nearest centers, the nearest first, the others in any order."""
    out = []
    for a in range(0, len(rows), 1024):
        d = (centers**2).sum(axis=1) - 2 * rows[a : a + 1024] @ centers.T
        nearest = d.argmin(axis=1)[:, None]
        if n > 1:
            np.put_along_axis(d, nearest, np.inf, axis=1)
            others = np.argpartition(d, n - 2, axis=1)[:, : n - 1]
            nearest = np.hstack([nearest, others])
        out.append(nearest)
    return np.concatenate(out) if out else np.zeros((0, n), int)


def scan_part(queries: np.ndarray, limits: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row), all rotated alike, whose squared distance is at most the query's limit, and some beyond it.

    All pairs are tested after the first block of columns, and after each further block those left: the partial
    distance, scaled up, against the limit with a margin for chance. Rounding never loses a pair.
    """
    dim = rows.shape[1]
    seen = min(BLOCK, dim)
    q, r = queries[:, :seen], rows[:, :seen]
    size = (q**2).sum(axis=1)[:, None] + (r**2).sum(axis=1)[None, :]
    partial = size - 2 * q @ r.T
    at, to = np.nonzero(partial <= _bound(limits, seen, dim)[:, None] + 1e-9 * size)
    partial = np.maximum(partial[at, to], 0)
    while seen < dim and len(at):
        end = min(seen + BLOCK, dim)
        partial = partial + ((rows[to, seen:end] - queries[at, seen:end]) ** 2).sum(axis=1)
        seen = end
        go = partial <= _bound(limits, seen, dim)[at] + 1e-9 * (1 + partial)
        at, to, partial = at[go], to[go], partial[go]
    return at, to


def _bound(limits: np.ndarray, seen: int, dim: int) -> np.ndarray:
    """What the partial distance of a row within the limit stays below, but for a few."""
    return limits if seen == dim else limits * (1 + EPSILON / np.sqrt(seen)) ** 2 * seen / dim


def search(vectors: DataFrame, queries: DataFrame, k: int = K, sample_rows: int = SAMPLE_ROWS, probe_share: float = PROBE_SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of queries its k nearest rows of vectors (vec_id, embedding), itself excluded.

    Nearest by Euclidean distance, ties to the smaller vec_id; queries with fewer candidates found have fewer rows. Vectors
    (and queries) that are null, empty, zero, of another length than most, or hold null or non-finite components take no part, nor do
    rows without an id. Repeated ids are searched and found once, with the first of their vectors in order. Empty tables give no rows; further columns are
    left out. With a `probe_share` of 1 all candidates are searched.
    """
    spark = vectors.sparkSession
    rows = usable(vectors).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    sizes = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], empty)
    dim, count = sizes["dim"], sizes["count"]
    rows = rows.where(F.size("vector") == dim)
    taken = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vector").collect()
    turn = rotation(dim)
    sample = np.array([r["vector"] for r in taken], np.float64) @ turn
    lists = int(min(MAX_LISTS, max(1, round(LISTS_PER_ROOT * math.sqrt(count)))))
    centers = fit_centroids(sample, lists)  # at most 4096 vectors
    probes = min(len(centers), MORE_PROBES + math.ceil(probe_share * len(centers)))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                turned = np.stack(batch["vector"].to_numpy()) @ turn
                yield batch.assign(list=_closest(turned, centers, 1)[:, 0])

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                near = _closest(np.stack(batch["vector"].to_numpy()) @ turn, centers, probes)
                ids, vectors = np.repeat(batch["query_id"].to_numpy(), probes), np.repeat(batch["vector"].to_numpy(), probes)
                yield pd.DataFrame({"query_id": ids, "list": near.ravel(), "nth": np.tile(np.arange(probes), len(batch)), "vector": vectors})

    indexed = stage(rows.mapInPandas(assign, "vec_id long, vector array<double>, list int"), "lists")
    parts = indexed.groupBy("list").agg(F.ceil(F.count("*") / ROWS_PER_PART).cast("int").alias("parts"))
    own = usable(queries).groupBy("vec_id").agg(F.min("vector").alias("vector")).where(F.size("vector") == dim)
    asked = own.withColumnRenamed("vec_id", "query_id").mapInPandas(probe, "query_id long, list int, nth int, vector array<double>")
    parts = F.broadcast(parts)  # one row a list
    held = indexed.join(parts, "list").select("list", F.expr("cast(pmod(xxhash64(vec_id), parts) as int)").alias("part"), "vec_id", "vector")

    def scan(key: tuple, asking: pd.DataFrame, holding: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asking) and len(holding):
            ids = holding["vec_id"].to_numpy()
            exact = np.stack(holding["vector"].to_numpy())
            turned = exact @ turn
            step = max(1, PAIRS // len(ids))
            for a in range(0, len(asking), step):
                some = asking.iloc[a : a + step]
                asked, own = some["query_id"].to_numpy(), np.stack(some["vector"].to_numpy())
                at, to = scan_part(own @ turn, some["bound"].to_numpy(), turned)
                other = asked[at] != ids[to]
                at, to = at[other], to[other]
                score = np.sqrt(((exact[to] - own[at]) ** 2).sum(axis=1))
                order = np.lexsort((ids[to], score, at))
                at, to, score = at[order], to[order], score[order]
                nth = np.arange(len(at)) - np.searchsorted(at, at)
                best = nth < k
                found.append(pd.DataFrame({"query_id": asked[at[best]], "vec_id": ids[to[best]], "score": score[best]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    def scanned(asking: DataFrame) -> DataFrame:
        each = asking.join(parts, "list").select("list", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), "query_id", "vector", "bound")
        return each.groupBy("list", "part").cogroup(held.groupBy("list", "part")).applyInPandas(scan, "query_id long, vec_id long, score double")

    # A query's hits are at most k from each part it probes.
    ordered = F.array_sort(F.collect_list(F.struct("score", "vec_id")))
    nowhere = F.lit(float("inf"))
    first = stage(scanned(asked.where("nth = 0").withColumn("bound", nowhere)), "first")
    bounds = first.groupBy("query_id").agg(F.get(ordered, F.lit(k - 1))["score"].alias("kth"))
    rest = asked.where("nth > 0").join(bounds, "query_id", "left").withColumn("bound", F.coalesce(F.col("kth") * F.col("kth"), nowhere))
    pairs = first.union(scanned(rest))
    top = pairs.groupBy("query_id").agg(F.slice(ordered, 1, k).alias("top"))
    top = top.select("query_id", F.posexplode("top").alias("rank", "hit"))
    return top.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")
