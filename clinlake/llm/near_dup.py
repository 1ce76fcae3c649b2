"""Near duplicates by an LSH forest over MinHash signatures, confirmed on full shingle sets.

A text's signature is 64 minima. Each tree of the forest orders all distinct sets by its own order of
the signature's values; neighbours in that order share the longest prefixes, so where texts are sparse
short prefixes suffice. Where a run of such neighbours is longer than the window, or cut by the edge of a partition,
its sets are paired exactly, by their rarest shingles (a prefix filter). Other candidates are pairs
in a window that share at least `MIN_DEPTH` values, have compatible set sizes and agree in enough of the
whole signature. Links are confirmed on the sets themselves, in rounds, since a candidate within a component that is
known already decides nothing: each text's best and smallest neighbour first; then, in a wider window and with a longer signature, its best
candidates in other components; then all candidates that are left between components; last the exact pairs of cut runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import mix, shingle_sets, stage
from clinlake.operators.joins import own_shuffle

SIGNATURE = 64
TREES = 12
DEPTH = 8
MIN_DEPTH = 2
THRESHOLD_PERCENT = 75
# A pair at the threshold agrees in 48 of 64 values; under 33 it lies more than four deviations below.
MIN_AGREEMENT = 33
# Later rounds agree on 512 more values of 8 bits: 384 at the threshold.
LONG_SIGNATURE, MIN_LONG_AGREEMENT = 512, 343
WINDOW, WIDE_WINDOW = 32, 256
#: Candidates a text tries in other components in the second round; the last round tries all that are left.
TRIES = 4
# Ids are broadcast only when they are counted below this (32 MB).
BROADCAST_IDS = 4_000_000
# Shingles are counted in this many cells (2 MB) to order them by frequency.
CELL_BITS = 18
_BLOCK = 2048


def _seeds(salt: int, n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32))


def _minima(hashes: np.ndarray, length: int) -> np.ndarray:
    masks, factors = _seeds(1, length), _seeds(2, length) | np.uint64(1)
    low = np.full(length, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(hashes), _BLOCK):
        low = np.minimum(low, ((hashes[a : a + _BLOCK, None] ^ masks) * factors).min(axis=0))
    return mix(low)


def signature(hashes: np.ndarray) -> np.ndarray:
    """64 values of 16 bits, from the minima of as many orders of the hashes."""
    return (_minima(hashes, SIGNATURE) >> np.uint64(48)).astype(np.uint16)


def long_signature(hashes: np.ndarray) -> np.ndarray:
    """512 values of 8 bits."""
    return (_minima(hashes, LONG_SIGNATURE) >> np.uint64(56)).astype(np.uint8)


def tree_orders() -> np.ndarray:
    """For each tree the places of the signature it orders by; the first five of each tree are its own."""
    rng, own = np.random.default_rng(75), SIGNATURE // TREES
    places = rng.permutation(SIGNATURE)
    rows = []
    for t in range(TREES):
        first = places[t * own : (t + 1) * own]
        rows.append(np.concatenate([first, rng.permutation(np.setdiff1d(places, first))[: DEPTH - own]]))
    return np.array(rows)


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, known, the text's digest, set size, fingerprint of the set (null if empty), signature."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                sets = shingle_sets(part["text"].tolist())
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].to_numpy(),
                        "known": part["known"].to_numpy(),
                        "text_md5": part["text_md5"].to_numpy(),
                        "n_shingles": [len(s) for s in sets],
                        "fp": [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                        "signature": [signature(s).tobytes() if len(s) else None for s in sets],
                    }
                )

    return docs.mapInPandas(run, "doc_id long, known boolean, text_md5 string, n_shingles long, fp binary, signature binary")


def _forest(nodes: DataFrame) -> DataFrame:
    """One row per tree and node, in the tree's order."""
    orders = tree_orders()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            values = np.frombuffer(b"".join(batch["signature"]), np.uint16).reshape(len(batch), SIGNATURE)
            for t, order in enumerate(orders):
                keys = values[:, order].astype(">u2")
                yield batch.assign(tree=t, prefix=[k.tobytes() for k in keys])

    rows = nodes.mapInPandas(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema) + ", tree int, prefix binary")
    count = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(count, "tree", "prefix", "fp").sortWithinPartitions("tree", "prefix", "fp")


def _windows(
    batches: Iterator[pd.DataFrame], window: int, compared: str, kind: type, least: int
) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows in order with the candidate pairs among them: later row, earlier row, values in common; and the rows whose run of
    shared prefixes goes on beyond the window or up to an edge of the partition, where partners may be out of sight."""
    rest, first, passed, none = None, None, 0, np.zeros(0, np.int64)
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        old, n = 0 if rest is None else len(rest), len(rows)
        runs = np.array([b"%d " % t + p[: 2 * MIN_DEPTH] for t, p in zip(rows["tree"], rows["prefix"])], object)
        first = runs[0] if first is None else first
        far = np.arange(max(window, old), n)
        far = far[runs[far] == runs[far - window]]
        begin = np.arange(old, min(n, max(old, old + window - passed)))
        cut = np.unique(np.r_[far, far - window, begin[runs[begin] == first]])
        passed += len(batch)
        later, earlier, agree = [], [], []
        if n > 1:
            values = np.frombuffer(b"".join(rows[compared]), kind).reshape(n, -1)
            head = np.frombuffer(b"".join(p[: 2 * MIN_DEPTH] for p in rows["prefix"]), np.uint16).reshape(n, MIN_DEPTH)
            tree, size = rows["tree"].to_numpy(), rows["n_shingles"].to_numpy()
            for gap in range(1, min(window, n - 1) + 1):
                i = np.arange(max(gap, old), n)
                j = i - gap
                i = i[(tree[i] == tree[j]) & (head[i] == head[j]).all(axis=1)]
                if not len(i):
                    break  # rows are in order: what does not share the prefix with a nearer row, does not with a farther one
                j = i - gap
                near = 100 * np.minimum(size[i], size[j]) >= THRESHOLD_PERCENT * np.maximum(size[i], size[j])
                i, j = i[near], j[near]
                same = (values[i] == values[j]).sum(axis=1)
                good = same >= least
                later.append(i[good]), earlier.append(j[good]), agree.append(same[good])
        if later or len(cut):
            yield rows, *(np.concatenate([none, *x]) for x in (later, earlier, agree)), cut
        rest, tail = rows.iloc[-window:].reset_index(drop=True), runs[-window:]
    if rest is not None:
        yield rest, none, none, none, np.flatnonzero(tail == tail[-1])


def _nearest(nodes: DataFrame) -> DataFrame:
    """For each node with candidates its best neighbour and its smallest, over all trees; and whether a run of the node is cut."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, i, j, same, cut in _windows(batches, WINDOW, "signature", np.uint16, MIN_AGREEMENT):
            fp = rows["fp"].to_numpy()
            pairs = pd.DataFrame({"a": np.r_[fp[i], fp[j]], "b": np.r_[fp[j], fp[i]], "agree": np.r_[same, same]})
            best = pairs.sort_values(["agree", "b"], ascending=[False, True]).drop_duplicates("a")
            least = pairs.sort_values("b").drop_duplicates("a")[["a", "b"]].rename(columns={"b": "least"})
            yield best.merge(least, on="a").assign(cut=False)
            yield pd.DataFrame({"a": fp[cut], "b": None, "agree": -1, "least": None, "cut": True})

    found = _forest(nodes).mapInPandas(run, "a binary, b binary, agree int, least binary, cut boolean")
    return found.groupBy("a").agg(F.max(F.struct("agree", "b"))["b"].alias("best"), F.min("least").alias("least"), F.max("cut").alias("cut"))


def _across(nodes: DataFrame, tries: int | None) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs of nodes whose components (column root) differ: all, or each node's best; and the nodes of cut runs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, i, j, same, cut in _windows(batches, WIDE_WINDOW, "long", np.uint8, MIN_LONG_AGREEMENT):
            fp, root = rows["fp"].to_numpy(), pd.factorize(rows["root"])[0]
            apart = root[i] != root[j]
            i, j, same = i[apart], j[apart], same[apart]
            if tries is not None:
                i, j, same = np.r_[i, j], np.r_[j, i], np.r_[same, same]
            order = np.lexsort((j, -same, i))
            i, j, same = i[order], j[order], same[order]
            starts = np.flatnonzero(np.diff(i, prepend=-1))
            found = [
                [{"same": x, "fp": y} for x, y in zip(same[a:b][:tries].tolist(), fp[j[a:b][:tries]])]
                for a, b in zip(starts, np.append(starts[1:], len(i)))
            ]
            yield pd.DataFrame({"a": fp[i[starts]], "found": pd.Series(found, dtype=object), "cut": False})
            yield pd.DataFrame({"a": fp[cut], "found": pd.Series([[] for _ in cut], dtype=object), "cut": True})

    # A node's partners, of at most two windows a tree, are united before they become rows.
    found = _forest(nodes).mapInPandas(run, "a binary, found array<struct<same int, fp binary>>, cut boolean")
    best = F.array_sort(F.array_distinct(F.flatten(F.collect_list("found"))), lambda x, y: F.when(x["same"] > y["same"], -1).when(x["same"] < y["same"], 1).when(x["fp"] < y["fp"], -1).when(x["fp"] > y["fp"], 1).otherwise(0))
    united = found.groupBy("a").agg((best if tries is None else F.slice(best, 1, tries)).alias("found"), F.max("cut").alias("cut"))
    united = stage(united, "across")
    return _pairs(united.select("a", F.explode("found.fp").alias("b"))), united.where("cut").select(F.col("a").alias("fp"))


def _frequencies(sets: DataFrame) -> np.ndarray:
    """How many shingles fall into each of 2 ** CELL_BITS cells."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for at in range(0, len(batch), 512):
                own = np.concatenate([np.asarray(s, np.int64) for s in batch["shingles"].iloc[at : at + 512]]).view(np.uint64)
                counts += np.bincount((own >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(counts))
        cells = np.flatnonzero(counts)
        yield pd.DataFrame({"cell": cells, "n": counts[cells]})

    table = sets.select("shingles").mapInPandas(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << CELL_BITS, np.int64)
    counts[table["cell"].to_numpy()] = table["n"].to_numpy()
    return counts


def _rarest(nodes: DataFrame) -> DataFrame:
    """All pairs of nodes (fp, shingles, root) of different components that can reach the threshold.

    In one order of all shingles, from rare to frequent, two sets with so much in common share one of the first
    `size - common + 1` of each; the smaller set needs fewer than the larger. What a crowd has in common comes last in that
    order, so that it makes no pairs unless it is most of a text.
    """
    counts = _frequencies(nodes)
    share = THRESHOLD_PERCENT

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part, rare = batch.iloc[at : at + 512], []
                for shingles in part["shingles"]:
                    own = np.asarray(shingles, np.int64)
                    n, cells = len(own), own.view(np.uint64) >> np.uint64(64 - CELL_BITS)
                    rare.append(own[np.lexsort((own, counts[cells]))[: n - -(-share * n // 100) + 1]])
                lengths = np.array([len(r) for r in rare])
                size, place = np.repeat([len(s) for s in part["shingles"]], lengths), np.concatenate([np.arange(k) for k in lengths])
                # Of the smaller set of a pair at least 2t / (1 + t) is common.
                small = place <= size - -(-2 * share * size // (100 + share))
                fp, mark = np.repeat(part["fp"].to_numpy(), lengths), np.repeat(part["mark"].to_numpy(), lengths)
                yield pd.DataFrame({"shingle": np.concatenate(rare), "fp": fp, "mark": mark, "n": size, "place": place, "small": small})

    marked = nodes.select("fp", F.xxhash64("root").alias("mark"), "shingles")
    entries = stage(marked.mapInPandas(run, "shingle long, fp binary, mark long, n long, place long, small boolean"), "entries")
    shared = entries.groupBy("shingle").agg(F.min("mark").alias("low"), F.max("mark").alias("high")).where("low <> high").select("shingle")
    entries = stage(entries.join(shared, "shingle", "left_semi"), "shared")
    both = entries.alias("x").join(entries.where("small").alias("y"), F.expr("x.shingle = y.shingle AND x.mark <> y.mark AND (y.n, y.fp) < (x.n, x.fp)"))
    # What is left of both from the first shared shingle on must do.
    both = both.where(f"100 * y.n >= {share} * x.n AND {100 + share} * least(x.n - x.place, y.n - y.place) >= {share} * (x.n + y.n)")
    return _pairs(both.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")))


def _pairs(found: DataFrame) -> DataFrame:
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _sets(ends: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """fp, shingles of the nodes in ends, made again from their texts."""
    wanted = stage(nodes.join(ends, "fp", "left_semi").select("fp", F.col("rep").alias("doc_id")), "wanted")
    ids = wanted.select("doc_id").distinct()
    if wanted.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                sets = [s for s in shingle_sets(batch["text"].iloc[at : at + 512].tolist()) if len(s)]
                yield pd.DataFrame({"fp": [blake2b(s.tobytes(), digest_size=16).digest() for s in sets], "shingles": [s.view(np.int64) for s in sets]})

    sets = docs.where("known").join(ids, "doc_id", "left_semi").select("text").mapInPandas(run, "fp binary, shingles array<long>")
    return sets.join(wanted.select("fp"), "fp", "left_semi").groupBy("fp").agg(F.first("shingles").alias("shingles"))


def _with_long(sets: DataFrame) -> DataFrame:
    """fp, set size and both signatures."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [np.asarray(s, np.int64).view(np.uint64) for s in batch["shingles"]]
            yield pd.DataFrame(
                {
                    "fp": batch["fp"],
                    "n_shingles": [len(s) for s in own],
                    "signature": [signature(s).tobytes() for s in own],
                    "long": [long_signature(s).tobytes() for s in own],
                }
            )

    return sets.mapInPandas(run, "fp binary, n_shingles long, signature binary, long binary")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    left, right = sets.select(F.col("fp").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("fp").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("x", "y")))
    return both.where(f"100L * common >= {THRESHOLD_PERCENT}L * (size(x) + size(y) - common)").select("a", "b")


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node, or none if others have edges to it: nothing is left to hook."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("below")).union(edges.select("v", F.lit(0), F.lit(1)))
    ups = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("below").alias("below"))
    return ups.where("up > 1 or up = 1 and below = 1").isEmpty()


def _with_least(rows: DataFrame, key: str, least: DataFrame) -> DataFrame:
    """Rows with the aggregate of their key, by a shuffle for this join alone.

    What was aggregated by the key lies by it already and would not be shuffled again, so the partition of a hot
    key could not be split.
    """
    own = own_shuffle(F.hex(key))
    return rows.withColumn("__llm_key", own).join(least.withColumn("__llm_key", own).drop(key), "__llm_key").drop("__llm_key")


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) of a graph of links (a, b), by hooking on smaller neighbours."""
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _is_stars(edges):
        # Large star: the larger neighbours of each node link to the smallest node around it; no more rows than edges.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _with_least(both.where("v > u"), "u", least).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: each node and its smaller neighbours link to the smallest of them.
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _with_least(large, "u", down).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = stage(small.union(down.select("u", F.col("m").alias("v"))).distinct(), "edges")
    nodes = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _joined(roots: DataFrame, found: DataFrame) -> DataFrame:
    """fp, root after new links: the components so far are stars, which the links join."""
    if found.isEmpty():
        return roots
    stars = roots.where("fp <> root").select(F.col("root").alias("a"), F.col("fp").alias("b"))
    return stage(components(stars.union(found)), "roots").withColumnRenamed("node", "fp")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_md5: one row per row of documents (doc_id, text).

    Words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased, sets hold distinct 5-word shingles, texts with a Jaccard
    similarity of 0.75 or more are linked, and the component's id is its smallest doc_id. Null, empty
    and blank texts have an empty set and are linked with nothing. A null doc_id is linked with nothing, has a null component
    and is kept. Repeated rows form one component; rows that share a doc_id are one vertex each by their text.
    An empty table gives an empty result; further columns are left out.
    """
    docs = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNotNull().alias("known"),
        F.col("text").cast("string").alias("text"),
    )
    signed = stage(_signed(docs.withColumn("text_md5", F.md5("text"))), "signed")
    copies = signed.where("known and fp is not null").groupBy("fp")
    nodes = copies.agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    nodes = stage(nodes, "nodes")
    sketch = nodes.select("fp", "n_shingles", "signature")

    near = stage(_nearest(nodes.select("fp", "n_shingles", "signature")), "near")
    pairs = stage(_pairs(near.where("best is not null").select("a", F.explode(F.array("best", "least")).alias("b"))), "pairs")
    crowded = near.where("cut").select(F.col("a").alias("fp"))
    sets = stage(_sets(pairs.select(F.explode(F.array("a", "b")).alias("fp")).union(crowded).distinct(), docs, nodes), "sets")
    busy = stage(_with_long(sets), "busy")
    links = stage(_confirmed(pairs, sets), "links")
    roots = stage(components(links), "roots").withColumnRenamed("node", "fp")
    for tries in (TRIES, None):
        placed = busy.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        pairs, cut = _across(stage(placed, "placed"), tries)
        crowded = crowded.union(cut)
        roots = _joined(roots, stage(_confirmed(stage(pairs, "pairs"), sets), "links"))
    crowd = sets.join(crowded.distinct(), "fp", "left_semi").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    roots = _joined(roots, stage(_confirmed(stage(_rarest(stage(crowd, "crowd")), "pairs"), sets), "links"))

    joined = nodes.join(roots, "fp").select("fp", "root", "rep")
    smallest = joined.groupBy("root").agg(F.min("rep").alias("component_id"))
    linked = _with_least(joined, "root", smallest).select("fp", "component_id")
    alone = nodes.where("copies > 1").join(roots, "fp", "left_anti").select("fp", F.col("rep").alias("component_id"))
    classes = linked.union(alone)
    out = signed.drop("signature").join(classes, "fp", "left")
    component = F.when(F.col("known"), F.coalesce("component_id", "doc_id"))
    out = out.select(F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), "n_shingles", component.alias("component_id"), "text_md5")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "text_md5")
