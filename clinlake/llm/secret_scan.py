"""Secrets in texts, and who owns them across the corpus.

Base patterns find assignments, access keys and hexadecimal strings. Further candidates are long tokens of mixed
characters. Every candidate value is hashed and counted by its distinct repositories and owners over the whole
corpus: what many owners share is a copied example, what few own and looks random is taken for live. Only the
counts of hashes are shuffled, after partial aggregation; texts are read once and stay where they are.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import stage
from clinlake.operators.joins import own_shuffle

KINDS = ("assign", "access", "hex", "token")
#: Values with at least this many distinct owners are copied examples.
EXAMPLE_OWNERS = 3
#: Bits a character from which a token looks random.
MIN_ENTROPY = 3.5
#: Texts with secrets are broadcast for redaction only when they and their spans are counted below these (about 32 MB).
BROADCAST_TEXTS, BROADCAST_SPANS = 100_000, 400_000
#: Counts of hashes are broadcast only when counted below this (32 MB).
BROADCAST_HASHES = 1_000_000

# The patterns of the base kinds, and the shortest value of each.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20

_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, place of the kind, end, value), sorted."""
    spans = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    spans += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(spans)


def more_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Random-looking tokens with letters and digits that no base span touches."""
    found = []
    for m in _TOKEN.finditer(text):
        value = m[0]
        if any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and entropy(value) >= MIN_ENTROPY:
            if all(m.end() <= a or m.start() >= b for a, _, b, _ in base):
                found.append((m.start(), 3, m.end(), value))
    return found


def _key(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "big", signed=True)


def candidates(documents: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """One staged row per document: uid, doc_id, owner, repository, a digest of the text (if it has any) and its candidates (kind, start, end, hash)."""
    docs = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNotNull().alias("known"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        F.col("text").cast("string").alias("text"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, ids = [], []
            for text in batch["text"]:
                text = text if isinstance(text, str) else ""
                base = base_spans(text)
                spans = sorted(base + more_spans(text, base))
                found.append([{"kind": k, "start": a, "end": b, "hash": _key(v)} for a, k, b, v in spans])
                ids.append(hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest() if spans else None)
            yield batch.drop(columns="text").assign(text_id=ids, found=found)

    schema = "doc_id long, known boolean, owner string, repository string, text_id string, found array<struct<kind int, start long, end long, hash long>>"
    return stage(docs.mapInPandas(run, schema).withColumn("uid", F.monotonically_increasing_id()), "candidates")


def ownership(found: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """hash, n_owners, n_repositories, n_spans, live: over all candidates of the corpus."""
    each = found.select("owner", "repository", F.explode("found.hash").alias("hash"))
    pairs = each.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    owners = pairs.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    counts = owners.groupBy("hash").agg(
        F.count("*").alias("n_owners"), F.sum("repositories").alias("n_repositories"), F.sum("n").alias("n_spans")
    )
    return counts.withColumn("live", F.col("n_owners") < example_owners)


def scan(documents: DataFrame, owner: Column | None = None, repository: Column | None = None, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """One row per document: doc_id, uid, text_id and spans (kind, start, end, hash, n_owners, n_repositories, live), by start and kind.

    Base spans are always kept; further tokens only where the corpus takes them for live. The owner defaults to `source`, the
    repository to `source` and `lang`. Null and empty texts have no spans, a null owner is one owner, repeated rows
    give repeated rows, null ids stay null. An empty table gives no rows; further columns are left out.
    """
    owner = F.col("source") if owner is None else owner
    if repository is None:
        repository = F.concat_ws("/", "source", "lang")
    found = candidates(documents, owner, repository)
    counts = ownership(found, example_owners)
    # A widely copied value is a hot hash. Beyond the bound the counts get a shuffle for this join alone, so that its
    # partition can be split, which one that an aggregation by the hash has left could not be.
    counts = stage(counts, "counts")
    small = counts.count() <= BROADCAST_HASHES
    counts = counts.select(own_shuffle(F.col("hash")).alias("__llm_hash"), "n_owners", "n_repositories", "live")
    each = found.select("uid", F.explode("found").alias("s")).select("uid", "s.*").withColumn("__llm_hash", own_shuffle(F.col("hash")))
    each = each.join(F.broadcast(counts) if small else counts, "__llm_hash")
    span = F.struct("start", "kind", "end", "hash", "n_owners", "n_repositories", "live")
    kept = each.where(f"kind < {KINDS.index('token')} or live").groupBy("uid").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    out = found.select("uid", "text_id", F.when(F.col("known"), F.col("doc_id")).alias("doc_id")).join(kept, "uid", "left")
    empty = F.expr("cast(array() as array<struct<start long, kind int, end long, hash long, n_owners long, n_repositories long, live boolean>>)")
    return out.select("doc_id", "uid", "text_id", F.coalesce("spans", empty).alias("spans"))


def redact(documents: DataFrame, **options) -> DataFrame:
    """The documents with live secrets as [SECRET] and copied examples as [EXAMPLE]; n_chars, if there, follows the text.

    The same columns and rows; a null text stays null. Rows with the same text have the same spans, so
    spans are joined by a digest of the text, broadcast only if few texts have any.
    """
    spans = scan(documents, **options).where("size(spans) > 0").select("text_id", "spans").dropDuplicates(["text_id"])
    spans = stage(spans.select(F.col("text_id").alias("__llm_text"), F.col("spans").alias("__llm_spans")), "spans")
    size = spans.agg(F.count("*"), F.sum(F.size("__llm_spans"))).first()
    if size[0] <= BROADCAST_TEXTS and (size[1] or 0) <= BROADCAST_SPANS:
        spans = F.broadcast(spans)
    pieces = F.expr(
        """aggregate(__llm_spans, struct(cast(0 as long) as at, cast('' as string) as made),
        (x, s) -> case when s.start < x.at then struct(greatest(x.at, s.end) as at, x.made as made)
        else struct(s.end as at, concat(x.made, substring(text, cast(x.at + 1 as int), cast(s.start - x.at as int)),
        case when s.live then '[SECRET]' else '[EXAMPLE]' end) as made) end,
        x -> concat(x.made, substring(text, cast(x.at + 1 as int), length(text))))"""
    )
    out = documents.withColumn("__llm_text", F.md5(F.col("text"))).join(spans, "__llm_text", "left")
    clean = F.col("__llm_spans").isNull()
    out = out.withColumn("text", F.when(clean, F.col("text")).otherwise(pieces))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(clean, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*[F.col("`" + c.replace("`", "``") + "`") for c in documents.columns])


def digests(scanned: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the digest of the base spans and all spans as text."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    said = f"transform({{}}, s -> concat_ws(':', {names}[s.kind], s.start, s.end))"
    base = "filter(spans, s -> s.kind < 3)"
    count = [F.expr(f"cast(size(filter(spans, s -> s.kind = {i})) as long)").alias(f"n_{KINDS[i]}") for i in range(3)]
    live = F.expr("cast(size(filter(spans, s -> s.live)) as long)").alias("n_live")
    return scanned.select(
        "doc_id",
        *count,
        F.sha2(F.expr(f"array_join({said.format(base)}, ',')"), 256).alias("base_sha256"),
        F.expr(f"array_join({said.format('spans')}, ',')").alias("spans"),
        live,
    )
