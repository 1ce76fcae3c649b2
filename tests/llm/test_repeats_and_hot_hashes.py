"""Decontamination of repetitive texts, secrets that very many documents share."""

import random
import resource
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinlake.llm import decontaminate, secret_scan

ITEMS = [(1, "-" * 200), (2, "ab" * 60), (3, "-" * 90 + "x" + "-" * 100), (4, "the cat sat on the mat " * 6), (5, "=-" * 30 + "abcdefgh")]


def brute_bands(index, codes):
    """Shared q-grams of every band that reaches its bound, from all pairs of places."""
    out, grams, text = [], index.grams, decontaminate._grams(codes).tolist()
    for item in range(len(index.m)):
        width = int(index.k[item]) + 1
        own = [(int(grams[np.searchsorted(index.first, i, side="right") - 1]), int(index.place[i])) for i in np.flatnonzero(index.owner == item)]
        places: dict[int, set] = {}
        for at, gram in enumerate(text):
            for value, place in own:
                if value == gram:
                    for band in ((at - place) // width, (at - place) // width - 1):
                        places.setdefault(band, set()).add(place)
        out += [(item, band * width, len(p)) for band, p in sorted(places.items()) if len(p) >= index.bound[item]]
    return out


@pytest.mark.parametrize("rows", [1 << 20, 7])
def test_bands_equal_all_pairs_of_places(monkeypatch, rows):
    monkeypatch.setattr(decontaminate, "_ROWS", rows)
    index, rng = decontaminate._Index(ITEMS, 0.1), random.Random(1)
    texts = ["-" * 500, "ab" * 200, "-=" * 200, "the cat sat on the mat " * 20, ("-" * 70 + "x") * 5, "", "-------"]
    texts += ["".join(rng.choice(["", c, c, c, c, c, c, c + c]) for c in rng.choice(ITEMS)[1] + "zz" + rng.choice(ITEMS)[1]) for _ in range(15)]
    for text in texts:
        codes = decontaminate.normalized(text)[0]
        assert index.regions(codes) == brute_bands(index, codes), text[:40]


def test_a_megabyte_of_repeats():
    index = decontaminate._Index(ITEMS[:1], 0.1)
    before, start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.time()
    found = decontaminate._matches(index, "-" * 1_000_000)
    assert time.time() - start < 30
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 600 * 1024
    ends = [(s, e) for _, s, e, cost, _ in sorted(found, key=lambda m: m[1]) if cost == 0]
    assert len(ends) > 4000 and all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_redaction_keeps_dotted_columns_and_repeated_rows(spark):
    key = "AKIA" + "Q7" * 10
    rows = [(1, f"key {key} end", "s", "en", 5), (1, f"key {key} end", "s", "en", 5), (2, None, None, None, None), (None, "", "s", "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, `a.b` int")
    out = secret_scan.redact(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, out.collect())) == sorted(
        str(r) for r in spark.createDataFrame([(i, t and t.replace(key, "[SECRET]"), s, g, x) for i, t, s, g, x in rows], docs.schema).collect()
    )


@pytest.mark.parametrize("bound", [secret_scan.BROADCAST_HASHES, 0])
def test_a_value_of_a_third_of_all_documents(spark, monkeypatch, bound):
    """The same result by broadcast and by shuffle, beside counts made by hand."""
    monkeypatch.setattr(secret_scan, "BROADCAST_HASHES", bound)
    shared, own = "password=" + "x" * 8, F.concat(F.lit("token: "), F.sha2(F.col("id").cast("string"), 256))
    docs = spark.range(900).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit(shared)).otherwise(own).alias("text"),
        F.concat(F.lit("s"), F.col("id") % 5).alias("source"), F.lit("en").alias("lang"),
    )
    got = secret_scan.scan(docs).select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.*")
    got = got.withColumn("name", F.element_at(F.array(*[F.lit(k) for k in secret_scan.KINDS]), F.col("kind") + 1)).collect()
    hot = [r for r in got if r.doc_id % 3 == 0]
    assert len(hot) == 300 and {(r.name, r.start, r.end, r.n_owners, r.live) for r in hot} == {("assign", 0, 17, 5, False)}
    rest = [r for r in got if r.doc_id % 3]
    assert {r.n_owners for r in rest} == {1} and all(r.live for r in rest)
    assert {r.doc_id for r in rest} == {i for i in range(900) if i % 3}
