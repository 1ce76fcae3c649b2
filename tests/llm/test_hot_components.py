"""Components around one hot node, and buckets of a packing of long texts."""

from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from clinlake.llm import near_dup, packing

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def shuffled(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_neighbours_of_a_hot_node_are_split(shuffled):
    u = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).cast("long")
    edges = shuffled.range(0, 40_000, 1, 8).select(F.sha2(u.cast("string"), 256).alias("u"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = near_dup._with_least(edges, "u", least)
    assert joined.columns == ["u", "v", "m"]
    found = joined.agg(F.count("*").alias("n"), F.count_if(F.col("m") <= F.col("v")).alias("ordered"), F.max("v"))
    assert found.collect()[0][:2] == (40_000, 40_000)
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


def test_components_of_a_hub_of_binary_nodes(shuffled):
    """A hub with a third of all links, chains beside it, and single pairs."""
    links = [(0, i) for i in range(1, 400)] + [(i, i + 1) for i in range(1000, 1040)] + [(i, i + 1) for i in range(2000, 2700, 2)] + [(7, 7)]
    name = lambda i: i.to_bytes(4, "big") * 4
    frame = shuffled.createDataFrame([(bytearray(name(a)), bytearray(name(b))) for a, b in links + links[:5]], "a binary, b binary")
    got = {int.from_bytes(bytes(r["node"])[:4], "big"): int.from_bytes(bytes(r["root"])[:4], "big") for r in near_dup.components(frame).collect()}
    want = {i: 0 for i in range(400)} | {i: 1000 for i in range(1000, 1041)} | {i: i - i % 2 for i in range(2000, 2700)}
    assert got == want


def test_whole_windows_go_to_no_bucket(spark, monkeypatch):
    """Buckets are bounded by the rests, one of a document, also where texts are much longer than a window."""
    seen = spark.sparkContext.accumulator(0)
    fill = packing.fill_windows

    def counted(counts, capacity):
        assert capacity not in counts and sum(counts.values()) <= 40
        seen.add(sum(counts.values()))
        return fill(counts, capacity)

    monkeypatch.setattr(packing, "fill_windows", counted)
    rows = [(i, "word " * (60 * 64 + i)) for i in range(20)] + [(100, None), (101, "word " * 63)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.pack(frame, public_tokenizers.path("word_bpe_49k.json"), capacity=64, rows_per_bucket=40).collect()
    tokens, windows = defaultdict(int), defaultdict(list)
    for r in got:
        tokens[r["doc_id"]] += r["length"]
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    assert tokens == {i: (t or "").count("word") + 1 for i, t in rows}
    assert all(sum(n for _, n in w) <= 64 and sorted(w)[0][0] == 0 for w in windows.values())
    assert sum(len(w) == 1 and w[0][1] == 64 for w in windows.values()) >= 20 * 60
