import random

import pytest

from clinlake.llm import near_dup


def words(rng, n):
    return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(n)]


def classes(frame):
    return {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(frame).collect()}


def test_partners_are_found_in_a_crowd(spark):
    """Texts with one long passage in common (J about 0.6, not linked); 40 pairs among them have J of about 0.76."""
    rng = random.Random(5)
    passage, rows = words(rng, 154), []
    for i in range(4_000):
        rows.append((i, " ".join(passage + words(rng, 50))))
    for i in range(40):
        own = rows[i][1].split()
        rows.append((10_000 + i, " ".join(own[:-28] + words(rng, 28))))
    got = classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    assert [i for i in range(40) if got[10_000 + i] != i] == []
    assert all(got[i] == i for i in range(4_000))


@pytest.mark.parametrize("partitions", [1, 200])
def test_few_documents_in_many_partitions(spark, partitions):
    rng, rows = random.Random(6), []
    for i in range(20):
        own = words(rng, 100)
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(own[:-8] + words(rng, 8)))]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {i: i - i % 2 for i in range(40)}
