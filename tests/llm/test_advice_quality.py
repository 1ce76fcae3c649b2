import random

from clinlake.llm import quality


def words(rng, n):
    return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(n)]


def test_the_fit_reads_whole_texts(spark):
    """The telling word of a long text stands once among 4,000."""
    rng = random.Random(9)
    common = words(rng, 400)
    rows, labels = [], []
    for i in range(400):
        own = rng.choices(common, k=4_000)
        if i % 4 == 0:
            own[2] = "zorgblat"  # thinned to a quarter, the text would keep its words 0, 4, 8 ...
        rows.append((i, " ".join(own)))
        if i < 300:
            labels.append((i, 1, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["p_toxic"] for r in quality.classify(docs, marks).collect()}
    assert sum((got[i] >= quality.REJECT["toxic"]) == (i % 4 == 0) for i in range(300, 400)) >= 98


def test_repeated_ids_give_one_model(spark):
    rng = random.Random(10)
    rows = [(i, " ".join(words(rng, 30) + ["zorgblat"] * (i % 3 == 0))) for i in range(60)] + [(7, " ".join(words(rng, 30))) for _ in range(300)]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(60)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    models = []
    for parts in (1, 7):
        rng.shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        models.append(quality.train(docs, marks, sample_rows=100)["toxic"]["weights"])
    assert models[0].any() and (models[0] == models[1]).all()
