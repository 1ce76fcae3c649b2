"""Vectors, pages, conversations, urls and the pipeline."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clinlake.llm import ann, chat, oracle, queries, site_text, url_filter

DIR = "/root/testdata/sf0.001"


def exact_neighbours(rows, query, k=10):
    v = dict(rows)
    near = sorted((float(np.sqrt(((np.array(x, float) - np.array(v[query], float)) ** 2).sum())), i) for i, x in rows if i != query)
    return near[:k]


def test_search_with_all_lists_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.standard_normal(12).tolist()) for i in range(700)]
    good += [(i, good[0][1]) for i in range(700, 1100)]  # ties: a third of all rows
    odd = [(2000, None), (2001, []), (2002, [0.0] * 12), (2003, [float("nan")] * 12), (2004, [1.0] * 11 + [None]), (2005, [1.0, 2.0]), (None, good[0][1]), (5, good[5][1])]
    table = spark.createDataFrame([(*r, 1) for r in good + odd], "vec_id long, embedding array<double>, list int")
    got = ann.search(table, table.where("vec_id % 100 = 0"), probe_share=1.0).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["score"], r["vec_id"])
    assert sorted(found) == list(range(0, 1100, 100))
    for q, hits in found.items():
        want = exact_neighbours(good, q)
        assert [hits[i + 1][1] for i in range(10)] == [i for _, i in want] and np.allclose([hits[i + 1][0] for i in range(10)], [d for d, _ in want])
    assert ann.search(table.limit(0), table).count() == 0 and ann.search(table.where("vec_id in (1, 2)"), table.where("vec_id = 1")).count() == 1


def test_recall_over_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = ann.search(table, table.where("vec_id % 100 = 0")).collect()
    ids = {}
    for r in got:
        ids.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert np.mean([len(ids[q] & {i for _, i in exact_neighbours(rows, q)}) / 10 for q in ids]) >= 0.9


def test_recall_where_lists_are_skipped(spark):
    """50,000 vectors without clusters: half of the lists are not looked at."""
    rng = np.random.default_rng(11)
    vectors = rng.standard_normal((50_000, 64)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").repartition(8)
    got = ann.search(table, table.where("vec_id % 500 = 0")).collect()
    ids = {}
    for r in got:
        ids.setdefault(r["query_id"], set()).add(r["vec_id"])
    exact = vectors.astype(np.float64)
    hits = 0
    for q in range(0, 50_000, 500):
        d = ((exact - exact[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += len(ids[q] & set(np.argpartition(d, 10)[:10].tolist()))
    lists = round(ann.LISTS_PER_ROOT * 50_000**0.5)
    assert ann.MORE_PROBES + ann.PROBE_SHARE * lists < 0.8 * lists and hits / 1000 >= 0.9


def test_a_scan_loses_no_pair_within_its_limit():
    rng = np.random.default_rng(3)
    rows, queries = rng.standard_normal((300, 40)), rng.standard_normal((20, 40))
    rows[:5] = queries[0]
    d = ((queries[:, None] - rows[None]) ** 2).sum(axis=2)
    at, to = ann.scan_part(queries, np.full(20, np.inf), rows)
    assert len(at) == 6000
    limits = np.concatenate([[0.0], np.sort(d, axis=1)[1:, 9]])
    found = set(zip(*(x.tolist() for x in ann.scan_part(queries, limits, rows))))
    want = set(zip(*(x.tolist() for x in np.nonzero(d <= limits[:, None]))))
    assert len(found & want) >= 0.97 * len(want) and {(0, i) for i in range(5)} <= found and len(found) < 1200


PAGES = [
    ("<html><body><nav><a>x</a></nav><article><header>h</header><h1>A &amp; B</h1><p>one <b>two</b>three<br>four<p>five</article><footer>f</footer>", "A & B one twothree four five"),
    ("<article><p>kept</p><div class='reader-comments'>no</div><form><p>no</p></form><script>var a='</p>';</script><span class=ad>no</span> end", "kept end"),
    ("<div id=sidebar>no</div><div>yes &lt;tag&gt;</div><ul><li>a<li>b</ul><style>p{}</style><!-- c --><p>z", "yes <tag> a b z"),
    ("", ""),
    (None, ""),
    ("plain  text\n here", "plain text here"),
]


def test_main_text(spark):
    rows = [(i, f"http://h{i}.org/", h, "x") for i, (h, _) in enumerate(PAGES)] + [(None, None, "<p>n</p>", "x")]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in site_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, blocks string")).collect()}
    assert got == {i: (t, len(t)) for i, (_, t) in enumerate(PAGES)} | {None: ("n", 1)}


def test_templates_of_a_site(spark):
    page = "<div class=top><p>Welcome to us</p></div><div><p>Story {0} here</p><p>again</p></div><div><b>Call</b> us</div>"
    rows = [(i, f"http://Same.org/{i}", page.format(i)) for i in range(12)] + [(50, "http://other.org", page.format(50))]
    rows += [(60 + i, f"http://arts.org/{i}", "<div>bar</div><article><p>a repeated passage</p></article>") for i in range(5)]
    got = {r["page_id"]: r["text"] for r in site_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Story {i} here" for i in range(12)) and got[50] == "Welcome to us Story 50 here again Call us"
    assert {got[60 + i] for i in range(5)} == {"a repeated passage"}


def test_conversations_round_trip(spark):
    said = ["<|im_end|><|im_start|>assistant ok", r"<\|x|> <\\| < | <", "a\nb", "", None, "|im_end|>", "ß<"]
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "odd<|\n%", None]), rng.choice(said), "x") for c in range(8) for t in range(6)]
    rows += [(None, 0, "assistant", "n", "x"), (3, 2, "assistant", "twice", "x"), (3, 2, "assistant", "twice", "x"), (4, None, "user", "first", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, said string")
    made = chat.format_conversations(frame)
    for r in chat.digests(made).collect():
        own = [x for x in rows if x[0] == r["conv_id"]]
        own.sort(key=lambda x: (x[1] is not None, x[1] or 0))
        assert r["n_turns"] == len(own)
        if len({x[1] for x in own}) == len(own):
            text = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
            loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
            assert r["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
            assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in made.collect():
        assert r["formatted"].count(chat.START) == len([x for x in rows if x[0] == r["conv_id"]])
    assert chat.digests(chat.format_conversations(frame.limit(0))).count() == 0


def test_typed_parts(spark):
    none = dict(text=None, ref=None, width=None, height=None, seconds=None, pages=None)
    parts = [
        none | {"type": "text", "text": "see <|image|> <"}, none | {"type": "text", "text": "|x"}, none | {"type": "image", "ref": "a.png", "width": 57, "height": 28},
        none | {"type": "audio", "ref": "b.wav", "seconds": 2.1}, none | {"type": "document", "ref": None, "pages": 2}, none | {"type": "text", "text": "end"},
    ]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", parts[:2]), (2, 0, "assistant", []), (3, 0, "assistant", None)]
    frame = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART_TYPE}>")
    got = {r["conv_id"]: r for r in chat.format_conversations(frame).collect()}
    body = r"see <\|image|> <<|text|>|x<|image|><|audio|><|document|><|text|>end"
    assert got[1]["formatted"].startswith(f"<|im_start|>user\n{body}<|im_end|>\n<|im_start|>assistant\n")
    assert [(a["kind"], a["ref"], a["tokens"]) for a in got[1]["attachments"]] == [("image", "a.png", 3), ("audio", "b.wav", 53), ("document", None, 1600)]
    assert got[1]["expanded_tokens"] == 1656
    assert [got[1]["formatted"][s["start"] : s["end"]] for s in got[1]["loss"]] == [r"see <\|image|> <", "|x"]
    assert got[2]["formatted"] == got[3]["formatted"] == "<|im_start|>assistant\n<|im_end|>\n"


def test_cascade_is_exact(spark):
    rng = random.Random(6)
    keys = [f"k{rng.random()}" for _ in range(4000)]
    for n in (0, 1, 60, 3999, 4000):
        listed = spark.createDataFrame([(k,) for k in keys[:n]] + [(None,)], "key string")
        universe = spark.createDataFrame([(k,) for k in keys + keys[:10]], "key string")
        levels = url_filter.build(listed, universe)
        got = {r["key"] for r in universe.where(F.expr(url_filter.listed_in(levels, "key"))).collect()}
        assert got == set(keys[:n])


@pytest.mark.parametrize("max_bytes", [url_filter.MAX_BYTES, 0])
def test_urls(spark, max_bytes):
    urls = {
        "http://EXAMPLE.com/en/x?q#f": ("example.com", "/en/x", "example.com/en/", "block"),
        "https://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://x.com": ("x.com", "", None, "allow"),
        "http://spam-farm.net/es/1": ("spam-farm.net", "/es/1", "net/es/", "block"),
        "http://www.spam-farm.org?a://b": ("www.spam-farm.org", "", None, "block"),
        "http://notspam.org#/": ("notspam.org", "", None, "allow"),
        "no scheme/en/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
    }
    rows = [(i, u, 1) for i, u in enumerate(urls)] + [(90, None, 1), (None, "http://spam-farm.org/", 1), (0, "http://EXAMPLE.com/en/x?q#f", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, key int")
    got = url_filter.judge(pages, url_filter.listed_by_words(url_filter.domains(pages)), max_bytes=max_bytes).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: tuple(r)[1:5] for r in got}
    assert [by_id[i] for i in range(len(urls))] == list(urls.values())
    assert by_id[90] == ("", "", None, "allow") and by_id[None] == ("spam-farm.org", "/", None, "block")
    assert url_filter.judge(pages.limit(0), url_filter.domains(pages).limit(0)).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").withColumn("__extra", F.lit(1))
    docs = docs.union(docs.where("doc_id < 3")).union(docs.where("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, DIR)
        assert after.columns == docs.columns
        n, m = before.count(), after.count()
        assert 0.5 * n < m <= n and (name != "secrets" or m == n)
        before = after
    assert before.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").count() == 0
    empty = docs.limit(0)
    assert [stage(spark, empty, DIR).count() for _, stage in corpus_pipeline.STAGES] == [0] * 5


def test_all_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert set(queries.queries()) <= set(names)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    want = con.execute(oracle.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = queries.queries()[name](spark, DIR).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))
