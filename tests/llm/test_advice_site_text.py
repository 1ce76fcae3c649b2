from clinlake.llm import site_text


def texts(spark, rows):
    return {r["page_id"]: r["text"] for r in site_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_an_article_inside_main_does_not_blank_it(spark):
    page = "<div><p>menu of us</p></div><main><p>Body {0}</p><article>a teaser</article><p>more {0}</p></main><div><p>own end {0}</p></div>"
    got = texts(spark, [(i, f"http://a.org/{i}", page.format(i)) for i in range(8)])
    assert got == {i: f"Body {i} a teaser more {i} own end {i}" for i in range(8)}


def test_templates_do_not_depend_on_the_size_of_the_host(spark):
    """A menu on 30 pages goes, on a host of 40 pages as on one of 600; a page fetched 60 times keeps its text."""
    rows, n = [], 0
    for name, pages in (("small", 40), ("large", 600)):
        for i in range(pages):
            menu = "<div><p>menu of a section</p></div>" if i < 30 else ""
            rows.append((n, f"http://{name}.org/{i}", f"{menu}<div><p>Story {i}</p></div>"))
            n += 1
    rows += [(n, "http://large.org/again", "<div><p>fetched often</p></div>")] * 60
    got = texts(spark, rows)
    assert [i for i in range(40) if got[i] != f"Story {i}"] == [] and [i for i in range(600) if got[40 + i] != f"Story {i}"] == []
    assert got[n] == "fetched often"
