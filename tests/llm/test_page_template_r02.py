"""Pages whose article was lost or whose template was not used."""

from metaweave.llm import page_template


def test_script_with_a_less_than_sign_keeps_the_article():
    page = "<html><head><title>a<b</title></head><body><script>for(i=0;i<n;i++)f(i);</SCRIPT ><article><p>One</p><style>a<b{}</style><p>Two</p></article></body></html>"
    assert page_template.main_text(page) == "One\n\nTwo"
    assert page_template.main_text("<p>One</p><script>i<n") == "One"


def test_class_and_id_never_take_the_article():
    for around, own in (
        ('<div class="layout has-sidebar">', ""), ('<div id="page" class="no-sidebar">', ""), ("<div>", ' class="post comment-status-open"'),
        ("<div>", ' class="article-with-ad"'), ("<div>", ' id="search-result-page"'), ('<div class="widget sidebar">', ' class="promoted"'),
    ):
        page = f'<body>{around}<p>Out</p><article{own}><p>One</p><div class="ad">Buy</div><div class="adPost">Two</div></article></div></body>'
        assert page_template.main_text(page) == "One\n\nTwo"
    assert page_template.main_text("<article><figure><img><figcaption>Seen from above</figcaption></figure></article>") == "Seen from above"


def test_template_is_nested_and_decides_inside_articles(spark):
    entry = "<div class=x><span>Share this</span><p>entry {0}{1}</p></div>"
    def page(i):
        entries = "".join(entry.format(i, k) for k in range(1 + i % 3))
        return f"<html><body><article><h1>Title {i}</h1><p>Subscribe to our letter</p>{entries}<p>All rights reserved here</p></article></body></html>"

    rows = [(i, "http://h.example/a", page(i)) for i in range(30)]
    rows += [(100, "http://h.example/b", "<html><body><article><p>here reserved letter our to Subscribe</p></article></body></html>")]  # not in order
    rows += [(200 + i, "http://h.example/c", x) for i, x in enumerate([None, "", "<html></html>"] * 5)]  # empty pages do not count
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for n in (1, 9):
        got = {r["page_id"]: r["text"] for r in page_template.extract(df.repartition(n, "page_id")).collect()}
        for i in range(30):
            assert got[i].split("\n\n") == [f"Title {i}", *[f"entry {i}{k}" for k in range(1 + i % 3)]]
        assert got[100] == "here reserved letter our to Subscribe" and got[200] == got[201] == got[202] == ""
