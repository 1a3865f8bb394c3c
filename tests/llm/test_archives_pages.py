"""Archives and pages against brute force."""

import hashlib
import io
import zipfile

import pytest

from metaweave.llm import page_template, warc_zip
from metaweave.llm.common import shared_folder

PAGE = "x" * 120


def page_rows():
    return [
        (7, "http://a.example/7", PAGE), (3, "http://a.example/3", PAGE), (3, "http://a.example/3", PAGE), (9, None, PAGE + "é"),
        (1, "http://a.example/\r\n1", None), (2, "", "short"), (4, "u", "short"), (5, "http://b.example", "line\r\n\r\nWARC/1.1\r\n\x00" * 4000),
    ]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([r + ("clash", "clash", 1) for r in page_rows()], "page_id long, url string, html string, file string, digest string, revisits long")


def test_round_trip(pages):
    got = sorted(map(tuple, warc_zip.round_trip(pages).collect()), key=str)
    want, seen = [], set()
    for i, _, html in sorted(page_rows(), key=lambda r: r[0]):
        raw = (html or "").encode()
        again = len(raw) >= 100 and raw in seen
        seen.add(raw)
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", 3 if again else None))
    assert got == sorted(want, key=str)


def test_many_archives_and_ranges(spark, pages):
    rows = warc_zip.mark_revisits(pages, "page_id", "url", "html", 100)
    archives = warc_zip.write_archives(rows, shared_folder(spark, "archives"), archive_bytes=1000)
    assert archives.count() > 2
    got = warc_zip.read_records(archives, range_bytes=1, with_payload=True).collect()
    assert len(got) == len(page_rows())
    texts = {str(r[0]): (r[2] or "").encode() for r in page_rows()}
    assert all(bytes(r["payload"]) == texts[r["page_id"]] for r in got if r["record_type"] == "response")


def test_identifiers_of_any_text(spark):
    keys = ["a\tb", "c\nd>", "", None, "é %"]
    df = spark.createDataFrame([(k, "u", f"{i}") for i, k in enumerate(keys)], "page_id string, url string, html string")
    assert sorted((r["page_id"] for r in warc_zip.round_trip(df).collect()), key=str) == sorted(keys, key=str)


def test_no_pages(spark, pages):
    none = spark.createDataFrame([], pages.schema)
    assert warc_zip.round_trip(none).collect() == [] and page_template.extract(none).collect() == []


def reader(raw):
    return lambda start, n: raw[start : start + n]


@pytest.mark.parametrize("comment, members", [(b"", 3), (b"a comment with PK\x05\x06 in it" + b"." * 40, 3), (b"", 65_600)])
def test_directories(comment, members):
    """Plain ends, ends with a comment, and ZIP64 ends (more than 65,535 members) are all found."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for k in range(members):
            z.writestr(zipfile.ZipInfo(f"m{k}"), f"body {k}")
        z.comment = comment
    raw = out.getvalue()
    found = warc_zip.read_directory(reader(raw), len(raw))
    assert len(found) == members
    last = found[-1]
    at = warc_zip.data_start(reader(raw), last)
    assert raw[at : at + last.size] == f"body {members - 1}".encode()


def test_zip64_entries():
    """Sizes and places of an entry that stand in its extra field."""
    name, body = b"big", b"0123456789"
    import struct

    local = b"PK\x03\x04" + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, 10, 10) + body
    extra = struct.pack("<HHH", 9, 2, 5) + struct.pack("<HHQQQ", 1, 24, 10, 10, 0)
    entry = b"PK\x01\x02" + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(entry), len(local))
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, len(local) + len(entry), 1)
    raw = local + entry + end64 + locator + b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    (m,) = warc_zip.read_directory(reader(raw), len(raw))
    at = warc_zip.data_start(reader(raw), m)
    assert raw[at : at + m.size] == body


def test_compressed_members_and_broken_files_are_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("m", "body" * 100)
    raw = out.getvalue()
    with pytest.raises(ValueError):
        warc_zip.data_start(reader(raw), warc_zip.read_directory(reader(raw), len(raw))[0])
    with pytest.raises(ValueError):
        warc_zip.read_directory(reader(raw[:-30]), len(raw) - 30)


ARTICLE = """<html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body class="home">
<header id="top"><h1>Site</h1></header><nav><ul><li><a>Menu</a><li><a>More</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="content"><article class="post"><header><h1>Head &amp; line</h1><p>By one</p></header>
<p>First <b>bold</b>text&nbsp;here<br>after&#233;<p>Unclosed   second
line<div class="advert"><p>Buy</p></div><form>Name <input></form><ul><li>Entry one<li>Entry two</ul><!-- <p>no</p> --><p class="ad">Ad</p>
<section id="comments"><article class="comment"><p>Nice</p></article></section><p>a < b</p></article></div>
<aside>Side</aside><footer>&copy; Foot</footer></body></html>"""


def test_article_blocks():
    assert page_template.main_text(ARTICLE).split("\n\n") == [
        "Head & line", "First boldtext here afteré", "Unclosed second line", "Entry one", "Entry two", "a < b"
    ]
    assert page_template.main_text(None) == page_template.main_text("") == page_template.main_text("<p></p>") == ""
    assert page_template.main_text("plain <i>te</i>xt") == "plain text"
    assert page_template.main_text("<p>cut <b>off <a href='x") == "cut off"


def host_pages(n, host="h.example"):
    body = "<html><body><div><span>Welcome to our site</span></div><div><div>Story {0} has words {0} of {1}</div><div>Filed under news</div></div></body></html>"
    return [(i, f"https://{host}/p{i}", body.format(f"number{i}", "its own " * (i % 4))) for i in range(n)]


def test_template_blocks_go_and_slots_stay(spark):
    """Without an article element, blocks of template words are told by the equal occurrence vectors of their words."""
    rows = host_pages(20) + [(100 + i, f"http://few.example/{i}", p[2]) for i, p in enumerate(host_pages(3))]
    rows += [(200 + i, None, host_pages(1)[0][2]) for i in range(15)]  # equal pages: no template
    got = {r["page_id"]: r for r in page_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(20):
        assert got[i]["text"] == " ".join(f"Story number{i} has words number{i} of {'its own ' * (i % 4)}".split())
        assert got[i]["n_chars"] == len(got[i]["text"]) and got[i]["url"] == rows[i][1]
    assert got[100]["text"].startswith("Welcome to our site\n\nStory") and got[200]["text"].endswith("Filed under news")


def test_classes_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(host_pages(24), "page_id long, url string, html string")
    own = df.selectExpr("'h' as host", "cast(page_id as string) as page", "html")
    found = [page_template.templates(own.repartition(n, "page")).collect() for n in (1, 7)]
    assert set(found[0][0]["tokens"]) == set(found[1][0]["tokens"]) and len(found[0][0]["root"]) > 5


PLACES = [
    ('<p>Before <span class="ad">Buy</span> after the advert. <b>Bold</b> end.</p>', "Before after the advert. Bold end."),
    ('<p>x <button>OK</button> now <span class="share">S</span>then<svg><title>i</title><text>t</text></svg>.</p>', "x now then."),
    ("<p>an <svg><path/></svg> icon <svg>and one that never ends</p>", "an icon and one that never ends"),
    ("<body><form><nav>menu</nav><article><p>The text</p></article><aside>side</aside></form>", "The text"),
    ('<div aria-hidden="true"><main><p>The text</p></main></div>', "The text"),
    ('<div class="search"><article><p>The text</p></article></div><div>no</div>', "The text"),
    ('<div class="sidebar"><article><p>A longer teaser than the text</p></article></div><article><p>The text</p></article>', "The text"),
    ('<main><section id="search"><p>How search works</p></section></main>', "How search works"),
    ('<article><p>T</p></article><section id="comments"><article class="comment"><p>Nice</p></article></section>', "T"),
    ('<article><p>T</p></article><article class="comment-body"><p>Nice</p></article>', "T"),
    ('<div><p>T</p></div><div class="related-posts">r</div><div class="menu-bar">m</div><div class="siteFooter">f</div>', "T"),
    ('<div class="layout has-sidebar no-search"><p>T</p></div><p class="search-result-text">r</p>', "T\n\nr"),
    ('<article><header><h1><a href="x">Head</a></h1><p>by</p></header><p>b</p></article>', "Head\n\nb"),
    ('<article hidden><p>gone</p></article><article><p>T</p></article>', "T"),
]


@pytest.mark.parametrize("html, text", PLACES)
def test_places(html, text):
    """Inline elements take out their own text only; nothing that holds the only article is judged; whole and compound names."""
    assert page_template.main_text(html) == text


ENTRY = (
    "<html><body><div>Welcome to our site</div><article><h2>Summary</h2><p>Entry {0} says {0}</p><p>Read the method</p>"
    '<p><a href="/">Back to the list</a></p><p><a href="/{0}">more on {0}</a></p><section id="search"><p>Search this site</p></section></article></body></html>'
)


def test_template_inside_articles(spark):
    """In an article the template takes blocks of links and those that an id marks; headings and sentences of every page stay."""
    rows = [(i, f"https://a.example/{i}", ENTRY.format(f"n{i}")) for i in range(12)]
    got = page_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {
        i: f"Summary\n\nEntry n{i} says n{i}\n\nRead the method\n\nmore on n{i}" for i in range(12)
    }


def naive_classes(htmls, share=page_template.MIN_SHARE, least=page_template.MIN_CLASS):
    """Every occurrence vector written out, tokens grouped by equal vectors."""
    pages = [page_template.page_tokens(*page_template.parse(h)) for h in htmls]
    pages = [t for t, spans in pages if any(a < z for a, z in spans)]
    vectors = {t: tuple(p.count(t) for p in pages) for t in {t for p in pages for t in p}}
    groups = {}
    for t, v in [(0, (1,) * len(pages)), *vectors.items()]:
        groups.setdefault(v, set()).add(t)
    return {frozenset(g): v for v, g in groups.items() if sum(map(bool, v)) >= len(pages) * share - 1e-9 and (0 in g or len(g) >= least)}


@pytest.mark.parametrize("flush", [page_template._FLUSH, 1])
def test_classes_equal_occurrence_vectors(spark, monkeypatch, flush):
    """The signatures form the classes that the written-out vectors form, also if tasks say what they hold in parts."""
    monkeypatch.setattr(page_template, "_FLUSH", flush)
    item = "<li><b>Item</b> number {} of many</li>"
    htmls = {
        "a": [ENTRY.format(f"n{i}").replace("</article>", "<ul>" + "".join(item.format(j) for j in range(1 + i % 3)) + "</ul></article>") for i in range(20)],
        "b": [h for _, _, h in host_pages(11)] + ["", "<p></p>", "<p>odd page</p>"],
    }
    rows = [(h, f"{h}{i}", x) for h, own in htmls.items() for i, x in enumerate(own)]
    df = spark.createDataFrame(rows, "host string, page string, html string").repartition(3, "page")
    found = {r["host"]: r for r in page_template.templates(df).collect()}
    for host, own in htmls.items():
        classes = naive_classes(own)
        once = {t for g, v in classes.items() if max(v) == 1 for t in g}
        assert set(found[host]["root"]) == once and len(once) > 5
        assert {frozenset(x) for x in found[host]["nested"]} == {g for g, v in classes.items() if max(v) > 1}
    assert found["a"]["nested"]


def test_odd_pages(spark):
    """Repeated rows, a very long page, columns whose names clash with those of the operator."""
    long = "<article>" + "<p>word &amp; <span class='ad'>ad</span> more</p>" * 50_000 + "</article>"
    rows = [(1, "u", long, "x", 1, "y"), (2, "u", "<p>T</p>", "x", 2, "y"), (2, "u", "<p>T</p>", "x", 2, "y"), (3, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, page long, text string")
    got = sorted((r["page_id"], r["n_chars"], r["text"][:13]) for r in page_template.extract(df).collect())
    assert got == [(1, 50_000 * 11 + 49_999 * 2, "word & more\n\n"), (2, 1, "T"), (2, 1, "T"), (3, 0, "")]
