from urllib.parse import urlsplit

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekly_mart.llm.html_blocks import ARTICLE, FURNITURE, OPEN, blocks
from weekly_mart.llm.html_extract import ARTICLE_SHARE, CONFIDENCE, OPEN_SHARE, extract_text, suffix_groups

PAGE = (
    '<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var x="</p>";</script></head><body>'
    '<header><h1>Site</h1></header><nav><ul><li><a href="/a>b">Menu</a></li></ul></nav><!-- ad <p>no</p> -->'
    '<div class="ad">Buy &amp; win</div><aside>side</aside>'
    "<article><h1>Title &lt;one&gt;</h1><p>First  <b>bold</b>\n text<br>goes&nbsp;on<p>Second &eacute;"
    '<form><input value="x">Sign up</form><div class="cookie-notice">We use cookies</div>'
    "<ul><li>item</ul></article>"
    '<section id="comments"><p>I disagree</p></section><footer>&copy; me</footer></body></html>'
)
EXPECTED = "Title <one>\n\nFirst bold text goes on\n\nSecond é\n\nitem"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_marked_articles(spark):
    got = extract_text(pages(spark, [(1, "https://a.example/1", PAGE)])).first()
    assert got["text"] == EXPECTED
    assert got["n_chars"] == len(EXPECTED)


def test_broken_markup():
    kept = lambda page: [t for where, t in blocks(page) if where == ARTICLE]
    assert kept("<nav><ul><li>menu<article><p>text</article>") == ["text"]
    assert kept("<article><p>a < b and c > d</p><p>no end") == ["a < b and c > d", "no end"]
    assert kept('<article><p title="x>y">in</p><p "odd>out</p></article>')[0] == "in"
    assert kept("<article><script>never closed <p>x</p>") == []
    assert blocks("plain text") == [(OPEN, "plain text")]
    assert blocks("<div class='side-bar'>x</div>y") == [(FURNITURE, "x"), (OPEN, "y")]
    assert blocks("") == []


def test_open_pages_lose_what_their_host_repeats(spark):
    menu = "<div>home products about us contact our team and find us here</div>"
    rows = [(i, "https://a.example/x", f"{menu}<div>own text number {i} with its words t{i} u{i} v{i} w{i}</div>") for i in range(6)]
    rows += [(9, "https://b.example/x", f"{menu}<div>the only page of its host</div>")]
    for words in (50_000, 40):  # one suffix array, and several for one host
        got = {r["page_id"]: r["text"] for r in extract_text(pages(spark, rows), array_words=words).collect()}
        assert got[3] == "own text number 3 with its words t3 u3 v3 w3"
        assert got[9].startswith("home products") and got[9].endswith("of its host")


def brute(rows, depth):
    """Text of each page: every run of every page looked for in all distinct pages of its host."""
    hosts, found = {}, [blocks(h or "") for _, _, h in rows]
    host_of = [(urlsplit(u or "").netloc or "").lower() for _, u, _ in rows]
    for host, page in zip(host_of, found, strict=True):
        if page:
            hosts.setdefault(host, {})[repr(page)] = [t.split(" ") for _, t in page]

    def runs(w):
        return [(i, tuple(w[i : i + depth])) for i in range(max(1, len(w) - depth + 1))]

    def reaches(k, n, share):
        p, z2 = k / n, CONFIDENCE
        return (p + z2 / (2 * n) - (z2 * (p * (1 - p) / n + z2 / (4 * n * n))) ** 0.5) / (1 + z2 / n) >= share - 1e-12

    seen = {}
    for host, pages_of in hosts.items():
        for name, page in pages_of.items():
            for w in page:
                for _, r in runs(w):
                    seen.setdefault((host, r), set()).add(name)
    out = []
    for (page_id, _, _), host, page in zip(rows, host_of, found, strict=True):
        kept = []
        for where, t in page:
            if where == FURNITURE:
                continue
            w = t.split(" ")
            gone = set()
            for i, r in runs(w):
                if reaches(len(seen[host, r]), len(hosts[host]), ARTICLE_SHARE if where == ARTICLE else OPEN_SHARE):
                    gone |= set(range(i, i + len(r)))
            kept.append(" ".join(x for k, x in enumerate(w) if k not in gone))
        out.append((page_id, "\n\n".join(t for t in kept if t)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("array_words", [50_000, 60])
def test_pages_against_brute_force(spark, array_words):
    rng = np.random.default_rng(3)
    word = lambda n: " ".join(rng.choice(["a", "b", "c"], n))
    notices = [word(6) for _ in range(6)]
    rows = []
    for k in range(60):
        host = ["a", "b", "c", "d"][min(k % 7, 3)]
        parts = [word(rng.integers(1, 12)) for _ in range(4)] + [n for j, n in enumerate(notices) if rng.random() < j / 5]
        body = "".join(f"<p>{x}</p>" for x in parts)
        rows.append((k, f"https://{host}.example/{k}", f"<div>{word(3)}</div>" + (f"<article>{body}</article>" if k % 2 else body)))
    rows += [(100 + k, *rows[5][1:]) for k in range(9)] + [(200, "https://two.example/1", "<p>a b c d e</p>"), (201, "https://two.example/2", "<p>a b c d e</p><p>x</p>")]
    got = extract_text(pages(spark, rows), run_words=4, array_words=array_words).collect()
    assert sorted(((r["page_id"], r["text"]) for r in got), key=repr) == brute(rows, 4)


def test_the_given_pages_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in docs.collect()]
    got = extract_text(docs).collect()
    assert sorted(((r["page_id"], r["text"]) for r in got), key=repr) == brute(rows, 8)


def test_suffix_ranks():
    stream = np.array([5, 6, 5, 6, 5, 7, 5, 6], np.uint64)
    rank = suffix_groups(stream, 2)
    assert rank[0] == rank[2] == rank[6] and rank[1] == rank[3] and len(set(rank)) == 5


def test_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (2, "", ""), (None, "https://a/x", PAGE), (4, "https://a/x", "<p>"),
            (5, "no url", "x" * 100_000), (6, "https://a/y", PAGE), (6, "https://a/y", PAGE)]
    docs = pages(spark, rows).withColumn("key", F.lit("x")).withColumn("text", F.lit("x")).withColumn("host", F.lit(1))
    got = sorted(((r["page_id"], r["text"]) for r in extract_text(docs).collect()), key=repr)
    assert got == sorted(
        [(1, ""), (1, ""), (2, ""), (None, EXPECTED), (4, ""), (5, "x" * 100_000), (6, EXPECTED), (6, EXPECTED)], key=repr
    )
    assert extract_text(pages(spark, [])).collect() == []


def test_copies_and_shared_passages_stay_on_open_pages(spark):
    # body in plain divs: copies count as one page, a passage of two pages is no boilerplate
    # and the unique half of a block that holds the notice of all pages stays
    passage = "a passage that two pages of this host quote word for word in full"
    notice = "this notice stands on every single page of the host"
    own = [f"own{i} text{i} of{i} page{i} number{i} with{i} its{i} words{i}" for i in range(8)]
    rows = [(i, "https://a.example/x", f"<div>{own[i]} {notice}</div>") for i in range(6)]
    rows += [(i, "https://a.example/x", f"<div>{own[i]}</div><div>{passage}</div>") for i in (6, 7)]
    rows += [(i, "https://c.example/x", "<p>the same page with the same words as a copy of it</p>") for i in range(10, 16)]
    for words in (50_000, 40):
        got = {r["page_id"]: r["text"] for r in extract_text(pages(spark, rows), array_words=words).collect()}
        assert [got[i] for i in range(6)] == own[:6]
        assert [got[i] for i in (6, 7)] == [f"{own[i]}\n\n{passage}" for i in (6, 7)]
        assert all(got[i] == "the same page with the same words as a copy of it" for i in range(10, 16))


def test_arrays_decide_beside_and_inside_articles(spark):
    menu = "<div>home products about us contact our team and find us here</div>"
    notice = "this unclassed notice stands inside every article of the host"
    own = [f"own{i} text{i} of{i} page{i} number{i} with{i} its{i} words{i}" for i in range(12)]
    passage = "a passage that most but not all articles of this host hold in full"
    rows = [
        (i, "https://a.example/x", f"{menu}<div>lead {i}</div><article><p>{own[i]}</p><p>{notice}</p>"
         + (f"<p>{passage}</p>" if i < 10 else "") + "</article>")
        for i in range(11)
    ]
    rows += [(20 + i, "https://a.example/x", rows[0][2]) for i in range(30)]
    rows += [(60 + i, "https://b.example/x", f"<article><p>{own[i]}</p><p>{passage}</p></article>") for i in range(9)]
    rows += [(70 + i, "https://c.example/x", f"<article><p>{own[i]}</p>" + (f"<p>{passage}</p>" if i < 8 else "") + "</article>")
             for i in range(12)]
    for words in (50_000, 60):
        got = {r["page_id"]: r["text"] for r in extract_text(pages(spark, rows), array_words=words).collect()}
        assert got[10] == f"lead 10\n\n{own[10]}"
        assert all(got[20 + i] == got[0] for i in range(30)) and got[0].startswith(f"lead 0\n\n{own[0]}") and notice not in got[0]
        assert got[60] == f"{own[0]}\n\n{passage}" and got[70] == f"{own[0]}\n\n{passage}"


def test_modifier_classes_and_marked_wrappers_keep_the_article():
    kept = lambda page: [t for where, t in blocks(page) if where == ARTICLE]
    assert kept("<div class='layout has-sidebar'><article><p>body</p></article></div>") == ["body"]
    for name in ("post category-social", "post ad-free", "post social", "tag-sponsored"):
        assert kept(f"<article class='{name}'><p>body</p></article>") == ["body"]
        assert kept(f"<main id='x' class='{name}'><p>body</p></main>") == ["body"]
    # a wrapper with a whole furniture name opens for the article where the page has no other
    assert kept("<div class='widget'><p>w</p><article><p>body</p></article><p>x</p></div>") == ["body"]
    page = "<article><p>body</p></article><div class='related'><article><p>teaser</p></article></div>"
    assert kept(page) == ["body"]
    assert kept("<div>text</div><section id='comments'><article class='comment'>no</article></section>") == []
    assert kept("<aside><article><p>side</p></article></aside>") == []
    for name in ("ad", "top-ad", "ad-slot-3", "cookie-notice", "site-footer", "main-nav", "comment-list", "x share-buttons y"):
        assert blocks(f"<div class='{name}'>x</div>") == [(FURNITURE, "x")]
    for name in ("has-sidebar", "no-comments", "ad-free", "category-social", "post-with-footer", "menuhin", "content"):
        assert blocks(f"<div class='{name}'>x</div>") == [(OPEN, "x")]


def test_a_large_host_is_shuffled_in_passes(spark, tmp_path, monkeypatch):
    from weekly_mart.llm import html_extract

    # one host, whose blocks are about all that the pages hold; written tables are watched
    rng = np.random.default_rng(8)
    word = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**9, n))
    notice = "this notice stands on every single page of the host"
    rows = [(i, "https://a.example/x", f"<div>{word(200)}</div><div>{notice}</div>") for i in range(60)]
    rows += [(100 + i, *rows[0][1:]) for i in range(40)]
    written, plain = [], html_extract.materialise

    def watched(df, name, **options):
        out = plain(df, name, **options)
        if "blocks" in out.columns or "texts" in out.columns:
            written.append(name)
        if name in ("page-cells", "page-runs"):
            written.append((name, df._jdf.queryExecution().optimizedPlan().toString().count("xxhash64(10")))
        return out

    monkeypatch.setattr(html_extract, "materialise", watched)
    got = {r["page_id"]: r["text"] for r in extract_text(pages(spark, rows), array_words=600).collect()}
    assert got == {i: h[len("<div>") : h.index("</div>")] for i, _, h in rows}
    # blocks are written once, and no shuffle is of all pages
    assert [x for x in written if isinstance(x, str)] == ["page-blocks"]
    passes = [x for x in written if not isinstance(x, str)]
    assert len(passes) == 2 * html_extract.PASSES and all(n >= 1 for _, n in passes)
