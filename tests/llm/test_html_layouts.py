"""Articles whose text lies in several containers, and pages whose winning container is empty."""

import pytest

from regiostar.llm import html_consensus

LONG = "A long passage of the article, longer than all else. " * 4
BODY = LONG.strip()


@pytest.mark.parametrize(
    "inner",
    [
        f"<article><h1>T</h1><div class=body>{LONG}</div></article>",
        f"<article><section class=intro><h1>T</h1></section><section class=main>{LONG}</section></article>",
        f"<main><h1>T</h1><article><div><p>{LONG}</div></article></main>",
        f"<main><div class=top>T</div><div class=body>{LONG}</div></main>",
        f"<div class=post><h1><a href=/t>T</a></h1><div class=body>{LONG}</div></div>",
        f"<div class=post><section class=intro>T</section><section class=main>{LONG}</section></div>",
        f"<section class=intro>T</section><section class=main>{LONG}</section>",
        f"<h1>T</h1><div class=body>{LONG}</div>",
    ],
)
@pytest.mark.parametrize("frame", ["<html><body><nav>n</nav>{}<footer>f</footer></body></html>", "<nav>n</nav>{}<footer>f</footer>"])
def test_all_of_the_article_is_kept(spark, inner, frame):
    page = frame.format(inner)
    assert html_consensus.extract(page, None) == f"T\n\n{BODY}"
    pages = spark.createDataFrame([(1, "http://a.org/x", page)], "page_id long, url string, html string")
    assert [r.text for r in html_consensus.extracted(pages).collect()] == [f"T\n\n{BODY}"]


def test_what_lies_outside_the_article_stays_out():
    html = f"<body><h1>Site</h1><div class=top>top</div><main><div class=box>box</div><article><h1>T</h1><div class=body>{LONG}</div></article></main></body>"
    assert html_consensus.extract(html, None) == f"T\n\n{BODY}"
    html = f"<body><div class=top>top</div><div class=wrap><div class=misc>misc</div><div class=body><p>{LONG}</div></div></body>"
    assert html_consensus.extract(html, None) == BODY


def test_a_winning_container_without_text_falls_back():
    html = f"<body><article></article><div class=body><p>{LONG}</div></body>"
    assert html_consensus.extract(html, "body>article") == BODY


NAMES = ["content with-sidebar", "no-sidebar", "page-header-layout", "post tags-news", "site-legal", "has-social", "story alert-free"]


@pytest.mark.parametrize("attribute", ["class", "id"])
@pytest.mark.parametrize("name", NAMES)
def test_names_of_wrappers_do_not_discard_the_article(name, attribute):
    inner = f"<div class=sidebar>links and more</div><h1>T</h1><article>{LONG}<p>{LONG}</p></article><div class=comments>a reader</div>"
    html = f'<body><div class="site-footer">legal</div><div {attribute}="{name}">{inner}</div><div class=share>share</div></body>'
    assert html_consensus.extract(html, None) == f"{BODY}\n\n{BODY}"  # the article, as beside it only the headline
    nested = f'<body><div class="no-sidebar"><div {attribute}="{name}"><div><h1>T</h1><p>{LONG}</p></div></div></div></body>'
    assert html_consensus.extract(nested, None) == f"T\n\n{BODY}"


def test_long_comments_stay_out_and_a_page_of_names_keeps_its_text():
    html = f"<body><article><h1>T</h1><p>{LONG}</p></article><div class=comments>{LONG * 5}</div></body>"
    assert html_consensus.extract(html, None) == f"T\n\n{BODY}"
    assert html_consensus.extract(f"<body><div class=notice>{LONG}</div></body>", None) == BODY
    assert html_consensus.extract(f"<body><nav>{LONG}</nav></body>", None) == ""


def test_deep_pages_take_linear_memory_and_time():
    html = "<body>" + "<div>" * 100_000 + LONG
    assert html_consensus.extract(html, None) == BODY
    many = "<body><article>" + "".join(f"<div class=c{'abc'[i % 3]}><p>{LONG}" for i in range(300)) + "</section></i>" * 20_000
    assert html_consensus.extract(many, None).count(BODY) == 300


def test_votes_of_a_host_of_several_layouts(spark):
    """The winner by hand: each page's own best container, most votes, then the larger score, then the smaller path."""
    layouts = [f"<body><article><h1>T{i}</h1><p>{LONG * (1 + i % 3)}</p></article></body>" for i in range(5)]
    layouts += [f"<body><div class=post{i}><h1>U{i}</h1><p>{LONG * 9}</p></div></body>" for i in range(4)]
    layouts += [f"<body><main><p>{LONG}</p></main></body>", "<body></body>", ""]
    hosts = {"http://a.org/x": layouts, "http://b.org/": layouts[5:], None: layouts[9:]}
    rows = [(i, url, page) for i, (url, page) in enumerate((u, p) for u, pages in hosts.items() for p in pages)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    won = {r.host: r.winner for r in html_consensus.winners(pages).collect()}
    for url, own in hosts.items():
        tally = {}
        for page in own:
            best = html_consensus.best_container(html_consensus.parse(page)) if page else None
            if best:
                votes, score = tally.get(best[0], (0, 0))
                tally[best[0]] = (votes + 1, score + int(best[1]))
        top = max(tally.values())
        assert won[url.split("/")[2] if url else ""] == min(p for p, t in tally.items() if t == top)
