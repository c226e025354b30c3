"""HTML extraction rules: class matching, text, entities, tree shape."""

import pytest
from pyspark.sql import functions as F

from pricelens.functions import html as H
from pricelens.functions.html import parse_tree
from pricelens.operators import extract as X
from pricelens.schemas import STORE_A_CARD_CLASSES, STORE_A_FIELDS


def _records(spark, html, fields, container=None):
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    return [r.asDict() for r in H.records(df, fields, container=container, keep=["page_id"]).orderBy("ord").collect()]


def test_text_joins_descendants_without_trim(spark):
    html = "<div class='x'> a<b>b</b> <i>c</i>&amp;d<script>var s='<p>';</script><!-- no --></div>"
    got = _records(spark, html, {"t": {"class": "x"}})
    assert got[0]["t"] == " ab c&d"


def test_class_rules(spark):
    html = (
        '<p class="css-150rkla chakra-text">decoy</p>'
        '<p class="chakra-text  css-150rkla">hit</p>'
        '<p class="a b c">abc</p>'
    )
    got = _records(spark, html, {"whole": {"class": "chakra-text css-150rkla"}, "word": {"class": "b"}, "none": {"class": "a c"}})
    assert got[0]["whole"] == "hit" and got[0]["word"] == "abc" and got[0]["none"] is None


def test_unclosed_tags_and_void(spark):
    t = parse_tree("<p><b>one<br>two<p>three</div>")
    texts = {t.tags[i]: t.text(i) for i in range(len(t.tags))}
    assert texts["b"] == "onetwothree" and texts["br"] == ""


def test_containers_nth_up_find(spark):
    html = (
        "<li class='item product product-item'><a>no href</a><a href='/1'>x</a><img class='product-image-photo' src='i1'></li>"
        "<li class='item product product-item'><a href='/2'>y</a></li>"
        "<table><tr><th>Brand</th><td>B</td><td>x</td></tr><tr><th>Name</th><td>N</td></tr></table>"
        "<span class='price'>$3</span><span class='price'>$5</span>"
    )
    cards = _records(
        spark,
        html,
        {"url": {"tag": "a", "has_attrs": ["href"], "get": "@href"}, "img": {"tag": "img", "get": "@src"}},
        container={"tag": "li", "class": "item product product-item"},
    )
    assert [(c["ord"], c["url"], c["img"]) for c in cards] == [(0, "/1", "i1"), (1, "/2", None)]
    page = _records(
        spark,
        html,
        {
            "brand": {"tag": "th", "nth": 0, "up": 1, "find": {"tag": "td"}},
            "name": {"tag": "th", "nth": 1, "up": 1, "find": {"tag": "td"}},
            "unit": {"tag": "th", "nth": 2, "up": 1, "find": {"tag": "td"}},
            "p2": {"tag": "span", "class": "price", "nth": 1},
            "n": {"tag": "span", "class": "price", "get": "count"},
        },
    )[0]
    assert (page["brand"], page["name"], page["unit"], page["p2"], page["n"]) == ("B", "N", None, "$5", "2")


def test_elements_rows(spark):
    df = spark.createDataFrame([(1, '<nav><a data-testid="nav-list-link" href="/a">See All</a><a href="/b">See All </a></nav>')], "page_id long, html string")
    rows = H.elements(df, "a", keep=["page_id"]).select("pos", "parent", F.col("attrs")["href"].alias("h"), "text").collect()
    assert [(r.pos, r.parent, r.h, r.text) for r in rows] == [(1, 0, "/a", "See All"), (2, 0, "/b", "See All ")]


def test_store_b_price_pair(spark):
    from pricelens.operators import extract as X

    pages = spark.createDataFrame(
        [
            (1, "u1", "<span class='price'>$3</span><span class='price'>$5</span>" + "".join(f"<tr><th>{i}</th><td>v{i}</td></tr>" for i in range(4))),
            (2, "u2", "<span class='price'>$5</span>" + "".join(f"<tr><th>{i}</th><td>v{i}</td></tr>" for i in range(4))),
            (3, "u3", "<p>nothing</p>"),
        ],
        "page_id long, url string, html string",
    )
    got = {r.page_id: r for r in X.store_b_products(pages, keep=["page_id"]).collect()}
    assert (got[1].prd_price, got[1].org_price, got[1].prd_discount, got[1].on_sale_cat) == ("$3", "$5", True, "SAVING")
    assert (got[2].prd_price, got[2].org_price, got[2].prd_discount, got[2].on_sale_cat) == ("$5", "$5", False, None)
    assert got[3].reject_reason == "missing:prd_price"
    assert got[1].prd_id_in_store == "v3"


def test_page_code_ships_by_value():
    # executors' Python workers must not need this package on their path
    from pyspark import cloudpickle

    assert "pricelens.functions.html" in cloudpickle.list_registry_pickle_by_value()


def test_repeated_attribute_keeps_last_value():
    t = parse_tree('<a href="/first" href="/last" class="x" class="y z">t</a>')
    assert t.attrs[0]["href"] == "/last" and t.cls[0] == "y z"


def test_pager_heading_and_notice(spark):
    from pricelens.operators import extract as X

    card = '<div class="chakra-linkbox css-wsykbb x"><a class="chakra-linkbox__overlay css-1hnz6hu" href="/p/1_EA">v</a></div>'
    page = '<nav><button>m</button></nav><div id="site-content"><h2 class="a chakra-heading css-zmvp7m b"> Fruit\n</h2><p class="chakra-text css-29j2bl z">{}</p>' + card
    pager = "<nav>" + "<button>1</button>" * 5 + "</nav></div>"
    rows = [
        (1, "https://www.loblaws.ca/c/1/all?page=2", page.format("2 items") + pager),
        (2, "u2", page.format(" No items are available.\n") + "</div>"),
        (3, "u3", "<nav><button>m</button></nav><div id='site-content'><nav><button>1</button></nav></div>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    info = {r.page_id: (r.has_pager, r.n_pages) for r in X.store_a_page_info(pages).collect()}
    assert info == {1: (True, 3), 2: (False, 1), 3: (True, 0)}
    head = '<h2 class="chakra-heading css-zmvp7m"> Food </h2><a data-testid="nav-list-link" href="/c/1/all">See All</a>'
    heads = spark.createDataFrame([(8, head.replace("Food", "Other")), (7, head)], "page_id long, html string")
    got = X.store_a_cards(pages, heads).collect()
    assert [(r.page_id, r.category, r.sub_category) for r in got] == [(1, "Food", "Fruit")]
    assert X.store_a_cards(pages).first().category is None


def test_store_b_takes_the_latest_capture(spark):
    import datetime as dt

    from pricelens.operators import extract as X

    spec = "".join(f"<tr><th>{i}</th><td>v{i}</td></tr>" for i in range(4))
    listing = spark.createDataFrame(
        [(1, '<span class="base">Cat</span><li class="item product product-item"><a href="u1"></a><img class="product-image-photo" src="i"></li>')], "page_id long, html string"
    )
    at = lambda d: dt.datetime(2024, 7, d, 3)
    products = spark.createDataFrame(
        [("u1", f"<span class='price'>$3</span>{spec}", at(2)), ("u1", f"<span class='price'>$9</span>{spec}", at(1))],
        "url string, html string, captured_at timestamp_ntz",
    )
    rows = X.EXTRACTORS["HMart"](listing, products).collect()
    assert [(r.prd_price, str(r.scrap_date), r.category, r.reject_reason) for r in rows] == [("$3", "2024-07-01", "Cat", None)]


def test_no_page_is_lost(spark):
    odd = [None, "", " \n", "no markup at all", "<p>x</p>", "<a href=1>a</a>" * 3, "<![foo[x]]><a href=1>a</a>", "<a href=1>a</a><![", "&#" + "9" * 5000 + ";<a href=1>", "<a href=1>" * 4 + "z", "<a href=1>a</a><a hre"]
    df = spark.createDataFrame(list(enumerate(odd)), "page_id long, html string")
    rows = H.page_records(df, {"n": {"tag": "a", "get": "count", "scope": "page"}, "t": {"self": True}}, container={"tag": "a", "has_attrs": ["href"]}).cache()
    good, bad = H.split_pages(rows)
    assert good.columns == ["page_id", "rec", "ord", "n", "t"] and bad.columns == ["page_id", "n", "t", "page_reject", "page_html"]
    reasons = {r.page_id: r.page_reject for r in bad.collect()}
    assert reasons == {0: "page:missing", 1: "page:empty", 2: "page:empty", 3: "page:no_markup", 4: "page:no_records", 8: "page:unreadable:ValueError"}
    assert {r.page_id: r.page_html for r in bad.collect()} == {i: odd[i] for i in reasons}
    assert sorted((r.page_id, r.ord) for r in good.collect()) == [(5, 0), (5, 1), (5, 2), (6, 0), (7, 0), (9, 0), (9, 1), (9, 2), (9, 3), (10, 0)]
    assert [r.n for r in bad.where("page_id = 4").collect()] == ["0"]  # page-level fields are read as far as they go
    assert H.page_records(df.limit(0), {}).count() == 0


def test_cards_and_pages_set_apart(spark):
    f = STORE_A_FIELDS
    card = f'<div class="{" ".join(STORE_A_CARD_CLASSES)}"><h3 class="{f["prd_name"]}">n</h3></div>'
    pages = spark.createDataFrame([(1, "u1", card), (2, "u2", "<p>busy</p>"), (3, "u3", None)], "page_id long, url string, html string")
    good, bad = X.split_cards(X.store_a_cards(pages, keep=["page_id", "url"], page_rejects=True))
    assert good.count() == 0
    got = {r.page_id: r for r in bad.collect()}
    assert {i: r.reject_reason for i, r in got.items()} == {1: "missing:prd_price", 2: "page:no_records", 3: "page:missing"}
    assert got[1].raw["prd_name"] == "n" and got[1].page_html is None and got[2].page_html == "<p>busy</p>" and got[2].raw is None
    only_cards = X.store_a_cards(pages)
    assert "page_html" not in only_cards.columns and only_cards.count() == 1


@pytest.mark.parametrize("unit", ['<a href="x" data-testid="nav-list-link">See All', "<div class='a b'>", "</p>", "<li>", "<a ", "<!--", "<![", "<p></span>", "&#x41;"])
def test_time_is_linear_in_the_page(unit):
    import time

    fields = {"href": {"tag": "a", "get": "@href"}, "no": {"tag": "i", "class": "b"}, "n": {"tag": "a", "get": "count"}, "deep": {"class": "b", "nth": 3, "up": 1, "get": "@class"}}
    took = []
    for n in (12_500, 50_000):
        start = time.process_time()
        rows = list(H.iter_records("<nav>" + unit * n, {"class": "a"}, fields))
        links = list(H.iter_elements("<nav>" + unit * n, "a", {"attrs": {"data-testid": "nav-list-link"}, "text": "See All"}))
        took.append(time.process_time() - start)
    assert took[1] < 10 and took[1] < 12 * took[0] + 0.5
    if "href" in unit:
        assert len(links) == 1 and len(rows) == 0  # of nested links the innermost has just that text
    if "a b" in unit:
        assert len(rows) == n and rows[0][2]["n"] == "0"


def _walk(tree, spec, lo, hi):
    """First principles: every element of the interval is looked at."""

    def fits(i):
        return (
            spec.get("tag") in (None, tree.tags[i])
            and (spec.get("class") is None or spec["class"] == tree.cls[i] or spec["class"] in tree.cls[i].split())
            and all(c in tree.cls[i].split() for c in spec.get("all_classes", ()))
            and all(tree.attrs[i].get(k) == v for k, v in spec.get("attrs", {}).items())
            and all(k in tree.attrs[i] for k in spec.get("has_attrs", ()))
            and spec.get("text") in (None, tree.text(i))
        )

    return [i for i in range(lo, hi) if fits(i)]


def test_index_agrees_with_a_walk():
    import random

    rnd = random.Random(4)
    tags, classes = ["a", "p", "li", "br", "script"], ["", ' class="x"', ' class="x y"', ' class=" y  x "', ' href="1"', ' href="2" class="y"']
    specs = [{"tag": "a"}, {"class": "x"}, {"class": "x y"}, {"all_classes": ["x", "y"]}, {"tag": "p", "class": "y"}, {"attrs": {"href": "1"}}, {"has_attrs": ["href"], "class": "y"}, {"text": "t"}, {}]
    for _ in range(60):
        page = "".join(rnd.choice([f"<{rnd.choice(tags)}{rnd.choice(classes)}>", f"</{rnd.choice(tags)}>", "t", " "]) for _ in range(rnd.randrange(1, 60)))
        tree = parse_tree(page)
        n = len(tree.tags)
        for spec in specs:
            for lo, hi in [(0, n)] + [(i + 1, tree.last[i]) for i in range(n)]:
                want = _walk(tree, spec, lo, hi)
                assert H._Selector({**spec, "get": "count"}).value(tree, lo, hi) == str(len(want))
                for nth in (0, 2):
                    assert H._Selector({**spec, "nth": nth}).value(tree, lo, hi) == (tree.text(want[nth]) if nth < len(want) else None)
