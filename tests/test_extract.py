import itertools
import json
import re

import pytest
from pyspark.sql import functions as F

from hearthlake.operators import extract as E
from hearthlake.sources.pages import url_lineage
from tests.conftest import item_list, page_html

ITEMS = [{"@id": "1", "name": "a"}, {"@id": "2", "name": "é"}, {"@id": "1", "name": "c"}]
LIST = item_list(*ITEMS)
WEB = '{"@type": "WebPage"}'


def extracted(spark, *htmls):
    df = spark.createDataFrame(list(enumerate(htmls)), "page_id int, html string")
    return E.keep_last_per_id(E.extract_pages(df))


def status(spark, html):
    return extracted(spark, html).first().status


@pytest.mark.parametrize(
    "html, want",
    [
        (page_html(WEB, LIST), "ok"),
        (page_html(WEB), "no_item_list"),
        (page_html("{not valid}"), "malformed_json"),
        (page_html(LIST, "{not valid}"), "malformed_json"),
        (page_html("", LIST), "ok"),
        (page_html("   ", LIST), "malformed_json"),
        (page_html("[1]", LIST), "ok"),
        (page_html(LIST + " trailing"), "malformed_json"),
        ("<!-- " + page_html("{bad") + " -->" + page_html(LIST), "ok"),
        ('<script>var a = "<!--";</script>' + page_html(LIST), "ok"),
        ("<style>a{}<!-- </style>" + page_html(LIST), "ok"),
        ("<SCRIPT id=x TYPE='application/ld+json' async>" + LIST + "</SCRIPT >", "ok"),
        ("<script type=application/ld+json>" + LIST + "</script>", "ok"),
        ('<script\n  type = "application/ld+json"\n>\n' + LIST + "\n</script>", "ok"),
        ('<script data-type="application/ld+json">{bad</script>' + page_html(LIST), "ok"),
        ('<script type="application/json">{bad</script>' + page_html(LIST), "ok"),
        ('<script type="application/ld+json; v=1">{bad</script>' + page_html(LIST), "ok"),
        ("no scripts", "no_item_list"),
        ("", "no_item_list"),
        (None, "no_item_list"),
    ],
)
def test_page_status(spark, html, want):
    assert status(spark, html) == want


def test_listings_are_indexed_by_id_and_the_last_wins(spark):
    rows = E.explode_listings(extracted(spark, page_html(WEB, LIST))).select(
        "listing_id", "pos", F.try_variant_get("listing", "$.name", "string").alias("name")
    )
    assert sorted(map(tuple, rows.collect())) == [("1", 2, "c"), ("2", 1, "é")]


def test_first_item_list_counts(spark):
    other = item_list({"@id": "9"})
    rows = E.explode_listings(extracted(spark, page_html(LIST, other)))
    assert {r.listing_id for r in rows.collect()} == {"1", "2"}


def test_bad_pages_have_no_listings(spark):
    pages = extracted(spark, page_html(WEB), page_html(LIST, "{"), page_html(item_list()))
    assert E.explode_listings(pages).count() == 0


def test_elements_without_id_go_to_quarantine(spark):
    html = page_html(item_list({"name": "x"}, {"@id": "1"}, {"name": "y"}))
    good, quarantine = E.split_by_id(E.explode_listings(extracted(spark, html)))
    assert [r.listing_id for r in good.collect()] == ["1"]
    assert sorted(r.pos for r in quarantine.collect()) == [0, 2]


def test_long_pages_and_long_tags(spark):
    filler = "<p>" + "x" * 2_000_000 + "</p>"
    tag = "<script " + "a" * 200_000 + ' type="application/ld+json">' + LIST + "</script>"
    assert status(spark, filler + tag + filler) == "ok"


def test_repeated_ids_against_brute_force(spark):
    items = [{"@id": str(i * i % 7), "name": str(i)} for i in range(200)]
    rows = E.explode_listings(extracted(spark, page_html(item_list(*items)))).select(
        "listing_id", F.try_variant_get("listing", "$.name", "string").alias("name")
    )
    want = {item["@id"]: item["name"] for item in items}
    got = [tuple(r) for r in rows.collect()]
    assert len(got) == len(want) and dict(got) == want


def test_extraction_neither_shuffles_nor_parses_twice(spark, plan_of):
    df = spark.createDataFrame([(1, "")], "page_id int, html string")
    plan = plan_of(E.explode_listings(E.keep_last_per_id(E.extract_pages(df))))
    assert "Exchange" not in plan
    assert plan.count("regexp_extract_all") == 1


def test_a_filter_on_what_is_extracted_does_not_parse_again(spark, plan_of):
    pages = spark.createDataFrame([(1, page_html(LIST)), (2, page_html(WEB)), (3, None)], "page_id int, html string")
    sizes = E.extract_pages(pages).select("page_id", F.size("elements").alias("n")).where("n >= 0")
    kinds = E.parsed_blocks(pages, "blocks").select("page_id", F.posexplode("blocks").alias("pos", "body")).where("body IS NOT NULL")
    for rows in (sizes, kinds):
        assert plan_of(rows, "simple").count("regexp_extract_all") == 1
    assert [tuple(r) for r in sizes.collect()] == [(1, len(ITEMS))]
    assert sorted((r.page_id, r.pos) for r in kinds.collect()) == [(1, 0), (2, 0)]


def test_every_token_is_told_apart_as_by_one_pattern_each(spark):
    # A token of each kind in each order, also in other cases, unclosed and next to other angle brackets.
    script = "<script type='application/ld+json'>%s</script>"
    parts = [
        "<!-- a --", "-->", script % "[1]", (script % '{"b": 2}').upper().replace("LD+JSON", "ld+json").replace("APPLICATION", "application"),
        "<script>x</script >", "<STYLE>y</style>", "<style", "<p>", "<", "<script", ">",
    ]
    htmls = ["".join(order) for order in itertools.permutations(parts, 3)]
    each = [
        r"<!--.*?-->",
        r"""<(?i:script)\b(?=[^>]*?(?<=[\s"'])(?i:type)\s*=\s*(?:"application/ld\+json"|'application/ld\+json'|application/ld\+json(?=[\s>])))[^>]*>(.*?)</(?i:script)\s*>""",
        r"<(?i:script)\b[^>]*>.*?</(?i:script)\s*>",
        r"<(?i:style)\b[^>]*>.*?</(?i:style)\s*>",
    ]
    want = [[m[1] for m in re.finditer("|".join(each), html, re.S) if m[1]] for html in htmls]
    df = spark.createDataFrame(list(enumerate(htmls)), "n int, html string").select("n", E.jsonld_blocks(F.col("html")).alias("b"))
    got = {r.n: r.b for r in df.collect()}
    assert [got[n] for n in range(len(htmls))] == want


@pytest.mark.parametrize(
    "url, want",
    [
        (
            "https://www.vivareal.com.br/aluguel/rj/macae/apartamento_residencial/?pagina=3",
            ("vivareal", "rj", "macae", "apartment", 3),
        ),
        ("https://www.vivareal.com.br/aluguel/rj/macae/casa_residencial/", ("vivareal", "rj", "macae", "house", 1)),
        ("https://www.zapimoveis.com.br/aluguel/apartamentos/rj+macae/?pagina=12", ("zapimoveis", "rj", "macae", "apartment", 12)),
        ("https://www.zapimoveis.com.br/aluguel/casas/rj+macae/", ("zapimoveis", "rj", "macae", "house", 1)),
        ("https://www.zapimoveis.com.br/aluguel/casa_residencial/rj+macae/", ("zapimoveis", "rj", "macae", None, 1)),
        ("https://www.elsewhere.com.br/aluguel/casas/rj+macae/", (None, None, None, None, 1)),
        ("not a url at all", (None, None, None, None, 1)),
    ],
)
def test_url_lineage(spark, url, want):
    row = url_lineage(spark.createDataFrame([(url,)], "url string")).first()
    assert (row.site, row.state, row.city, row.property_type, row.page) == want


def test_payload_survives_json(spark):
    item = {"@id": "1", "deep": {"a": [1, {"b": None}]}, "text": 'quote " and \\ and é'}
    row = E.explode_listings(extracted(spark, page_html(item_list(item)))).select(F.to_json("listing").alias("t")).first()
    assert json.loads(row.t) == item
