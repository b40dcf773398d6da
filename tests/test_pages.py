import pytest

from marketloom.sources import pages as P


def listing(container, inner):
    return f"<html><body><{container}>{inner}</{container.split()[0]}></body></html>"


@pytest.mark.parametrize("container", ['div class="c-p"', 'div class="x prd-card"', 'li class="prd-li"', "div data-ggl"])
@pytest.mark.parametrize(
    "name, title",
    [
        ('<a class="pn" href="/1"> Pump <b>A</b></a>', "PumpA"),
        ('<span class="prd-name">Pump</span>', "Pump"),
        ('<h2>x<a href="/2">Pump</a></h2>', "Pump"),
        ('<a title="Pump"></a>', "Pump"),
    ],
)
def test_selector_fallbacks(spark, container, name, title):
    html = listing(container, name + '<p class="price"> Rs 1,000 - 900 </p><i class="cname">Acme<br>Ltd</i><u class="cloc">Pune</u>')
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = P.extract_listings(df, "industrial-pumps").first()
    assert got["product_name"] == title
    assert (got["price_min"], got["price_max"], got["price_raw"]) == (900.0, 1000.0, "Rs 1,000 - 900")
    assert (got["supplier_name"], got["city"], got["category"]) == ("AcmeLtd", "Pune", "Industrial Pumps")


def test_first_container_wins_and_nameless_listings_drop():
    html = (
        '<div class="c-p"><a class="pn">A</a></div><div class="c-p"><p class="prc">5</p></div>'
        '<div class="prd-card"><a class="pn">B</a></div>'
    )
    rows = P.parse_page(html, P.RULES["marketplace"])
    assert [r["product_name"] for r in rows] == ["A"]
    assert P.parse_page("<p>none</p>", P.RULES["marketplace"]) == []
    assert P.parse_page("", P.RULES["marketplace"]) == []


def test_deep_nesting_and_broken_markup():
    html = "<div>" * 5000 + '<div class="c-p"><a class="pn">A</a></span></div>'
    assert P.parse_page(html, P.RULES["marketplace"])[0]["product_name"] == "A"


@pytest.mark.parametrize("bad", ["<![foo bar]]>", "<![", "<![if x]>", "<!-", "<?"])
def test_malformed_markup_keeps_the_rest_of_the_page(bad):
    html = f'<div class="c-p"><a class="pn" href="/1">Pump</a>{bad}<i class="price">5</i></div>'
    assert P.parse_page(html, P.RULES["marketplace"])[0]["product_name"] == "Pump"
    assert P.parse_page("<p>x</p>" + bad, P.RULES["page"]) is not None
