import json

import pytest
from pyspark.sql import functions as F

from tables import values
from ramure.operators import pages as pg
from ramure.operators import requests as rq

PAGE = """<html><head><title>t</title><script>var x = "<p>no</p>";</script></head><body><nav><a>Accueil</a></nav>
<main><h1>01.1 Produits</h1><p>La famille des&nbsp;produits <b>alimentaires</b></p><p>Nomenclature des codes</p>
<p>Ce poste comprend : le pain</p><p>les biscuits</p><p>Il comprend aussi le riz</p>
<p>Ce poste ne comprend pas :</p><p>le tabac : 01/02/2024</p><p>Ce poste comprend : rien</p><p>2024-05-01 maj</p><p>123456</p>
<p>vu 2024-05-01T10:00:00 hier</p></main><footer>fin de page</footer></body></html>"""


def test_page_sections(spark):
    df = spark.createDataFrame([("01.1", PAGE), ("02", "<p>ab</p>"), ("03", None)], "code string, html string")
    got = {row["code"]: row for row in pg.page_sections(df).collect()}
    row = got["01.1"]
    # the line that starts with the code and the navigation line are left out; a bold part is a line of its own
    assert row["description"] == "La famille des produits alimentaires"
    assert row["comprend"] == "le pain les biscuits Il comprend aussi le riz"
    assert row["ne_comprend_pas"] == "le tabac vu  hier"
    assert got["02"]["description"] is None and got["03"]["comprend"] is None


def test_page_sections_stay_in_the_row(spark):
    df = pg.page_sections(spark.createDataFrame([("1", "x")], "code string, html string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_description_is_the_first_five_lines(spark):
    html = "".join(f"<p>ligne assez longue {i}</p>" for i in range(8))
    df = pg.page_sections(spark.createDataFrame([("99", f"<body>{html}</body>")], "code string, html string"))
    assert df.first()["description"].count("ligne") == 5


def test_attach_and_coverage(spark):
    taxonomy = spark.createDataFrame([("01", "a"), ("02", "b")], "code string, libelle string")
    sections = spark.createDataFrame([("01", "d", None, None)], "code string, description string, comprend string, ne_comprend_pas string")
    joined = pg.attach_descriptions(taxonomy, sections)
    assert values(joined, "code", "description") == [("01", "d"), ("02", None)]
    assert tuple(pg.description_coverage(joined).first()) == (2, 1, 0)


def test_taxonomy_lines(spark):
    taxonomy = spark.createDataFrame([("01", "food"), ("01.1.1.1", "bread"), ("98.1.1.1", "none"), ("02.1.1.1", "tea")], "code string, libelle string")
    assert values(rq.taxonomy_lines(taxonomy), "line") == [("01.1.1.1 - bread  [food]",), ("02.1.1.1 - tea",)]


def test_generation_requests(spark):
    taxonomy = spark.createDataFrame([("01.2", "b", "x", None), ("01.1", "a", None, ""), ("98.1", "t", None, None), ("01", "l", None, None)],
                                     "code string, libelle string, comprend string, ne_comprend_pas string")
    rows = rq.generation_requests(taxonomy, 2, 5).orderBy("code").collect()
    assert [row["code"] for row in rows] == ["01.1", "01.2"]
    assert rows[1]["comprend_section"] == "Cette catégorie comprend: x" and rows[0]["ne_comprend_section"] == ""
    assert "5" in rows[0]["prompt"] and rows[1]["prompt"].endswith("x")
    assert [row["code"] for row in rq.generation_requests(taxonomy, 2, 5, 1).collect()] == ["01.1"]


def test_request_records(spark):
    df = spark.createDataFrame([("é\"x", None, 2)], "t string, a string, b int")
    assert json.loads(rq.request_records(df, "t", {"shop": "a", "prix": "b"}).first()["record"]) == {"produit": 'é"x', "prix": "2"}
    assert rq.request_records(df, "t").first()["record"] == 'é"x'
    with pytest.raises(ValueError):
        rq.request_records(df, "t", {"x": "zz"})


def test_batches_hold_every_row_once_in_order(spark):
    df = spark.range(95).withColumn("r", F.col("id").cast("string"))
    got = {row["batch"]: json.loads(row["payload"]) for row in rq.assemble_batches(df.repartition(7), "r", "id", 10).collect()}
    assert got == {batch: [str(n) for n in range(10 * batch, min(10 * batch + 10, 95))] for batch in range(10)}
    assert rq.assemble_batches(df.limit(0), "r", "id").count() == 0


def test_row_numbers_span_ranges(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 100 > 0, F.pmod(F.xxhash64("id"), F.lit(97))).alias("k"), "id").repartition(8)
    rows = rq.row_numbers(df, ["k", "id"]).orderBy("rn").collect()
    assert [row["rn"] for row in rows] == list(range(1000))
    order = [(row["k"] is not None, row["k"] or 0, row["id"]) for row in rows]
    assert order == sorted(order)


@pytest.mark.parametrize("response, expected", [
    ('["a","b"]', ["a", "b", None]), ('```json\n["a", null]\n```', ["a", None, None]), ('```\n["a"]```', ["a", None, None]),
    ('["a","b","c","d"]', ["a", "b", "c"]), ('{"a": 1}', [None] * 3), ("broken", [None] * 3), ('["a"', [None] * 3), (None, [None] * 3)])
def test_parse_code_response(spark, response, expected):
    df = spark.createDataFrame([(1, response)], "id int, response string")
    valid = spark.createDataFrame([("a",)], "code string")
    got = rq.parse_code_response(df, "response", 3, valid).orderBy("position").collect()
    assert [row["code"] for row in got] == expected
    assert [row["is_valid"] for row in got] == [code == "a" for code in expected]


def test_labels_and_pending(spark):
    df = spark.createDataFrame([(1, "01"), (2, "77"), (3, None)], "id int, code string")
    taxonomy = spark.createDataFrame([("01", "food")], "code string, libelle string")
    assert values(rq.attach_labels(df, taxonomy), "id", "coicop_libelle") == [(1, "food"), (2, ""), (3, "")]
    assert values(rq.pending_rows(df, df.where("id = 2"), "id"), "id") == [(1,), (3,)]


def test_parse_product_lines(spark):
    answer = "Voici des exemples :\n\n1. Pain de mie\n- 2) Baguette\n• Lait\n12: Eau\n3\n" + "x" * 81 + "\n4.\n5. \n* Riz\nThé"
    df = spark.createDataFrame([(1, answer)], "id int, response string")
    got = [row["product"] for row in rq.parse_product_lines(df, "response", 20).orderBy("position").collect()]
    # a lone number with its dot is too short to be numbering
    assert got == ["Pain de mie", "Baguette", "Lait", "Eau", "3", "4.", "5.", "Riz", "Thé"]
    assert rq.parse_product_lines(df, "response", 2).count() == 2


def test_page_content_boxes_nested_elements_and_entities(spark):
    pages = spark.createDataFrame([
        ("<body><main>dans le main</main><div class='a contenu-central b'><p>bo&icirc;te centrale</p><div>imbriqu&#233;e</div> et la fin</div></body>",),
        ("<article>avant <article>au milieu</article> apr&#xE8;s</article>",), ("<main></main><p>caf&#233; &#x20AC; &#0; &#99999999;</p>",),
        ('<div class="contenu-centralise">non</div><body>le corps</body>',)], "html string")
    lines = [row[0] for row in pages.select(pg.page_lines(F.col("html"))).collect()]
    assert lines == [["boîte centrale", "imbriquée", "et la fin"], ["avant", "au milieu", "après"], ["café € &#0; &#99999999;"], ["le corps"]]


def test_page_content_ends_at_its_own_closing_tag(spark):
    pages = spark.createDataFrame([
        ("<article>un <div>deux</div></article> entre <article>trois</article>",),
        ("<main>dedans<nav>a<nav>b</nav>c</nav>encore</main><p>dehors</p>",), ("</nav></nav><body>du texte<header>x</header> fin",),
        ("<div class='contenu-onglet'><div>un</div> deux</div><div>trois</div>",), ("<main><nav>tout</nav></main>",),
        ("<script>if (a<b) '<main>'</script><main>code<STYLE>p{}</STYLE> et texte</main>",), ("<mainly>abc</mainly><Main id=x>def</MAIN >ghi",),
        ("",), (None,), ("<div>" * 3000 + "loin" + "</div>" * 3000,)], "html string")
    lines = [row[0] for row in pages.select(pg.page_lines(F.col("html"))).collect()]
    assert lines == [["deux"], ["dedans", "encore"], ["du texte", "fin"], ["deux"], [], ["code et texte"], ["def"], [], None, ["loin"]]
