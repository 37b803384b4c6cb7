from pyspark.sql import functions as F

from tables import values
from ramure.functions import codes, text
from ramure.functions.ngrams import char_ngrams, ngram_vocab


def one(spark, column, value):
    """The column over a one-row table with `c`."""
    return spark.createDataFrame([(value,)], "c string").select(column.alias("r")).first()["r"]


def test_code_levels_pad_only_the_first(spark):
    df = spark.createDataFrame([("1.2.3",), ("01.1.2.3.4",), ("123.4",), ("",), (None,)], "code string")
    got = [tuple(row.s) if row.s else None for row in df.select(codes.code_levels("code").alias("s")).collect()]
    assert got == [
        ("01", "1.2", "1.2.3", None, None), ("01", "01.1", "01.1.2", "01.1.2.3", "01.1.2.3.4"),
        ("123", "123.4", None, None, None), ("00", None, None, None, None), (None, None, None, None, None)]
    padded = df.select(codes.code_levels_padded("code").alias("s")).first().s
    assert tuple(padded) == ("01", "01.2", "01.2.3", None)


def test_code_facts(spark):
    df = spark.createDataFrame([("989.1",), ("98",), ("9.1.2.3.4.5",), ("01.1.1.1.1",)], "code string")
    got = df.select(
        codes.parent_code("code"), codes.code_depth("code"), codes.is_technical("code"), codes.is_technical_division("code"),
        codes.level4_key("code"), codes.is_leaf("code"), codes.taxonomy_url("code", "b")).collect()
    assert [tuple(row) for row in got] == [
        ("989", 2, True, False, "989.1", False, "b/groupe/989.1"), (None, 1, True, True, "98", False, "b/division/98"),
        ("9.1.2.3.4", 6, False, False, "9.1.2.3", False, None), ("01.1.1.1", 5, False, False, "01.1.1.1", True, "b/poste/01.1.1.1.1")]


def test_ancestor_path_skips_missing(spark):
    taxonomy = spark.createDataFrame([("01", "food"), ("01.1.1", "bread"), ("01.1.1.1", "white"), ("02", "drink")], "code string, libelle string")
    assert values(codes.ancestor_path(taxonomy), "code", "path") == [
        ("01", ""), ("01.1.1", "food"), ("01.1.1.1", "food > bread"), ("02", "")]


def test_children_of_unpadded_codes(spark):
    df = codes.with_levels(spark.createDataFrame([("1.2.3",)], "code string"))
    assert values(codes.children_map(df), "level", "parent", "child") == [(2, "01", "1.2"), (3, "1.2", "1.2.3")]


def test_transliterate(spark):
    assert one(spark, text.transliterate("c"), "Œuf À l'été, straße 5€ ° 中") == "OEuf A l'ete, strasse 5EUR deg "
    assert one(spark, text.transliterate("c"), None) == ""


def test_noise_laws(spark):
    cases = {
        "rien du tout": "du tout", "rien": "", "rien2": "rien", "pain!!bio 2x500g": "pain bio", "a_b c": "a_b",
        "\rien du tout ab": "ab", "le+la": "le la", "ri-en": "ri en", "trie n": "trie",
    }
    for given, expected in cases.items():
        assert one(spark, text.strip_noise("c"), given) == expected, given


def test_preprocess_readme_example_and_row_rules(spark):
    df = spark.createDataFrame([(1, "Lait LAIT entier lait"), (2, "  "), (3, "de la"), (4, None), (5, "12 !")], "id int, product string")
    got = text.preprocess_text(df, "product")
    assert got.columns == ["id", "product", "product_orig"]
    # a text of stop words only stays as '', one without words goes
    assert values(got, "id", "product", "product_orig") == [(1, "lait entier", "Lait LAIT entier lait"), (3, "", "de la")]


def test_preprocess_is_one_narrow_stage(spark):
    df = text.preprocess_text(spark.createDataFrame([("x y",)], "product string"), "product")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan.replace("PythonRDD", "")


def test_small_text_functions(spark):
    assert one(spark, text.dedup_tokens("c"), "b a b c a") == "b a c"
    assert one(spark, text.remove_stopwords("c", ["a"]), "a b a b") == "b b"
    assert one(spark, text.squeeze_ws("c"), " a \n b ") == "a b"
    assert [one(spark, text.parse_amount("c"), v) for v in ("1,5", " 2 ", "x", "", None, "5d", "1_0", "1e2", "-3.")] == [
        1.5, 2.0, None, None, None, None, None, 100.0, -3.0]
    assert one(spark, text.word_count("c"), " a  b ") == 2


def test_stopwords_file(spark, tmp_path):
    path = tmp_path / "words.json"
    path.write_text('["de",\n "où"]', encoding="utf-8")
    assert text.load_stopwords(spark, str(path)) == ["de", "où"]


def test_char_ngrams(spark):
    assert one(spark, char_ngrams("c"), "ab a") == ["<ab", "ab>", "<ab>", "<a>"]
    assert one(spark, char_ngrams("c", max_tokens=2), "abc") == ["<ab", "abc"]
    assert one(spark, char_ngrams("c"), "") == []


def test_ngram_vocab_orders_ties_by_ngram(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "t string")
    assert values(ngram_vocab(df, "t", 1, 2), "id", "ngram", "n") == [(0, "<a>", 2), (1, "<b>", 1)]


def test_drop_empty(spark):
    df = spark.createDataFrame([(" a ",), (" \t",), (None,)], "t string")
    assert values(text.drop_empty(df, "t"), "t") == [("a",)]


def test_level_name_and_classes(spark):
    df = codes.with_levels(spark.createDataFrame([("2.1",), ("1.1",), ("2.1",), ("3",)], "code string"))
    assert [row.code for row in codes.level_classes(df, 2).collect()] == ["1.1", "2.1"]
    assert df.select(codes.level_name(F.col("code"))).first()[0] == "groupe"


def test_transliterate_latin_blocks_and_signs(spark):
    df = spark.createDataFrame([("phở sữa §12 thé ¬ ǎ Ḿ",)], "t string")
    assert df.select(text.transliterate("t")).first()[0] == "pho sua SS12 the ! a M"
