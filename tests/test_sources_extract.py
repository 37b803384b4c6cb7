import pytest
from pyspark.sql import functions as F

from tables import values
from ramure.operators import extract as ex
from ramure.sources import readers, writers


@pytest.fixture(scope="module")
def transactions(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tx") / "data")
    rows = [
        ("pain", "01.1.1.1.1", "f1", 2024, 1), ("pain", "01.1.1.1.1", "f1", 2024, 1), ("pain", "01.1.1.1.1", "f2", 2024, 2),
        ("lait", "99.1", "f1", 2024, 2), ("eau", "99.2", "f9", 2025, 1), ("sel", "01.1", "f1", 2025, 1)]
    spark.createDataFrame(rows, "description_ean string, variete string, id_famille string, annee int, mois int").write.partitionBy(
        "annee", "mois").parquet(path)
    return path


@pytest.fixture(scope="module")
def family(spark):
    return spark.createDataFrame([("f1", "02.1.1.1.1"), ("f1", "02.2.2.2.2")], "id_famille string, coicop string")


def test_periods_prune_partitions(spark, transactions):
    df = readers.read_periods(spark, transactions, [2024], [2])
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "annee" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_duplicate_family_fans_out_every_row(spark, transactions, family):
    mapped = ex.map_codes(ex.distinct_products(readers.read_periods(spark, transactions, [2024], [1])), family)
    assert values(mapped, "description_ean", "coicop_code") == [("pain", "01.1.1.1.1")] * 2


def test_filter_drops_short_technical_and_unmapped(spark):
    df = spark.createDataFrame([("01.1.1.1.1",), ("01.1.1.1",), ("99.1.1.1.1",), (None,)], "coicop_code string")
    assert values(ex.filter_codes(df), "coicop_code") == [("01.1.1.1.1",)]


def test_one_period_keeps_duplicates_several_dont(spark, transactions, family):
    one = ex.extract(spark, transactions, family, [2024])
    assert values(one, "description_ean", "coicop_code") == [
        ("lait", "02.1.1.1.1"), ("lait", "02.2.2.2.2"), ("pain", "01.1.1.1.1"), ("pain", "01.1.1.1.1"), ("pain", "01.1.1.1.1")]
    two = ex.extract(spark, transactions, family, [2024, 2025])
    assert values(two, "description_ean", "coicop_code") == [("lait", "02.1.1.1.1"), ("lait", "02.2.2.2.2"), ("pain", "01.1.1.1.1")]
    assert two.count() == ex.union_periods([ex.extract(spark, transactions, family, [y]) for y in (2024, 2025)]).count()


def test_mapping_is_broadcast_when_small(spark, transactions, family, tmp_path):
    path = str(tmp_path / "family.parquet")
    writers.write_output(family, path)
    text = ex.plan_text(ex.map_codes(readers.read_periods(spark, transactions, [2024]), readers.read_input(spark, path)))
    assert "BroadcastHashJoin" in text


def test_passage_and_union(spark):
    sample = spark.createDataFrame([("pain", "v1"), ("eau", "v9")], "description_ean string, variete string")
    passage = spark.createDataFrame([("v1", "c1")], "code_variete_ecoicopv1 string, code_sous_classe_ecoicopv2 string")
    mapped = ex.passage_map(sample, passage)
    assert values(ex.union_distinct(mapped, mapped), "product", "code") == [("pain", "c1")]


def test_annotated_layouts(spark, tmp_path):
    (tmp_path / "ajouts_manuels_application.csv").write_text("product;code1;price;store_type\npain;01.1;1,5;X\n ;01.1;2;X\n", "utf-8")
    (tmp_path / "other.csv").write_text("Nature de la dépense,coicop,Montant,Enseigne ou type de magasin\neau,02.1,3,Y\n", "utf-8")
    (tmp_path / "tickets_application.csv").write_text(
        "product;Code coicop;Montant de la dépense;Nomen_mag\nsel;03.1;bad;Hypermarchés\nriz;03.2;4,2;\nthé;;1;Autre\n", "utf-8")
    (tmp_path / "unknown.csv").write_text("a;b\n1;2\n", "utf-8")
    got = readers.load_annotated_dir(spark, str(tmp_path))
    assert values(got, "product", "code", "amount", "is_hypermarche", "source_file") == [
        ("eau", "02.1", 3.0, None, "other"), ("pain", "01.1", 1.5, None, "ajouts_manuels_application"),
        ("riz", "03.2", 4.2, False, "tickets_application"), ("sel", "03.1", None, True, "tickets_application")]


def test_annotated_dir_without_known_file(spark, tmp_path):
    (tmp_path / "unknown.csv").write_text("a;b\n1;2\n", "utf-8")
    with pytest.raises(FileNotFoundError):
        readers.load_annotated_dir(spark, str(tmp_path))


def test_taxonomy_layouts(spark):
    full = spark.createDataFrame([("t", "01", "l", "g", "c", "n")], "tri string, code string, label_fr string, note_generale_fr string, "
                                 "contenu_central_fr string, note_exclusion_fr string")
    assert values(readers.normalize_taxonomy(full), "*") == [("01", "l", "g", "c", "n")]
    two = spark.createDataFrame([("l", "01")], "Libelle string, Code string")
    assert values(readers.normalize_taxonomy(two), "*") == [("01", "l", None, None, None)]


def test_unknown_suffix(spark):
    with pytest.raises(ValueError):
        readers.read_input(spark, "x.json")
    with pytest.raises(ValueError):
        writers.write_output(spark.range(1), "x.json")


def test_write_counts_rows(spark, tmp_path):
    assert writers.write_output(spark.range(7), str(tmp_path / "o.parquet")) == 7


def test_encryption_round_trip_and_secrecy(spark):
    key = writers.new_key()
    df = spark.createDataFrame([(1, "secret"), (2, None)], "id int, t string")
    hidden = writers.protect_columns(df, ["t"], key)
    assert dict(hidden.dtypes)["t"] == "binary"
    shown = writers.reveal_columns(hidden, ["t"], key)
    assert values(shown, "id", "t") == [(1, "secret"), (2, None)]
    for plan in (hidden, shown):
        assert key not in plan._jdf.queryExecution().toString()
    with pytest.raises(Exception):
        writers.reveal_columns(hidden, ["t"], writers.new_key()).select(F.max("t")).collect()
    with pytest.raises(ValueError):
        writers.protect_columns(df, ["t"], "short")
