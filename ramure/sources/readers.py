"""Readers for the inputs: partitioned transactions, mapping tables, taxonomies and annotated files."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ramure.functions.text import parse_amount

# Names of the columns in the three layouts of annotated files.
LAYOUTS = {
    "ajouts_manuels_application": {
        "sep": ";", "marker": "code1", "text": "product", "code": "code1", "amount": "price", "store": "store_type",
        "has_hypermarket": False,
    },
    "depenses_manuelles_carnets": {
        "sep": ",", "marker": "Nature de la dépense", "text": "Nature de la dépense", "code": "coicop",
        "amount": "Montant", "store": "Enseigne ou type de magasin", "has_hypermarket": False,
    },
    "tickets_application": {
        "sep": ";", "marker": "Code coicop", "text": "product", "code": "Code coicop", "amount": "Montant de la dépense",
        "store": "Nomen_mag", "has_hypermarket": True,
    },
}
HYPERMARKET = "Hypermarchés"

# Taxonomy columns of the enriched export and their names here.
TAXONOMY_NAMES = {
    "label_fr": "libelle", "contenu_central_fr": "comprend", "note_exclusion_fr": "ne_comprend_pas",
    "note_generale_fr": "description",
}
TAXONOMY_TEXTS = ("description", "comprend", "ne_comprend_pas")


def read_periods(spark: SparkSession, base: str, years: Sequence[int], months: Sequence[int] | None = None) -> DataFrame:
    """Rows of the `annee=/mois=` partitions asked for; only their files are listed and read."""
    df = spark.read.parquet(base).where(F.col("annee").isin(*[int(year) for year in years]))
    return df.where(F.col("mois").isin(*[int(month) for month in months])) if months else df


def _string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_mapping_csv(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """Mapping table with a header; all text, so codes keep their leading zeros."""
    return spark.read.csv(path, header=True, sep=sep, schema=_string_schema(columns), enforceSchema=False)


def read_positional_csv(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """The first two fields as `product, code`, whatever the header says."""
    df = spark.read.csv(path, header=True, sep=sep)
    first, second = df.columns[:2]
    return df.select(F.col(f"`{first}`").alias("product"), F.col(f"`{second}`").alias("code"))


def read_input(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, or a semicolon-separated CSV with header, by suffix."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith(".csv"):
        return spark.read.csv(path, header=True, sep=";")
    raise ValueError(f"unsupported file format: {path}; use .parquet or .csv")


def detect_layout(columns: Sequence[str]) -> str | None:
    """Layout of an annotated file by its column names."""
    return next((name for name, layout in LAYOUTS.items() if layout["marker"] in columns), None)


def normalize_annotated(df: DataFrame, layout: str | None = None) -> DataFrame:
    """One of the three layouts to `product, code, amount, is_hypermarche`; rows without text or code are dropped.

    A `source_file` column is kept.
    """
    name = layout or detect_layout(df.columns)
    if name is None:
        raise ValueError(f"unknown layout of columns {df.columns}")
    spec = LAYOUTS[name]
    store = F.coalesce(F.col(f"`{spec['store']}`") == HYPERMARKET, F.lit(False)) if spec["has_hypermarket"] \
        else F.lit(None).cast("boolean")
    kept = ["source_file"] if "source_file" in df.columns else []
    return df.select(
        F.col(f"`{spec['text']}`").alias("product"), F.col(f"`{spec['code']}`").alias("code"),
        parse_amount(F.col(f"`{spec['amount']}`")).alias("amount"), store.alias("is_hypermarche"), *kept,
    ).where((F.trim("product") != "") & (F.trim("code") != ""))


def load_annotated_dir(spark: SparkSession, directory: str) -> DataFrame:
    """All annotated CSV files of a folder, tagged with `source_file`; files of an unknown layout are skipped.

    Only names and header lines pass the driver; files with the same header are read together.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(directory).select("path")
    groups: dict[tuple, list[str]] = {}
    for (path,) in listing.orderBy("path").collect():
        found = _header(spark, path)
        if found:
            groups.setdefault(found, []).append(path)
    if not groups:
        raise FileNotFoundError(f"no annotated CSV file in {directory}")
    parts = []
    for (layout, columns), paths in groups.items():
        df = spark.read.csv(paths, header=True, sep=LAYOUTS[layout]["sep"], schema=_string_schema(columns))
        stem = F.regexp_replace(F.url_decode(F.col("_metadata.file_name")), r"\.csv$", "")
        parts.append(normalize_annotated(df.withColumn("source_file", stem), layout))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _header(spark: SparkSession, path: str) -> tuple[str, tuple[str, ...]] | None:
    """Layout and columns of one file, None when it has no known layout."""
    stem = PurePosixPath(path).stem
    separators = [LAYOUTS[stem]["sep"]] if stem in LAYOUTS else [";", ","]
    for sep in separators:
        columns = tuple(spark.read.csv(path, header=True, sep=sep).columns)
        layout = detect_layout(columns)
        if layout and LAYOUTS[layout]["sep"] == sep:
            return layout, columns
    return None


def normalize_taxonomy(df: DataFrame) -> DataFrame:
    """Any taxonomy layout to `code, libelle, description, comprend, ne_comprend_pas`.

    Known are the export with language suffixes, the enriched layout, and two columns: label, then code.
    """
    if "label_fr" in df.columns:
        df = df.withColumnsRenamed(TAXONOMY_NAMES)
    elif "comprend" not in df.columns:
        if len(df.columns) != 2:
            raise ValueError(f"unknown taxonomy layout: {df.columns}")
        df = df.toDF("libelle", "code")
    missing = {name: F.lit(None).cast("string") for name in TAXONOMY_TEXTS if name not in df.columns}
    return df.withColumns(missing).select("code", "libelle", *TAXONOMY_TEXTS)


def load_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Taxonomy file, semicolon-separated with header, in any layout."""
    return normalize_taxonomy(spark.read.csv(path, header=True, sep=";", multiLine=True))
