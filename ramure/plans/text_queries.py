"""Registered queries of code functions, text cleaning, sources and extraction."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ramure.functions import codes, text
from ramure.functions.ngrams import char_ngrams, ngram_vocab
from ramure.operators import extract as ex
from ramure.operators.training import load_annotations
from ramure.plans.registry import level_sql, register, z
from ramure.session import work_folder
from ramure.sources import readers, writers

WORDS = list(text.DEFAULT_STOPWORDS) + ["small", "des", "une", "und", "the"]


def folder(v, name: str) -> str:
    """A new folder for a written table."""
    return f"{work_folder(v.spark)}/{name}-{uuid.uuid4().hex}"


# ---- codes ---------------------------------------------------------------------------------------------------------

register("code_levels", lambda v: v.part_codes.select("p_partkey", codes.code_levels("code").alias("s")).select("p_partkey", "s.*"),
         "SELECT p_partkey, " + ", ".join(f"{level_sql('code', n)} AS level{n}" for n in range(1, 6)) + " FROM part_codes")
register("code_levels_padded",
         lambda v: v.part_codes.select("p_partkey", codes.code_levels_padded("code").alias("s")).select("p_partkey", "s.*"),
         "SELECT p_partkey, " + ", ".join(f"{level_sql('code', n, True)} AS level{n}" for n in range(1, 5)) + " FROM part_codes")
register("code_facts",
         lambda v: v.part_codes.select(
             "p_partkey", codes.parent_code("code").alias("parent"), codes.code_depth("code").cast("int").alias("depth"),
             codes.is_level("code", 3).alias("is_level3"), codes.is_leaf("code").alias("is_leaf"),
             codes.is_technical("code").alias("technical_prefix"), codes.is_technical_division("code").alias("technical_division"),
             codes.code_prefix("code").alias("code8"), codes.level4_key("code").alias("key4"),
             codes.level_name("code").alias("level_name"), codes.taxonomy_url("code", "https://example.org/codes").alias("url")),
         """SELECT p_partkey, CASE WHEN d > 1 THEN array_to_string(list_slice(s, 1, d - 1), '.') END AS parent, CAST(d AS INTEGER) AS depth,
                   d = 3 AS is_level3, d = 5 AS is_leaf, left(code, 2) IN ('98', '99') AS technical_prefix,
                   """ + z("s[1]") + """ IN ('98', '99') AS technical_division, left(code, 8) AS code8,
                   array_to_string(list_slice(s, 1, 4), '.') AS key4, n AS level_name, 'https://example.org/codes/' || n || '/' || code AS url
            FROM (SELECT *, len(s) AS d, CASE len(s) WHEN 1 THEN 'division' WHEN 2 THEN 'groupe' WHEN 3 THEN 'classe'
                                              WHEN 4 THEN 'sousClasse' WHEN 5 THEN 'poste' END AS n
                  FROM (SELECT *, string_split(code, '.') AS s FROM part_codes) a) b""")
register("ancestor_path", lambda v: codes.ancestor_path(v.taxonomy).select("code", "path"),
         """SELECT t.code, coalesce(p.path, '') AS path FROM taxonomy t LEFT JOIN (
                SELECT c.code, string_agg(a.libelle, ' > ' ORDER BY length(a.code)) AS path
                FROM taxonomy c JOIN taxonomy a ON starts_with(c.code, a.code || '.') GROUP BY c.code) p ON t.code = p.code""")
register("taxonomy_with_levels", lambda v: codes.taxonomy_with_levels(v.taxonomy),
         "SELECT code, libelle, " + ", ".join(f"{level_sql('code', n)} AS level{n}" for n in range(1, 6)) + " FROM taxonomy")
register("children_map", lambda v: codes.children_map(codes.with_levels(v.part_codes)),
         " UNION ALL ".join(
             f"SELECT DISTINCT {n} AS level, {level_sql('code', 1) if n == 2 else level_sql('code', n - 1)} AS parent, "
             f"{level_sql('code', n)} AS child FROM part_codes WHERE {level_sql('code', n)} IS NOT NULL" for n in (2, 3, 4, 5)))
register("level_classes", lambda v: codes.level_classes(codes.with_levels(v.part_codes), 3),
         f"SELECT DISTINCT {level_sql('code', 3)} AS code FROM part_codes WHERE {level_sql('code', 3)} IS NOT NULL ORDER BY 1")

# ---- text ----------------------------------------------------------------------------------------------------------

QUOTE = "'"


def quoted(value: str) -> str:
    return QUOTE + value.replace(QUOTE, QUOTE * 2) + QUOTE


def ascii_sql(column: str) -> str:
    """Transliteration from the same fixed tables: one translate, then the spelled-out signs, then the rest dropped."""
    sql = f"translate(coalesce({column}, ''), {quoted(''.join(text.SINGLE_LETTERS))}, {quoted(''.join(text.SINGLE_LETTERS.values()))})"
    for sign, spelling in text.EXPANSIONS.items():
        sql = f"replace({sql}, {quoted(sign)}, {quoted(spelling)})"
    return f"regexp_replace({sql}, '[^\\x00-\\x7F]', '', 'g')"


def noise_sql(column: str) -> str:
    """Text after the noise steps, before short words are dropped."""
    label = "'\\brien\\b|\\rien du tout\\b'"
    sql = f"regexp_replace({column}, {label}, '', 'g')"
    sql = f"regexp_replace({sql}, '[^\\w\\s]+', ' ', 'g')"
    sql = f"regexp_replace({sql}, {label}, '', 'g')"
    return f"regexp_replace({sql}, '[\\d+]', ' ', 'g')"


def token_ctes(source: str, key: str, column: str, words: list[str]) -> dict[str, str]:
    """Words of each row with their position, long enough ones only; first occurrences; and the stop words' effect."""
    return {
        "noise_free": f"SELECT {key} AS k, regexp_split_to_array({noise_sql(f'lower({ascii_sql(column)})')}, '\\s+') AS ws FROM {source}",
        "tokens": "SELECT k, w, min(pos) AS pos FROM (SELECT k, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS pos FROM noise_free) u "
                  "WHERE length(w) > 1 GROUP BY k, w",
        "cleaned": "SELECT k, coalesce(string_agg(w, ' ' ORDER BY pos) FILTER (WHERE w NOT IN ("
                   + ", ".join(quoted(word) for word in words) + ")), '') AS clean FROM tokens GROUP BY k",
    }


register("transliterate", lambda v: v.documents.select("doc_id", text.transliterate("text").alias("ascii")),
         f"SELECT doc_id, {ascii_sql('text')} AS ascii FROM documents")
register("strip_noise", lambda v: v.documents.select("doc_id", text.strip_noise(F.lower(text.transliterate("text"))).alias("plain")),
         "SELECT doc_id, coalesce(array_to_string([x for x in regexp_split_to_array("
         + noise_sql(f"lower({ascii_sql('text')})") + ", '\\s+') if length(x) > 1], ' '), '') AS plain FROM documents")
register("dedup_tokens", lambda v: v.documents.select("doc_id", text.dedup_tokens("text").alias("words")),
         """SELECT doc_id, coalesce(words, '') AS words FROM documents LEFT JOIN (
                SELECT k, string_agg(w, ' ' ORDER BY pos) AS words FROM (
                    SELECT k, w, min(pos) AS pos FROM (SELECT doc_id AS k, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS pos
                    FROM (SELECT doc_id, regexp_split_to_array(text, '\\s+') AS ws FROM documents) s) u WHERE w <> '' GROUP BY k, w) g GROUP BY k) d
            ON doc_id = k""")
register("remove_stopwords", lambda v: v.documents.select("doc_id", text.remove_stopwords("text", WORDS).alias("words")),
         "SELECT doc_id, coalesce(array_to_string([x for x in regexp_split_to_array(text, '\\s+') if x <> '' AND x NOT IN ("
         + ", ".join(quoted(word) for word in WORDS) + ")], ' '), '') AS words FROM documents")
register("drop_empty", lambda v: text.drop_empty(v.annotated, "montant").select("id", "montant"),
         "SELECT id, trim(montant) AS montant FROM annotated WHERE trim(montant) <> ''")
register("preprocess_documents",
         lambda v: text.preprocess_text(v.documents, "text", WORDS).select("doc_id", "text", "text_orig"),
         "SELECT doc_id, clean AS text, d.text AS text_orig FROM documents d JOIN cleaned ON k = doc_id",
         token_ctes("documents", "doc_id", "text", WORDS))
register("load_annotations",
         lambda v: load_annotations(v.synthetic, words=WORDS).groupBy("text", "product", "level1", "level4").agg(
             F.count("*").alias("n")),
         f"""SELECT clean AS text, clean AS product, {level_sql('code', 1)} AS level1, {level_sql('code', 4)} AS level4, count(*) AS n
             FROM keyed JOIN cleaned ON k = product WHERE NOT (starts_with(code, '98') OR starts_with(code, '99')) GROUP BY 1, 2, 3, 4""",
         {"keyed": "SELECT product, code FROM synthetic", "texts": "SELECT DISTINCT product FROM synthetic",
          **token_ctes("texts", "product", "product", WORDS)})
register("squeeze_ws", lambda v: v.pages.select("page_id", text.squeeze_ws("html").alias("html")),
         "SELECT page_id, trim(regexp_replace(html, '[\\s\\x0B\\x85\\p{Z}]+', ' ', 'g')) AS html FROM pages")
register("parse_amount", lambda v: v.annotated.select("id", text.parse_amount("montant").alias("amount")),
         "SELECT id, TRY_CAST(replace(trim(montant), ',', '.') AS DOUBLE) AS amount FROM annotated")
register("text_stats", lambda v: v.documents.select(
    "doc_id", text.text_length("text").alias("n_chars"), text.word_count("text").alias("n_words")),
    "SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, "
    "CAST(len([x for x in regexp_split_to_array(text, '\\s+') if x <> '']) AS INTEGER) AS n_words FROM documents")

GRAMS = {
    "marked": "SELECT k, '<' || w || '>' AS w FROM (SELECT p_partkey AS k, unnest(string_split(label, ' ')) AS w FROM part_codes) u WHERE w <> ''",
    "grams": "SELECT k, substr(w, CAST(i AS INTEGER), CAST(n AS INTEGER)) AS ngram FROM (SELECT k, w, n, unnest(range(1, length(w) - n + 2)) AS i "
             "FROM marked CROSS JOIN (SELECT unnest([3, 4, 5, 6]) AS n) ns WHERE n <= length(w)) p",
}
register("char_ngrams", lambda v: v.part_codes.select("p_partkey", F.explode(char_ngrams("label")).alias("ngram")),
         "SELECT k AS p_partkey, ngram FROM grams", GRAMS)
register("ngram_vocab", lambda v: ngram_vocab(v.part_codes, "label", 20, 300).withColumn("id", F.col("id").cast("int")),
         "SELECT ngram, n, CAST(row_number() OVER (ORDER BY n DESC, ngram) - 1 AS INTEGER) AS id FROM "
         "(SELECT ngram, count(*) AS n FROM grams GROUP BY 1 HAVING count(*) >= 20 ORDER BY n DESC, ngram LIMIT 300) t", GRAMS)

# ---- extraction ----------------------------------------------------------------------------------------------------

register("distinct_products", lambda v: ex.distinct_products(v.products),
         "SELECT DISTINCT description_ean, variete, id_famille FROM products")
MAPPED = ("SELECT description_ean, variete, CASE WHEN left(variete, 2) = '99' THEN coicop ELSE variete END AS coicop_code "
          "FROM {source} p LEFT JOIN famille f ON p.id_famille = f.id_famille")
ONCE = MAPPED.format(source="(SELECT DISTINCT description_ean, variete, id_famille FROM products)")
KEPT = "length(coicop_code) >= 10 AND left(coicop_code, 2) <> '99'"
register("map_codes", lambda v: ex.map_codes(ex.distinct_products(v.products), v.famille), ONCE)
register("filter_codes", lambda v: ex.filter_codes(ex.map_codes(ex.distinct_products(v.products), v.famille)),
         f"SELECT * FROM ({ONCE}) m WHERE {KEPT}")
register("union_periods",
         lambda v: ex.union_periods([
             ex.extract_products(v.products.where(F.col("annee") == year), v.famille) for year in (1996, 1997)]),
         "SELECT DISTINCT * FROM (" + MAPPED.format(source="products") + f" WHERE annee IN (1996, 1997)) m WHERE {KEPT}")
register("passage_map", lambda v: ex.passage_map(ex.distinct_products(v.products), v.passage),
         "SELECT description_ean AS product, code_sous_classe_ecoicopv2 AS code FROM "
         "(SELECT DISTINCT description_ean, variete, id_famille FROM products) p JOIN passage ON variete = code_variete_ecoicopv1")
register("union_distinct", lambda v: ex.union_distinct(ex.passage_map(v.products, v.passage), v.synthetic),
         "SELECT description_ean AS product, code_sous_classe_ecoicopv2 AS code FROM products JOIN passage ON variete = code_variete_ecoicopv1 "
         "UNION SELECT product, code FROM synthetic")

# ---- sources -------------------------------------------------------------------------------------------------------


def partitioned(v) -> str:
    path = folder(v, "transactions")
    v.products.select("description_ean", "variete", "id_famille", "annee", "mois").repartition("annee", "mois").write.partitionBy("annee", "mois").parquet(path)
    return path


register("read_periods",
         lambda v: readers.read_periods(v.spark, partitioned(v), [1996, 1997], [1, 2]).groupBy("annee", "mois").agg(
             F.count("*").alias("n"), F.count_distinct("description_ean").alias("n_texts")),
         "SELECT annee, mois, count(*) AS n, count(DISTINCT description_ean) AS n_texts FROM products "
         "WHERE annee IN (1996, 1997) AND mois IN (1, 2) GROUP BY 1, 2")
register("extract_periods",
         lambda v: ex.extract(v.spark, partitioned(v), v.famille, [1996], [1, 2, 3]),
         "SELECT DISTINCT * FROM (" + MAPPED.format(source="products") + f" WHERE annee = 1996 AND mois IN (1, 2, 3)) m WHERE {KEPT}")
register("extract_one_period",
         lambda v: ex.extract(v.spark, partitioned(v), v.famille, [1998]),
         "SELECT * FROM (" + MAPPED.format(source="(SELECT DISTINCT description_ean, variete, id_famille FROM products WHERE annee = 1998)")
         + f") m WHERE {KEPT}")


def written_csv(v, df, name: str, sep: str) -> str:
    path = folder(v, name)
    df.write.csv(path, header=True, sep=sep)
    return path


register("read_mapping_csv",
         lambda v: readers.read_mapping_csv(v.spark, written_csv(v, v.famille, "famille", ","), ["id_famille", "coicop"]),
         "SELECT id_famille, coicop FROM famille")
register("read_positional_csv",
         lambda v: readers.read_positional_csv(v.spark, written_csv(v, v.synthetic.toDF("Libellé", "Code"), "synthetic", ";")),
         "SELECT product, code FROM synthetic")
register("load_taxonomy",
         lambda v: readers.load_taxonomy(v.spark, written_csv(
             v, v.taxonomy.select(F.col("libelle").alias("Libelle"), F.col("code").alias("Code")), "taxonomy", ";")),
         "SELECT code, libelle, CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS comprend, "
         "CAST(NULL AS VARCHAR) AS ne_comprend_pas FROM taxonomy")


def exported(v, *names: str):
    """The nomenclature with texts that hold the separator and line ends, as a CSV file with the columns asked for."""
    code, label = F.col("code"), F.col("libelle")
    texts = v.taxonomy.select(
        code, label, F.concat(F.lit("général\n"), code).alias("general"), F.concat(F.lit("contient "), label).alias("contains"),
        F.when(F.length(code) > 4, F.concat(F.lit("sauf; "), code)).alias("excludes"))
    return written_csv(v, texts.toDF("code", *names), "taxonomy-export", ";")


TAXONOMY_SQL = ("SELECT code, libelle, {0} AS description, 'contient ' || libelle AS comprend, "
                "CASE WHEN length(code) > 4 THEN 'sauf; ' || code END AS ne_comprend_pas FROM taxonomy")
register("load_taxonomy_export",
         lambda v: readers.load_taxonomy(v.spark, exported(v, "label_fr", "note_generale_fr", "contenu_central_fr", "note_exclusion_fr")),
         TAXONOMY_SQL.format("'général' || chr(10) || code"))
# an enriched file without general texts: they are added as NULL
register("load_taxonomy_enriched",
         lambda v: readers.load_taxonomy(v.spark, exported(v, "libelle", "other", "comprend", "ne_comprend_pas")),
         TAXONOMY_SQL.format("CAST(NULL AS VARCHAR)"))


def annotated_folder(v) -> str:
    """The three layouts as CSV files of one folder, each named as its layout."""
    path = folder(v, "annotated")
    rows = v.annotated
    names = {
        "ajouts_manuels_application": ["product", "code1", "price", "store_type"],
        "depenses_manuelles_carnets": ["Nature de la dépense", "coicop", "Montant", "Enseigne ou type de magasin"],
        "tickets_application": ["product", "Code coicop", "Montant de la dépense", "Nomen_mag"],
    }
    for name, columns in names.items():
        part = rows.where(F.col("source_file") == name).select("product", "code", "montant", "magasin").toDF(*columns)
        part.write.csv(f"{path}/{name}", header=True, sep=readers.LAYOUTS[name]["sep"])
    return path


register("load_annotated_files",
         lambda v: readers.load_annotated_dir(v.spark, annotated_folder(v) + "/*").groupBy("product", "code", "amount", "is_hypermarche").agg(
             F.count("*").alias("n")),
         """SELECT product, code, TRY_CAST(replace(trim(montant), ',', '.') AS DOUBLE) AS amount,
                   CASE WHEN source_file = 'tickets_application' THEN magasin = 'Hypermarchés' END AS is_hypermarche, count(*) AS n
            FROM annotated GROUP BY 1, 2, 3, 4""")


def round_trip(v, suffix: str):
    path = folder(v, "output") + suffix
    writers.write_output(v.part_codes.select("label", "code"), path)
    return readers.read_input(v.spark, path)


register("write_read_parquet", lambda v: round_trip(v, ".parquet"), "SELECT label, code FROM part_codes")
register("write_read_csv", lambda v: round_trip(v, ".csv"), "SELECT label, code FROM part_codes")
SAMPLE_KEY = "0123456789abcdef0123456789abcdef"
register("protect_reveal",
         lambda v: writers.reveal_columns(writers.protect_columns(v.part_codes, ["label"], SAMPLE_KEY), ["label"], SAMPLE_KEY),
         "SELECT p_partkey, label, code FROM part_codes")
