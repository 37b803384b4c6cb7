"""Views of the shapes the operators work on, derived from the given tables.

Each view is one SQL text that Spark and DuckDB both read, so a query and its oracle start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    # a hierarchical code that is a function of the product's text; some 98/99, some unpadded, depths 1 to 5
    "part_codes": """
        SELECT p_partkey, p_name || ' ' || p_type AS label,
               CASE WHEN p_partkey % 100 = 18 THEN n1
                    WHEN p_partkey % 100 = 8 THEN n1 || '.' || n2
                    WHEN p_partkey % 10 = 9 THEN n1 || '.' || n2 || '.' || n3
                    WHEN p_partkey % 10 >= 6 THEN n1 || '.' || n2 || '.' || n3 || '.' || n4
                    ELSE n1 || '.' || n2 || '.' || n3 || '.' || n4 || '.' || n5 END AS code
        FROM (SELECT p_partkey, p_name, p_type,
                     CASE WHEN p_partkey % 50 = 0 THEN '98'
                          WHEN p_partkey % 50 = 25 THEN '99'
                          WHEN p_partkey % 20 = 3 THEN CAST(1 + ascii(split_part(p_name, ' ', 2)) % 13 AS STRING)
                          ELSE lpad(CAST(1 + ascii(split_part(p_name, ' ', 2)) % 13 AS STRING), 2, '0') END AS n1,
                     CAST(1 + length(split_part(p_name, ' ', 2)) % 3 AS STRING) AS n2,
                     CAST(1 + ascii(p_name) % 4 AS STRING) AS n3,
                     CAST(1 + length(p_type) % 5 AS STRING) AS n4,
                     CAST(1 + p_size % 3 AS STRING) AS n5
              FROM part) named_segments""",
    # transactions
    "products": """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_orderkey % 3 = 0 THEN replace(words, 'e', 'é') ELSE words END
               || CASE WHEN l_orderkey % 11 = 0 THEN ' rien du tout'
                       WHEN l_orderkey % 11 = 1 THEN ' ' || p_type || ' !! 2x' || CAST(p_size AS STRING)
                       ELSE '' END AS description_ean,
               CASE WHEN l_partkey % 5 = 0 THEN '99.' || CAST(p_size AS STRING) ELSE code END AS variete,
               CAST(p_size AS STRING) AS id_famille,
               CAST(year(l_shipdate) AS INT) AS annee, CAST(month(l_shipdate) AS INT) AS mois
        FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, p_type, p_size, code,
                     p_name || ' ' || p_type || ' ' || p_brand AS words
              FROM lineitem JOIN part ON l_partkey = part.p_partkey
                            JOIN part_codes ON part.p_partkey = part_codes.p_partkey) joined""",
    "famille": """
        SELECT CAST(p_size AS STRING) AS id_famille, max(code) AS coicop
        FROM part JOIN part_codes ON part.p_partkey = part_codes.p_partkey
        WHERE p_size % 7 <> 0 GROUP BY p_size""",
    "passage": """
        SELECT code AS code_variete_ecoicopv1, min(p_brand) || '/' || code AS code_sous_classe_ecoicopv2
        FROM part JOIN part_codes ON part.p_partkey = part_codes.p_partkey
        WHERE length(code) >= 8 GROUP BY code""",
    "synthetic": """
        SELECT p_name || ' ' || p_type AS product, code
        FROM part JOIN part_codes ON part.p_partkey = part_codes.p_partkey""",
    "taxonomy": """
        SELECT code, 'label ' || code AS libelle
        FROM (SELECT DISTINCT regexp_extract(code, '^[^.]+', 0) AS code FROM part_codes
              UNION SELECT DISTINCT regexp_extract(code, '^[^.]+[.][^.]+', 0) FROM part_codes
              UNION SELECT DISTINCT regexp_extract(code, '^[^.]+[.][^.]+[.][^.]+', 0) FROM part_codes
              UNION SELECT DISTINCT regexp_extract(code, '^[^.]+[.][^.]+[.][^.]+[.][^.]+', 0) FROM part_codes
              UNION SELECT DISTINCT code FROM part_codes) prefixes
        WHERE code <> '' AND code <> '02.1'""",
    # predictions to evaluate, one row per order
    "preds": """
        SELECT o_orderkey AS id, t.code AS code, t.label AS l_pr_product,
               CASE WHEN o_orderkey % 53 <> 0 THEN p1.code END AS predicted_code,
               p2.code AS predicted_code_top2,
               CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE p3.code END AS predicted_code_top3,
               CASE WHEN o_orderkey % 97 <> 0 THEN ((o_orderkey * 7 + o_custkey) % 101) / 100e0 END AS confidence,
               o_orderpriority AS source, CAST(year(o_orderdate) AS STRING) AS annee,
               'shop' || CAST(o_custkey % 40 AS STRING) AS shop,
               CASE WHEN o_custkey % 29 <> 0 THEN n_name END AS shop_type_name,
               CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN 'n/a'
                    ELSE CAST(o_orderkey % 131 - 3 AS STRING) END AS budget,
               o_orderkey % 2 = 0 AS manual_from_app, o_orderkey % 3 = 0 AS manual_from_books,
               o_orderkey % 5 = 0 AS receips_from_app, o_orderkey % 7 = 0 AS suggester
        FROM (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate,
                     (o_orderkey * 7) % (SELECT count(*) FROM part) AS k0,
                     (o_orderkey * 7 + CASE WHEN o_orderkey % 10 < 6 THEN 0 ELSE o_orderkey % 64 + 1 END)
                     % (SELECT count(*) FROM part) AS k1,
                     (o_orderkey * 7 + (o_orderkey % 2) * 64) % (SELECT count(*) FROM part) AS k2,
                     (o_orderkey * 7 + (o_orderkey % 3) * 128) % (SELECT count(*) FROM part) AS k3
              FROM orders) o
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN part_codes t ON t.p_partkey = k0
        JOIN part_codes p1 ON p1.p_partkey = k1
        JOIN part_codes p2 ON p2.p_partkey = k2
        JOIN part_codes p3 ON p3.p_partkey = k3""",
    # evaluation rows of annotated files, all text, with their three kinds of source
    "annotated": """
        SELECT id, l_pr_product AS product, code,
               CASE WHEN id % 13 = 0 THEN ' ' ELSE replace(budget, '.', ',') || ',50' END AS montant,
               CASE WHEN id % 4 = 0 THEN 'Hypermarchés' ELSE 'Autre' END AS magasin,
               CASE WHEN id % 3 = 0 THEN 'depenses_manuelles_carnets' WHEN id % 3 = 1 THEN 'tickets_application'
                    ELSE 'ajouts_manuels_application' END AS source_file,
               predicted_code, predicted_code_top2, predicted_code_top3
        FROM preds""",
    # pages of codes, with the phrases that open their sections around the given article
    "code_pages": """
        SELECT page_id, code,
               replace(replace(html, '<article>', '<article><p>' || code || ' rubrique de la nomenclature des codes</p><p>Une description '
                   || 'assez longue &amp; claire : 01/02/2024</p><p>Ce poste comprend : des produits</p>'),
                   '</article>', '<p>Cela ne comprend pas : les autres produits</p><article><p>un encart au caf&#233; à 3 &#x20AC;</p></article><p>exclus depuis 2024-01-02T10:11:12.5 sans retour</p>'
                   || '<p>2024-01-02 mise en ligne</p><p>12345</p><p>Cette liste comprend tout</p><p>Accueil du site</p></article>') AS html
        FROM pages JOIN part_codes ON page_id = p_partkey""",
    # codes and all codes above them, with the code directly above
    "code_steps": """
        SELECT code AS leaf, 1 AS level, '' AS parent_code, regexp_extract(code, '^[^.]+', 0) AS code FROM part_codes
        UNION SELECT code, 2, regexp_extract(code, '^[^.]+', 0), regexp_extract(code, '^[^.]+[.][^.]+', 0) FROM part_codes
        UNION SELECT code, 3, regexp_extract(code, '^[^.]+[.][^.]+', 0), regexp_extract(code, '^[^.]+[.][^.]+[.][^.]+', 0) FROM part_codes
        UNION SELECT code, 4, regexp_extract(code, '^[^.]+[.][^.]+[.][^.]+', 0), regexp_extract(code, '^[^.]+[.][^.]+[.][^.]+[.][^.]+', 0) FROM part_codes
        UNION SELECT code, 5, regexp_extract(code, '^[^.]+[.][^.]+[.][^.]+[.][^.]+', 0),
                     regexp_extract(code, '^[^.]+[.][^.]+[.][^.]+[.][^.]+[.][^.]+', 0) FROM part_codes""",
    # candidate codes of customers: those of all products they ordered and the codes above, with a confidence per code
    "scores": """
        SELECT id, level, parent_code, code,
               ((id * 7 + ascii(substring(code, 1, 1)) * 13 + length(code) * 31
                 + ascii(substring(code, length(code), 1)) * 17) % 97 + 1) / 100e0 AS confidence
        FROM (SELECT DISTINCT id, level, parent_code, s.code
              FROM (SELECT DISTINCT o_custkey AS id, code AS leaf FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                    JOIN part_codes ON p_partkey = l_partkey) bought
              JOIN code_steps s ON s.leaf = bought.leaf WHERE s.code <> '') candidates""",
}


#: The confidence of a candidate in the view `scores`.
CONFIDENCE = re.search(r"code,\s*(\(\(id.*100e0) AS confidence", VIEWS["scores"], re.DOTALL).group(1)


def _needed(text: str) -> list[str]:
    """Views the SQL text mentions, with those they are built on, in definition order."""
    found: set[str] = set()

    def visit(sql: str) -> None:
        for name in VIEWS:
            if name not in found and re.search(rf"\b{name}\b", sql):
                found.add(name)
                visit(VIEWS[name])

    visit(text)
    return [name for name in VIEWS if name in found]


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """`body` preceded by the common table expressions it uses; `extra` adds query-specific ones."""
    extra = extra or {}
    needed_extra = [name for name in extra]
    joined = " ".join([body, *extra.values()])
    parts = [f"{name} AS ({VIEWS[name]})" for name in _needed(joined)]
    parts += [f"{name} AS ({extra[name]})" for name in needed_extra]
    return f"WITH {', '.join(parts)} {body}" if parts else body


class Views:
    """The given tables and derived views of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        if name not in VIEWS:
            raise AttributeError(name)
        if name == "scores":
            return self._scores()
        return self.sql(f"SELECT * FROM {name}")

    def _scores(self) -> DataFrame:
        """The view `scores`: products go to their customer's partition once, and nothing that follows customer by customer moves them again."""
        bought = self.sql("""SELECT o_custkey AS id, code AS leaf FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                             JOIN part_codes ON p_partkey = l_partkey""").repartition("id").distinct()
        # as many steps as the nomenclature has
        steps = F.broadcast(self.code_steps.where("code <> ''"))
        candidates = bought.join(steps, "leaf").select("id", "level", "parent_code", "code").distinct()
        return candidates.withColumn("confidence", F.expr(CONFIDENCE))

    def sql(self, body: str) -> DataFrame:
        text = with_views(body)
        for table in TABLES:
            source = f"parquet.`{self.sf_dir}/{table}.parquet`"
            text = re.sub(rf"\b(FROM|JOIN) {table}\b", lambda match: f"{match.group(1)} {source} AS {table}", text)
        return self.spark.sql(text)
