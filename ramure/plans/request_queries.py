"""Registered queries of the pages and the request tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ramure.operators import pages as pg
from ramure.operators import requests as rq
from ramure.plans.registry import register
from ramure.plans.text_queries import quoted

SPACE = "'[\\s\\x0B\\x85\\p{Z}]+'"


def lines_sql(source: str, key: str, code: str, html: str) -> dict[str, str]:
    """Page lines, their place relative to the first marker lines, and their section and content."""
    nested = "|".join(pg.NESTED_ELEMENTS)
    step = "CASE WHEN regexp_matches(part, '(?i)^<({0})\\b') THEN 1 WHEN regexp_matches(part, '(?i)^</({0})\\b') THEN -1 ELSE 0 END"
    ctes = {
        "cut_pages": f"""SELECT k, code, unnest(ps) AS part, unnest(range(1, len(ps) + 1)) AS pos FROM (
            SELECT {key} AS k, {code} AS code, string_split(regexp_replace(regexp_replace({html}, {quoted(pg.RAW_PATTERN)}, '', 'g'),
                   '(?i)(</?(?:{pg.TAGS})\\b)', chr(1) || '\\1', 'g'), chr(1)) AS ps FROM {source}) s""",
        # a depth that never falls below zero: the running sum less its lowest value so far
        "kept_parts": f"""SELECT k, code, part, pos FROM (SELECT *, min(d) OVER w AS low FROM (
            SELECT *, sum({step.format(nested)}) OVER w AS d FROM cut_pages WINDOW w AS (PARTITION BY k ORDER BY pos)) a
            WINDOW w AS (PARTITION BY k ORDER BY pos)) b WHERE d - least(low, 0) = 0""",
    }
    contents = []
    for i, (element, css_class) in enumerate(pg.CONTENT_ELEMENTS):
        ctes[f"content_{i}"] = f"""SELECT k, regexp_replace(string_agg(part, '' ORDER BY pos), '^<[^>]*>', '') AS t FROM (
            SELECT *, min(d) OVER (PARTITION BY k ORDER BY pos) AS low FROM (
            SELECT *, sum({step.format(element)}) OVER (PARTITION BY k ORDER BY pos) AS d FROM (SELECT p.* FROM kept_parts p JOIN (
                SELECT k, min(pos) AS start FROM kept_parts WHERE regexp_matches(part, {quoted(pg.opening_pattern(element, css_class))}) GROUP BY k) f
                ON p.k = f.k AND pos >= start) p) d) l WHERE low > 0 GROUP BY k"""
        contents.append(f"nullif(c{i}.t, '')")
    joins = " ".join(f"LEFT JOIN content_{i} c{i} ON c{i}.k = a.k" for i in range(len(contents)))
    ctes["stripped"] = (f"SELECT a.k, a.code, coalesce({', '.join(contents)}, a.t) AS t FROM (SELECT k, min(code) AS code, "
                        f"string_agg(part, '' ORDER BY pos) AS t FROM kept_parts GROUP BY k) a {joins}")
    plain = "regexp_replace(t, '(?s)<[^>]*>', chr(10), 'g')"
    # the numeric entities that the pages have
    for entity, character in ({"&#39;": "'", "&#233;": "é", "&#x20AC;": "€"} | pg.ENTITIES).items():
        plain = f"replace({plain}, {quoted(entity)}, {quoted(character)})"
    navigation = " OR ".join(f"contains(lower(line), {quoted(word)})" for word in pg.NAVIGATION_WORDS)
    excluding = "(contains(lower(line), 'ne comprend pas') OR contains(lower(line), 'ne couvre pas'))"
    bare = "trim(regexp_replace(trim(regexp_replace(line, '\\d{4}-\\d{2}-\\d{2}T[\\d:.+]+', '', 'g')), ':\\s*\\d{2}/\\d{2}/\\d{4}', '', 'g'))"
    return ctes | {
        "split_lines": f"SELECT k, code, unnest(ls) AS raw, unnest(range(1, len(ls) + 1)) AS pos FROM (SELECT k, code, string_split({plain}, chr(10)) AS ls FROM stripped) s",
        "page_rows": f"SELECT k, code, pos, line, {excluding} AS ex, (NOT {excluding} AND contains(lower(line), 'comprend') "
                     f"AND regexp_matches(lower(line), '(ce |cette |comprend\\s*:)')) AS inc FROM (SELECT k, code, pos, trim(regexp_replace(raw, {SPACE}, ' ', 'g')) AS line "
                     "FROM split_lines) l WHERE length(line) >= 3",
        "moded": "SELECT *, max(CASE WHEN ex THEN 1 ELSE 0 END) OVER w AS out, max(CASE WHEN inc THEN 1 ELSE 0 END) OVER w AS inn FROM page_rows "
                 "WINDOW w AS (PARTITION BY k ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
        "sections": f"""SELECT k, pos, section, content FROM (
            SELECT k, pos, CASE WHEN out = 1 THEN 'n' WHEN inn = 1 THEN 'c' ELSE 'd' END AS section,
                   CASE WHEN ex OR (inc AND out = 0) THEN CASE WHEN contains(line, ':') THEN trim(regexp_replace(line, '^[^:]*:', '')) END
                        WHEN {navigation} OR regexp_matches(line, '^\\d+$') OR regexp_matches(line, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN NULL
                        WHEN out = 0 AND inn = 0 AND (length({bare}) <= 10 OR starts_with({bare}, code)) THEN NULL
                        ELSE {bare} END AS content FROM moded) m WHERE content <> ''""",
        "numbered": "SELECT *, row_number() OVER (PARTITION BY k, section ORDER BY pos) AS rn FROM sections",
        "page_texts": f"""SELECT {key}, p.{code} AS code, string_agg(content, ' ' ORDER BY pos) FILTER (WHERE section = 'd' AND rn <= 5) AS description,
                   string_agg(content, ' ' ORDER BY pos) FILTER (WHERE section = 'c') AS comprend,
                   string_agg(content, ' ' ORDER BY pos) FILTER (WHERE section = 'n') AS ne_comprend_pas
            FROM {source} p LEFT JOIN numbered ON k = {key} GROUP BY 1, 2""",
    }


register("page_sections", lambda v: pg.page_sections(v.pages.withColumn("code", F.col("url"))).drop("html", "url"),
         "SELECT * FROM page_texts", lines_sql("pages", "page_id", "url", "html"))
register("code_page_sections", lambda v: pg.page_sections(v.code_pages).drop("html"),
         "SELECT * FROM page_texts", lines_sql("code_pages", "page_id", "code", "html"))


def described(v):
    """Every code with each of its pages."""
    return pg.attach_descriptions(v.taxonomy, pg.page_sections(v.code_pages))


DESCRIBED = lines_sql("code_pages", "page_id", "code", "html")
TEXTS = "SELECT t.code, t.libelle, description, comprend, ne_comprend_pas FROM taxonomy t LEFT JOIN page_texts p ON t.code = p.code"
register("attach_descriptions", described, TEXTS, DESCRIBED)
register("description_coverage", lambda v: pg.description_coverage(described(v)),
         f"SELECT count(*) AS n, count(description) AS n_description, count(comprend) AS n_comprend FROM ({TEXTS}) d", DESCRIBED)

REGULAR = "NOT (starts_with(code, '98') OR starts_with(code, '99'))"
register("taxonomy_lines", lambda v: rq.taxonomy_lines(v.taxonomy),
         f"""SELECT t.code, t.code || ' - ' || libelle || coalesce('  [' || path || ']', '') AS line FROM regular t LEFT JOIN (
                SELECT c.code, string_agg(a.libelle, ' > ' ORDER BY length(a.code)) AS path FROM regular c JOIN regular a
                ON starts_with(c.code, a.code || '.') GROUP BY c.code) p ON t.code = p.code WHERE len(string_split(t.code, '.')) = 4""",
         {"regular": f"SELECT * FROM taxonomy WHERE {REGULAR}"})
register("generation_requests", lambda v: rq.generation_requests(described(v), 5, 12),
         f"""SELECT code, libelle, 12 AS n, i AS comprend_section, e AS ne_comprend_section,
                    'Donne 12 noms de produits, un par ligne, pour ' || libelle || ' (' || code || ').' || CASE WHEN i <> '' THEN chr(10) || i ELSE '' END
                    || CASE WHEN e <> '' THEN chr(10) || e ELSE '' END AS prompt
             FROM (SELECT code, libelle, coalesce('Cette catégorie comprend: ' || comprend, '') AS i,
                          coalesce('Cette catégorie NE comprend PAS: ' || ne_comprend_pas, '') AS e
                   FROM ({TEXTS}) t WHERE len(string_split(code, '.')) = 5 AND {REGULAR}) s""", DESCRIBED)

RECORD = ("'{\"produit\":' || to_json(l_pr_product) || coalesce(',\"magasin\":' || to_json(shop_type_name), '') "
          "|| coalesce(',\"montant\":' || to_json(budget), '') || '}'")


def records(v):
    return rq.request_records(v.preds, "l_pr_product", {"magasin": "shop_type_name", "montant": "budget"})


register("request_records", lambda v: records(v).select("id", "record"), f"SELECT id, {RECORD} AS record FROM preds")
register("request_records_plain", lambda v: rq.request_records(v.preds, "l_pr_product").select("id", "record"),
         "SELECT id, l_pr_product AS record FROM preds")


register("assemble_batches", lambda v: rq.assemble_batches(rq.request_records(v.preds, "l_pr_product"), "record", "id", 20),
         """SELECT (rn - 1) // 20 AS batch, count(*) AS n, CAST(to_json(list(record ORDER BY rn)) AS VARCHAR) AS payload
            FROM (SELECT l_pr_product AS record, row_number() OVER (ORDER BY id) AS rn FROM preds) r GROUP BY (rn - 1) // 20""")

# answers to batches of orders: plain, fenced, short, or not an array, by number
ANSWERS = """SELECT batch_id, n, CASE WHEN batch_id % 5 = 0 THEN '```json' || chr(10) || items || chr(10) || '```'
                  WHEN batch_id % 5 = 1 THEN ' ' || items || ' ' WHEN batch_id % 5 = 2 THEN '```' || items || '```'
                  WHEN batch_id % 5 = 3 THEN '{"codes": 1}' ELSE items || ' trailing' END AS response
             FROM answer_items"""


def answers(v):
    grouped = v.preds.groupBy(F.expr("id div 10").alias("batch_id")).agg(
        F.count("*").cast("int").alias("n"),
        F.sort_array(F.collect_list(F.when(F.col("id") % 9 != 4, F.struct("id", "predicted_code"))))["predicted_code"].alias("codes"))
    items = grouped.select("batch_id", "n", F.concat(F.lit('["'), F.array_join("codes", '","'), F.lit('"]')).alias("items"))
    fence, line = F.lit("```"), F.lit("\n")
    kind = F.col("batch_id") % 5
    return items.select(
        "batch_id", "n",
        F.when(kind == 0, F.concat(F.lit("```json"), line, "items", line, fence)).when(kind == 1, F.concat(F.lit(" "), "items", F.lit(" ")))
        .when(kind == 2, F.concat(fence, "items", fence)).when(kind == 3, F.lit('{"codes": 1}'))
        .otherwise(F.concat("items", F.lit(" trailing"))).alias("response"))


register("parse_code_response",
         lambda v: rq.parse_code_response(answers(v), "response", "n", v.taxonomy),
         """SELECT batch_id, n, position, CASE WHEN batch_id % 5 < 3 THEN a.code END AS code,
                   coalesce(batch_id % 5 < 3 AND t.code IS NOT NULL, false) AS is_valid
            FROM (SELECT batch_id, n, CAST(unnest(range(0, n)) AS INTEGER) AS position FROM
                  (SELECT id // 10 AS batch_id, CAST(count(*) AS INTEGER) AS n FROM preds GROUP BY 1) b) p
            LEFT JOIN (SELECT id // 10 AS batch_id, row_number() OVER (PARTITION BY id // 10 ORDER BY id) - 1 AS position, predicted_code AS code
                       FROM preds WHERE id % 9 <> 4 AND predicted_code IS NOT NULL) a USING (batch_id, position)
            LEFT JOIN taxonomy t ON t.code = a.code""")
register("attach_labels", lambda v: rq.attach_labels(v.preds.select("id", F.col("predicted_code").alias("code")), v.taxonomy),
         "SELECT id, predicted_code AS code, coalesce(libelle, '') AS coicop_libelle FROM preds LEFT JOIN taxonomy t ON predicted_code = t.code")
register("pending_rows", lambda v: rq.pending_rows(v.preds.select("id", "code"), v.preds.where("id % 3 = 0"), "id"),
         "SELECT id, code FROM preds WHERE id % 3 <> 0")


def bulleted(v):
    """Assistant turns as answers: some lines get bullets or numbers."""
    return v.conversations.select("conv_id", "turn", F.replace(F.replace(F.replace(
        "text", F.lit(". "), F.lit("\n- ")), F.lit(", "), F.lit("\n12) ")), F.lit(" la "), F.lit("\n3: ")).alias("response"))


register("parse_product_lines", lambda v: rq.parse_product_lines(bulleted(v), "response", 10),
         """SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY pos) - 1 AS INTEGER) AS position, product FROM (
              SELECT conv_id, turn, pos, CASE WHEN regexp_matches(bare, '^[0-9][.):]') AND length(bare) > 2 THEN trim(substr(bare, 3))
                     WHEN regexp_matches(bare, '^[0-9]{2}[.):]') AND length(bare) > 3 THEN trim(substr(bare, 4)) ELSE bare END AS product
              FROM (SELECT conv_id, turn, pos, regexp_replace(line, '^(- |• |\\* |– )', '') AS bare FROM (
                    SELECT conv_id, turn, pos, trim(raw) AS line FROM (
                      SELECT conv_id, turn, unnest(ls) AS raw, unnest(range(0, len(ls))) AS pos FROM (
                        SELECT conv_id, turn, string_split(replace(replace(replace(text, '. ', chr(10) || '- '), ', ', chr(10) || '12) '), ' la ', chr(10) || '3: '), chr(10)) AS ls
                        FROM conversations) s) u) t WHERE line <> '' AND length(line) <= 80 AND NOT ("""
         + " OR ".join(f"contains(lower(line), {quoted(word)})" for word in rq.INTRODUCTIONS)
         + ")) b) p WHERE product <> '' QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY pos) <= 10")
