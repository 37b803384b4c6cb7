"""Registered queries of training sets, decoding and naive Bayes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ramure.functions import codes
from ramure.operators import bayes, decode
from ramure.operators import training as tr
from ramure.plans.registry import level_sql, register
from ramure.plans.text_queries import GRAMS, WORDS, token_ctes
from ramure.session import spread

# ---- training sets -------------------------------------------------------------------------------------------------

CAP = 40


def observed(v):
    return v.products.select(F.col("description_ean").alias("product"), F.col("variete").alias("code"), F.lit("ddc").alias("source"))


def fill(v):
    return v.synthetic.withColumn("source", F.lit("synthetic"))


DEDUP_OBSERVED = "SELECT DISTINCT description_ean AS product, variete AS code FROM products"
DEDUP_SYNTHETIC = "SELECT DISTINCT product, code FROM synthetic"

register("dedup_pairs", lambda v: tr.dedup_pairs(observed(v)), f"SELECT product, code, 'ddc' AS source FROM ({DEDUP_OBSERVED}) d")


def capped_sql(observed_sql: str, synthetic_sql: str, columns: str, cap: int) -> dict[str, str]:
    key = "array_to_string(list_slice(string_split(code, '.'), 1, 4), '.')"
    ranked = ("SELECT *, row_number() OVER (PARTITION BY key4 ORDER BY md5('42|' || product || '|' || code), product, code) AS rn, "
              "count(*) OVER (PARTITION BY key4) AS n FROM (SELECT *, " + key + " AS key4 FROM ({source}) s) k")
    return {
        "ranked_first": ranked.format(source=observed_sql), "ranked_second": ranked.format(source=synthetic_sql),
        "capped": f"SELECT {columns}, 'ddc' AS source FROM ranked_first WHERE rn <= {cap} UNION ALL "
                  f"SELECT {columns.replace('product', 's.product').replace('code', 's.code')}, 'synthetic' FROM ranked_second s "
                  f"LEFT JOIN (SELECT DISTINCT key4 AS k, n AS n_first FROM ranked_first) f ON s.key4 = f.k "
                  f"WHERE rn <= {cap} - least({cap}, coalesce(n_first, 0))",
    }


register("cap_by_stratum",
         lambda v: tr.cap_by_stratum(tr.dedup_pairs(observed(v)), tr.dedup_pairs(fill(v)), CAP).select("product", "code", "source"),
         "SELECT product, code, source FROM capped", capped_sql(DEDUP_OBSERVED, DEDUP_SYNTHETIC, "product, code", CAP))
register("cap_by_stratum_default",
         lambda v: tr.cap_by_stratum(tr.dedup_pairs(observed(v)), tr.dedup_pairs(fill(v))).select("product", "code", "source"),
         "SELECT product, code, source FROM capped", capped_sql(DEDUP_OBSERVED, DEDUP_SYNTHETIC, "product, code", 1000))


def built(v):
    return tr.build_training_data(v.products, v.synthetic, CAP, code_column="variete", words=WORDS)


def cleaned_pairs(name: str, source: str, text: str, code: str, where: str) -> dict[str, str]:
    """Clean text, code and smallest original of a source; names of the token CTEs get a suffix."""
    ctes = token_ctes(f"texts_{name}", "product", "product", WORDS)
    renamed = {}
    for key, sql in ctes.items():
        for other in ctes:
            sql = sql.replace(f"FROM {other}", f"FROM {other}_{name}")
        renamed[f"{key}_{name}"] = sql
    return {
        f"texts_{name}": f"SELECT DISTINCT {text} AS product FROM {source} WHERE {where}", **renamed,
        f"pairs_{name}": f"SELECT clean AS product, {code} AS code, min({text}) AS product_orig FROM {source} "
                         f"JOIN cleaned_{name} ON k = {text} WHERE {where} GROUP BY 1, 2",
    }


register("build_training_data", built,
         "SELECT product, code, source, product_orig, left(code, 8) AS code8 FROM capped",
         {**cleaned_pairs("ddc", "products", "description_ean", "variete", "true"),
          **cleaned_pairs("syn", "synthetic", "product", "code", "true"),
          **{name: sql.replace("product_orig", "product_orig")
             for name, sql in capped_sql("SELECT * FROM pairs_ddc", "SELECT * FROM pairs_syn", "product, code, product_orig", CAP).items()}})
register("training_summary", lambda v: tr.training_summary(tr.dedup_pairs(observed(v)).unionByName(tr.dedup_pairs(fill(v)))),
         f"""SELECT source, CAST(count(*) AS BIGINT) AS n, count(DISTINCT code) AS n_codes, round(count(*) * 1e2 / (SELECT count(*) FROM u), 6) AS share
             FROM u GROUP BY source UNION ALL SELECT NULL, count(*), count(DISTINCT code), 1e2 FROM u""",
         {"u": f"SELECT *, 'ddc' AS source FROM ({DEDUP_OBSERVED}) a UNION ALL SELECT *, 'synthetic' FROM ({DEDUP_SYNTHETIC}) b"})
register("class_weights", lambda v: tr.class_weights(codes.with_levels(v.part_codes), "level4"),
         f"""SELECT label, n, round((SELECT count(*) FROM part_codes) / CAST(n * count(*) OVER () AS DOUBLE), 6) AS weight
             FROM (SELECT {level_sql('code', 4)} AS label, count(*) AS n FROM part_codes WHERE {level_sql('code', 4)} IS NOT NULL GROUP BY 1) c""")
register("filter_rare", lambda v: tr.filter_rare(v.part_codes, "code", 4),
         "SELECT p_partkey, label, code FROM part_codes WHERE code IN (SELECT code FROM part_codes GROUP BY 1 HAVING count(*) >= 4)")
register("rare_report", lambda v: tr.rare_report(v.part_codes, "code", 4),
         """SELECT CAST(coalesce(sum(n) FILTER (WHERE n >= 4), 0) AS BIGINT) AS n_kept, CAST(coalesce(sum(n) FILTER (WHERE n < 4), 0) AS BIGINT) AS n_dropped,
                   count(*) FILTER (WHERE n >= 4) AS classes_kept, count(*) FILTER (WHERE n < 4) AS classes_dropped
            FROM (SELECT code, count(*) AS n FROM part_codes GROUP BY 1) c""")
register("usable_levels", lambda v: tr.usable_levels(codes.with_levels(v.part_codes), 1200),
         "SELECT level, n_rows, n_classes, CASE WHEN n_rows < 1200 THEN 'too few rows' WHEN n_classes < 2 THEN 'too few classes' ELSE 'train' END AS status FROM ("
         + " UNION ALL ".join(
             f"SELECT {n} AS level, CAST(sum(c) AS BIGINT) AS n_rows, count(*) FILTER (WHERE c >= 2) AS n_classes FROM "
             f"(SELECT {level_sql('code', n)} AS l, count(*) AS c FROM part_codes WHERE {level_sql('code', n)} IS NOT NULL GROUP BY 1) g" for n in range(1, 6)) + ") u")
register("label_index", lambda v: tr.label_index(codes.with_levels(v.part_codes), "level3"),
         f"SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS index FROM "
         f"(SELECT DISTINCT {level_sql('code', 3)} AS label FROM part_codes) l WHERE label IS NOT NULL")
register("stratified_split",
         lambda v: tr.stratified_split(codes.with_levels(v.preds.select("id", "code"), levels=(1, 3)), "level3").select("id", "level3", "is_validation"),
         f"""SELECT id, level3, coalesce(level3 IS NOT NULL AND row_number() OVER (PARTITION BY level3 ORDER BY md5('42|' || CAST(id AS VARCHAR)))
                    <= round(0.2e0 * count(*) OVER (PARTITION BY level3)), false) AS is_validation
             FROM (SELECT id, {level_sql('code', 3)} AS level3 FROM preds) p""")
KNOWN = "SELECT DISTINCT code AS label FROM synthetic WHERE length(code) >= 8"
register("known_labels_only",
         lambda v: tr.known_labels_only(v.part_codes, "code", v.synthetic.where(F.length("code") >= 8).select(F.col("code").alias("label")).distinct()),
         f"SELECT p_partkey, label, code FROM part_codes WHERE code IN (SELECT label FROM ({KNOWN}) k)")
register("unknown_label_count",
         lambda v: tr.unknown_label_count(v.part_codes, "code", v.synthetic.where(F.length("code") >= 8).select(F.col("code").alias("label")).distinct()),
         f"""SELECT count(*) FILTER (WHERE code IN (SELECT label FROM ({KNOWN}) k)) AS n_known,
                    count(*) FILTER (WHERE code NOT IN (SELECT label FROM ({KNOWN}) k)) AS n_unknown FROM part_codes""")
register("multi_level_labels", lambda v: tr.multi_level_labels(codes.with_levels(v.part_codes)).select("p_partkey", *[f"label{n}" for n in range(1, 6)]),
         "SELECT p_partkey, " + ", ".join(f"i{n}.i AS label{n}" for n in range(1, 6)) + " FROM part_codes "
         + " ".join(
             f"LEFT JOIN (SELECT l, CAST(row_number() OVER (ORDER BY l) - 1 AS INTEGER) AS i FROM (SELECT {level_sql('code', n)} AS l FROM part_codes "
             f"GROUP BY 1 HAVING count(*) >= 2 AND l IS NOT NULL) g) i{n} ON i{n}.l = {level_sql('code', n)}" for n in range(1, 6)))
PARENTS = (f"SELECT parent, CAST(row_number() OVER (ORDER BY parent) - 1 AS INTEGER) AS index FROM (SELECT DISTINCT {level_sql('code', 2)} AS parent "
           f"FROM part_codes WHERE {level_sql('code', 3)} IS NOT NULL) p")
register("parent_vocab", lambda v: tr.parent_vocab(codes.with_levels(v.part_codes), 3), PARENTS)
register("parent_index",
         lambda v: tr.parent_index(codes.with_levels(v.preds).select("id", "level2"), "level2", tr.parent_vocab(codes.with_levels(v.part_codes), 3)),
         f"SELECT id, level2, coalesce(index, 0) AS parent_index FROM (SELECT id, {level_sql('code', 2)} AS level2 FROM preds) p LEFT JOIN ({PARENTS}) v ON parent = level2")

# ---- decoding ------------------------------------------------------------------------------------------------------

FORCED = "CAST(('0x' || left(md5('42|3|' || CAST(id AS VARCHAR)), 7)) AS BIGINT) % 10000 / 1e4 < 1 - 0.7e0"


def forced(v):
    rows = v.preds.select("id", codes.code_level("code", 2).alias("parent"), codes.code_level("predicted_code", 2).alias("predicted_parent"), "confidence")
    return decode.teacher_force(rows, 3, 0.7).select("id", "parent_used", "bucket")


register("teacher_force", forced,
         f"""SELECT id, CASE WHEN {FORCED} AND pp IS NOT NULL THEN pp ELSE tp END AS parent_used,
                    CAST(least(greatest(floor(coalesce(confidence, 0.9e0) * 10), 0), 9) AS INTEGER) AS bucket
             FROM (SELECT *, {level_sql('code', 2)} AS tp, {level_sql('predicted_code', 2)} AS pp FROM preds) p""")
register("bucket_confidence", lambda v: v.preds.select("id", decode.bucket_confidence(F.col("confidence")).alias("bucket")),
         "SELECT id, CASE WHEN confidence IS NOT NULL THEN CAST(least(greatest(floor(confidence * 10), 0), 9) AS INTEGER) ELSE CAST(least(greatest(NULL, 0), 9) AS INTEGER) END AS bucket FROM preds")

CASCADE = {
    "best": "SELECT id, level, parent_code, code, confidence FROM (SELECT *, row_number() OVER (PARTITION BY id, level, parent_code ORDER BY confidence DESC, code) AS rn FROM scores) s WHERE rn = 1",
    "l1": "SELECT id, code, confidence FROM best WHERE level = 1",
    **{f"l{n}": f"SELECT b.id, b.code, b.confidence FROM best b JOIN l{n - 1} ON b.id = l{n - 1}.id AND level = {n} AND parent_code = l{n - 1}.code"
       for n in codes.LEVELS[1:]},
    "path": " UNION ALL ".join(f"SELECT id, {n} AS level, code, confidence FROM l{n}" for n in codes.LEVELS),
}
register("cascade_decode", lambda v: decode.path_long(decode.cascade_decode(v.scores)),
         "SELECT id, level, 1 AS rank, code, round(confidence, 6) AS confidence FROM path", CASCADE)
register("combine_confidence",
         lambda v: decode.combine_confidence(decode.cascade_decode(v.scores), 0.5).drop("path"),
         """SELECT i.id, coalesce(max(code ORDER BY level) FILTER (WHERE top), '') AS final_code, coalesce('level' || max(level) FILTER (WHERE ok), '') AS final_level,
                   round(coalesce(max(confidence) FILTER (WHERE top), 0e0), 6) AS final_confidence,
                   round(coalesce(product(confidence) FILTER (WHERE ok), 1e0), 6) AS combined_confidence
            FROM (SELECT DISTINCT id FROM scores) i LEFT JOIN (
                SELECT *, ok AND level = max(CASE WHEN ok THEN level END) OVER (PARTITION BY id) AS top
                FROM (SELECT *, bool_and(confidence >= 0.5) OVER (PARTITION BY id ORDER BY level) AS ok FROM path) o) p ON i.id = p.id GROUP BY i.id""".replace(
             "max(code ORDER BY level)", "max(code)"), CASCADE)
def beam_ctes(size: int) -> dict[str, str]:
    """Beams step by step: each one joined with its best children, beams without children kept, the best ones taken."""
    ctes = {"top_children": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, level, parent_code ORDER BY confidence DESC, code) AS rn "
                            f"FROM scores) s WHERE rn <= {size}",
            "beam0": "SELECT DISTINCT id, 0e0 AS lp, CAST([] AS VARCHAR[]) AS path, CAST([] AS INTEGER[]) AS lv, CAST([] AS DOUBLE[]) AS cf, '' AS tail FROM scores"}
    for n in codes.LEVELS:
        ctes[f"grown{n}"] = f"""
            SELECT b.id, CASE WHEN c.code IS NULL THEN lp ELSE lp + ln(greatest(c.confidence, 1e-9)) END AS lp,
                   CASE WHEN c.code IS NULL THEN path ELSE list_append(path, c.code) END AS path,
                   CASE WHEN c.code IS NULL THEN lv ELSE list_append(lv, {n}) END AS lv,
                   CASE WHEN c.code IS NULL THEN cf ELSE list_append(cf, c.confidence) END AS cf, coalesce(c.code, tail) AS tail
            FROM beam{n - 1} b LEFT JOIN top_children c ON b.id = c.id AND c.level = {n} AND c.parent_code = b.tail"""
        ctes[f"beam{n}"] = f"""SELECT id, lp, path, lv, cf, tail FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(-lp, 9), path) AS place
                               FROM grown{n}) g WHERE place <= {size}"""
    ctes["beam_rows"] = """SELECT id, CAST(unnest(lv) AS INTEGER) AS level, CAST(rank AS INTEGER) AS rank, unnest(path) AS code, unnest(cf) AS confidence
                           FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(-lp, 9), path) AS rank FROM beam5) r"""
    return ctes


register("decode_wide", lambda v: decode.to_wide(decode.beam_long(decode.beam_decode(v.scores, 2)), codes.LEVELS, 2),
         "SELECT id, " + ", ".join(
             f"coalesce(max(CASE WHEN level = {n} AND rank = {r} THEN code END), '') AS predicted_level{n}{'_top2' if r == 2 else ''}, "
             f"round(coalesce(max(CASE WHEN level = {n} AND rank = {r} THEN confidence END), 0e0), 6) AS confidence_level{n}{'_top2' if r == 2 else ''}"
             for n in codes.LEVELS for r in (1, 2)) + " FROM beam_rows GROUP BY id",
         beam_ctes(2))
register("beam_decode", lambda v: decode.beam_long(decode.beam_decode(v.scores, 3)),
         "SELECT id, level, rank, code, round(confidence, 6) AS confidence FROM beam_rows", beam_ctes(3))
register("beam_result", lambda v: decode.beam_result(decode.beam_decode(v.scores, 3)),
         "SELECT id, tail AS final_code, 'level' || lv[-1] AS final_level, round(cf[-1], 6) AS final_confidence, round(exp(lp), 6) AS combined_confidence "
         "FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(-lp, 9), path) AS place FROM beam5) b WHERE place = 1", beam_ctes(3))

PROBS = "SELECT id, level, code, CASE WHEN id % 11 = 0 AND level = 2 THEN 0e0 ELSE confidence / 10 END AS p FROM scores"


def probabilities(v):
    p = F.when((F.col("id") % 11 == 0) & (F.col("level") == 2), F.lit(0.0)).otherwise(F.col("confidence") / 10)
    return v.scores.select("id", "level", "code", p.alias("p"))


def children(v):
    """Children of the codes seen; one parent is left without children."""
    return v.scores.where((F.col("level") > 1) & (F.col("parent_code") != "13")).select(
        "level", F.col("parent_code").alias("parent"), F.col("code").alias("child")).distinct()


MASK = {"probs": PROBS,
        "kids": "SELECT DISTINCT level, parent_code AS parent, code AS child FROM scores WHERE level > 1 AND parent_code <> '13'",
        "m1": "SELECT id, code, p FROM probs WHERE level = 1"}
for n in codes.LEVELS[1:]:
    MASK[f"c{n}"] = f"SELECT id, max((p, code)) AS best FROM m{n - 1} GROUP BY id"
    MASK[f"v{n}"] = (f"SELECT p.id, p.code, p.p, k.child IS NOT NULL AS ok FROM probs p LEFT JOIN c{n} c ON p.id = c.id "
                     f"LEFT JOIN kids k ON k.level = {n} AND k.child = p.code AND k.parent = c.best[2] WHERE p.level = {n}")
    MASK[f"m{n}"] = (f"SELECT id, code, CASE WHEN n_ok = 0 THEN p WHEN NOT ok THEN 0e0 WHEN total > 0 THEN p / total ELSE 1e0 / n_ok END AS p FROM "
                     f"(SELECT *, count(*) FILTER (WHERE ok) OVER (PARTITION BY id) AS n_ok, sum(p) FILTER (WHERE ok) OVER (PARTITION BY id) AS total FROM v{n}) w")
register("mask_children", lambda v: decode.mask_children(probabilities(v), children(v)),
         " UNION ALL ".join(f"SELECT id, {n} AS level, code, round(p, 6) AS p FROM m{n}" for n in codes.LEVELS), MASK)

# ---- naive Bayes ---------------------------------------------------------------------------------------------------


def level1_rows(v):
    """Product names with their division."""
    return spread(v.part_codes).select(F.col("p_partkey").alias("id"), "label", codes.code_level("code", 1).alias("level1"))


NB = {
    **GRAMS,
    "targets": f"SELECT p_partkey AS k, {level_sql('code', 1)} AS l FROM part_codes",
    "model": "SELECT l, ngram, CAST(count(*) AS DOUBLE) AS n FROM grams JOIN targets USING (k) GROUP BY l, ngram",
    "sizes": "SELECT l, CAST(count(*) AS DOUBLE) AS n FROM targets GROUP BY l",
}


def nb_sql(top: int) -> dict[str, str]:
    return {
        "norms": "SELECT s.l, ln(s.n) AS prior, ln(coalesce(t, 0) + (SELECT count(DISTINCT ngram) FROM model)) AS den FROM sizes s "
                 "LEFT JOIN (SELECT l, sum(n) AS t FROM model GROUP BY l) m ON s.l = m.l",
        "bags": "SELECT k, ngram, count(*) AS tf FROM grams WHERE ngram IN (SELECT ngram FROM model) GROUP BY k, ngram",
        "loglik": "SELECT b.k, s.l, prior + sum(tf * (ln(coalesce(m.n, 0) + 1) - den)) AS score FROM bags b CROSS JOIN norms s "
                  "LEFT JOIN model m ON m.l = s.l AND m.ngram = b.ngram GROUP BY b.k, s.l, prior, den",
        "soft": "SELECT k, l, exp(score - max(score) OVER (PARTITION BY k)) / sum(exp(score - mx)) OVER (PARTITION BY k) AS conf, "
                f"row_number() OVER (PARTITION BY k ORDER BY round(-score, 9), l) AS rank FROM (SELECT *, max(score) OVER (PARTITION BY k) AS mx FROM loglik) x",
        "ranked": f"SELECT * FROM soft WHERE rank <= {top}",
    }


register("nb_counts", lambda v: bayes.nb_counts(level1_rows(v), "label", "level1").grams,
         "SELECT l AS label, ngram, n FROM model", NB)
register("nb_score", lambda v: bayes.nb_score(level1_rows(v), bayes.nb_counts(level1_rows(v), "label", "level1"), "label", top_k=3),
         "SELECT k AS id, CAST(rank AS INTEGER) AS rank, l AS code, round(conf, 6) AS confidence FROM ranked", {**NB, **nb_sql(3)})
register("nb_wide",
         lambda v: decode.to_wide_flat(bayes.nb_score(level1_rows(v), bayes.nb_counts(level1_rows(v), "label", "level1"), "label", top_k=2), 2),
         "SELECT k AS id, max(CASE WHEN rank = 1 THEN l END) AS predicted_code, round(max(CASE WHEN rank = 1 THEN conf END), 6) AS confidence, "
         "max(CASE WHEN rank = 2 THEN l END) AS predicted_code_top2, round(max(CASE WHEN rank = 2 THEN conf END), 6) AS confidence_top2 FROM ranked GROUP BY k",
         {**NB, **nb_sql(2)})


def tuned(v):
    base = bayes.nb_counts(level1_rows(v).where(F.col("level1") != "13"), "label", "level1")
    new = v.products.select(F.col("description_ean").alias("text"), codes.code_level("variete", 1).alias("level1"))
    return bayes.fine_tune(base, new, "text", "level1", 0.5)


register("fine_tune_counts", lambda v: tuned(v).grams,
         """SELECT l AS label, ngram, round(sum(n), 6) AS n FROM (
                SELECT * FROM model WHERE l <> '13' UNION ALL
                SELECT l, ngram, count(*) * 0.5e0 FROM new_grams WHERE l IN (SELECT l FROM sizes WHERE l <> '13') GROUP BY l, ngram) u GROUP BY 1, 2""",
         {**NB, "new_marked": f"SELECT '<' || w || '>' AS w, l FROM (SELECT unnest(regexp_split_to_array(description_ean, '\\s+')) AS w, {level_sql('variete', 1)} AS l FROM products) u WHERE w <> ''",
          "new_grams": "SELECT l, substr(w, CAST(i AS INTEGER), CAST(n AS INTEGER)) AS ngram FROM (SELECT w, l, n, unnest(range(1, length(w) - n + 2)) AS i "
                       "FROM new_marked CROSS JOIN (SELECT unnest([3, 4, 5, 6]) AS n) ns WHERE n <= length(w)) p"})
