"""Registered queries of the Spark ML models and the incremental job.

What a fitted model predicts has no SQL counterpart; those queries are checked by invariants in the tests. Tables
that don't depend on the model, such as its labels or the rows scored, have their SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ramure.functions import codes
from ramure.operators import models
from ramure.plans.registry import level_sql, register
from ramure.plans.text_queries import GRAMS, WORDS, folder, token_ctes
from ramure.session import spread
from ramure.sources.writers import write_output
from ramure.streaming.incremental import clean_stream, score_incrementally, score_new_keys

SIZE = 1 << 12


def rows(v):
    """Labelled texts: product names and their codes."""
    parts = spread(v.part_codes).select(F.col("p_partkey").alias("id"), F.col("label").alias("text"), "code")
    return codes.with_levels(parts).withColumn("code8", codes.code_prefix("code"))


register("ngram_features",
         lambda v: models.ngram_features(rows(v), num_features=SIZE).select("id", F.aggregate(
             models.vector_to_array("features"), F.lit(0.0), lambda total, n: total + n).alias("n_grams")),
         "SELECT k AS id, CAST(count(*) AS DOUBLE) AS n_grams FROM grams GROUP BY k", GRAMS)


TOKENS = 39_000


def flat(v):
    return models.fit_flat(rows(v), num_tokens=TOKENS)


def flat_sql(source: str, key: str, text: str, top: int) -> dict[str, str]:
    """The flat classifier in SQL: fitted on the product names, scoring the texts of `source`."""
    def bag(name: str, table: str, k: str, t: str) -> dict[str, str]:
        return {f"{name}_words": f"SELECT k, '<' || w || '>' AS w FROM (SELECT {k} AS k, unnest(regexp_split_to_array({t}, '\\s+')) AS w FROM {table}) u WHERE w <> ''",
                f"{name}_grams": f"SELECT k, substr(w, CAST(i AS INTEGER), CAST(n AS INTEGER)) AS ngram FROM (SELECT k, w, n, unnest(range(1, length(w) - n + 2)) AS i "
                                 f"FROM {name}_words CROSS JOIN (SELECT unnest([3, 4, 5, 6]) AS n) ns WHERE n <= length(w)) p"}

    return {
        **bag("fit", "part_codes", "p_partkey", "label"), **(bag("new", source, key, text) if source != "part_codes" else {}),
        "fit_rows": """SELECT k, c FROM (SELECT k, c, n, row_number() OVER (PARTITION BY c ORDER BY md5('42|' || CAST(k AS VARCHAR))) AS r
                       FROM (SELECT p_partkey AS k, left(code, 8) AS c, count(*) OVER (PARTITION BY left(code, 8)) AS n FROM part_codes) s
                       WHERE n >= 2) t WHERE r > round(0.2e0 * n)""",
        "all_counts": "SELECT c, ngram, count(*) AS n FROM fit_grams JOIN fit_rows USING (k) GROUP BY c, ngram",
        "vocab_grams": f"SELECT ngram FROM all_counts GROUP BY ngram ORDER BY sum(n) DESC, ngram LIMIT {TOKENS}",
        "gram_counts": "SELECT * FROM all_counts WHERE ngram IN (SELECT ngram FROM vocab_grams)",
        "class_norms": """SELECT c, ln(rows_c + 1) - ln((SELECT count(*) FROM fit_rows) + count(*) OVER ()) AS prior,
                                 ln(coalesce(t, 0) + (SELECT count(*) FROM vocab_grams)) AS den
                          FROM (SELECT c, count(*) AS rows_c FROM fit_rows GROUP BY c) a LEFT JOIN (SELECT c, sum(n) AS t FROM gram_counts GROUP BY c) b USING (c)""",
        "bags": f"SELECT k, ngram, count(*) AS tf FROM {'fit' if source == 'part_codes' else 'new'}_grams WHERE ngram IN (SELECT ngram FROM vocab_grams) GROUP BY k, ngram",
        "in_all": f"SELECT {key} AS k, coalesce(tf, 0) AS tf FROM {source} LEFT JOIN (SELECT k, sum(tf) AS tf FROM bags GROUP BY k) b ON k = {key}",
        "shared": "SELECT k, c, sum(tf * ln(n + 1)) AS w FROM bags JOIN gram_counts USING (ngram) GROUP BY k, c",
        "likely": "SELECT i.k, n.c, prior - i.tf * den + coalesce(w, 0) AS score FROM in_all i CROSS JOIN class_norms n LEFT JOIN shared s ON s.k = i.k AND s.c = n.c",
        "softened": """SELECT k, c, exp(score - top) / sum(exp(score - top)) OVER (PARTITION BY k) AS p
                       FROM (SELECT *, max(score) OVER (PARTITION BY k) AS top FROM likely) m""",
        "best_codes": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(-p, 9), c) AS r FROM softened) q WHERE r <= {top}",
        "best_wide": "SELECT k, " + ", ".join(
            f"max(CASE WHEN r = {r} THEN c END) AS predicted_code{'' if r == 1 else f'_top{r}'}, "
            f"max(CASE WHEN r = {r} THEN p END) AS confidence{'' if r == 1 else f'_top{r}'}" for r in range(1, top + 1)) + " FROM best_codes GROUP BY k",
    }


def wide_sql(top: int) -> str:
    return ", ".join(f"predicted_code{s}, round(confidence{s}, 6) AS confidence{s}" for s in ("", *(f"_top{r}" for r in range(2, top + 1))))


register("flat_predictions", lambda v: flat(v).predict(rows(v), top_k=3).drop("predictions"),
         "SELECT p_partkey AS id, label AS text, code, " + ", ".join(f"{level_sql('code', n)} AS level{n}" for n in range(1, 6))
         + f", left(code, 8) AS code8, {wide_sql(3)} FROM part_codes JOIN best_wide ON k = p_partkey", flat_sql("part_codes", "p_partkey", "label", 3))
register("flat_training_sizes", lambda v: v.spark.createDataFrame([tuple(flat(v).stats.values())],
                                                                  "num_classes int, train long, val long, total long, dropped int"),
         """SELECT CAST(count(*) FILTER (WHERE n >= 2) AS INTEGER) AS num_classes,
                   CAST(sum(n - round(0.2e0 * n)) FILTER (WHERE n >= 2) AS BIGINT) AS train, CAST(sum(round(0.2e0 * n)) FILTER (WHERE n >= 2) AS BIGINT) AS val,
                   CAST(sum(n) FILTER (WHERE n >= 2) AS BIGINT) AS total, CAST(coalesce(sum(n) FILTER (WHERE n < 2), 0) AS INTEGER) AS dropped
            FROM (SELECT left(code, 8) AS c, count(*) AS n FROM part_codes GROUP BY 1) g""")
register("predict_table", lambda v: models.predict_table(
    flat(v), v.products.select("l_orderkey", "l_linenumber", F.col("description_ean").alias("product")), words=WORDS),
         f"""SELECT l_orderkey, l_linenumber, clean AS product, description_ean AS product_orig, {wide_sql(1)}
             FROM products JOIN cleaned ON cleaned.k = description_ean JOIN best_wide ON best_wide.k = clean""",
         {"texts": "SELECT DISTINCT description_ean AS product FROM products", **token_ctes("texts", "product", "product", WORDS),
          "clean_texts": "SELECT DISTINCT clean AS t FROM cleaned", **flat_sql("clean_texts", "t", "t", 1)})


def summary_sql(levels) -> str:
    return " UNION ALL ".join(
        f"SELECT {n} AS level, count(*) AS n_classes, string_agg(l, ', ' ORDER BY l) FILTER (WHERE rn <= 5) AS samples FROM "
        f"(SELECT l, row_number() OVER (ORDER BY l) AS rn FROM (SELECT {level_sql('code', n)} AS l FROM part_codes GROUP BY 1 "
        f"HAVING count(*) >= 2 AND l IS NOT NULL) g) r" for n in levels)


def resumed(v):
    """All five levels stored by one fit and reused by the next."""
    path = folder(v, "resumed")
    models.fit_hierarchical(rows(v), num_features=SIZE, save_to=path)
    return models.fit_hierarchical(rows(v), num_features=SIZE, resume_from=path)


register("resumed_model_summary", lambda v: models.model_summary(resumed(v).summary(v.spark)), summary_sql(range(1, 6)))
def incremental(v):
    """Clean the documents in two runs of the same job: the second one only finds the files of the second half."""
    source, sink, checkpoint = folder(v, "arriving"), folder(v, "cleaned"), folder(v, "progress")
    for half in (0, 1):
        part = v.documents.select("doc_id", "text").where(F.col("doc_id") % 2 == half)
        write_output(part, f"{source}/part{half}.parquet")
        stream = clean_stream(v.spark, f"{source}/*.parquet", part.schema, "text", WORDS)
        score_incrementally(stream, lambda df: df.select("doc_id", "text"), sink, checkpoint).awaitTermination()
    return v.spark.read.parquet(sink)


register("incremental_cleaning", incremental, "SELECT k AS doc_id, clean AS text FROM cleaned",
         token_ctes("documents", "doc_id", "text", WORDS))


def scored_arrivals(v):
    """A fitted model scores product names as they arrive: half of them first, then all, of which half are there already."""
    source, sink, checkpoint = folder(v, "names"), folder(v, "scored"), folder(v, "scoring")
    model = flat(v)
    names = v.part_codes.select("p_partkey", F.col("label").alias("product"))
    for run, part in enumerate((names.where(F.col("p_partkey") % 2 == 0), names)):
        write_output(part, f"{source}/run{run}.parquet")
        stream = v.spark.readStream.schema(part.schema).parquet(f"{source}/*.parquet")
        score_new_keys(stream, lambda df: models.predict_table(model, df, words=WORDS), sink, checkpoint, "p_partkey").awaitTermination()
    return v.spark.read.parquet(sink).drop("batch")


register("scored_arrivals", scored_arrivals,
         f"""SELECT p_partkey, clean AS product, label AS product_orig, {wide_sql(1)} FROM part_codes
             JOIN cleaned ON cleaned.k = label JOIN best_wide ON best_wide.k = clean""",
         {"labels_once": "SELECT DISTINCT label AS product FROM part_codes", **token_ctes("labels_once", "product", "product", WORDS),
          "clean_texts": "SELECT DISTINCT clean AS t FROM cleaned", **flat_sql("clean_texts", "t", "t", 1)})
