"""Registered queries of the classifiers that are tables of counts, with the same fits, cascades and beams written in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ramure.functions import codes
from ramure.operators import level_tables, models
from ramure.plans.learning_queries import rows
from ramure.plans.registry import level_sql, register, z
from ramure.plans.text_queries import WORDS, folder, token_ctes

TOKENS = 39_000
HEADS = (1, 2, 3, 4)


_FITTED: dict[tuple[str, str, bool], level_tables.LevelTables] = {}


def _once(v, heads: bool, **settings):
    """A model fitted on a folder's product names, once in a session; its tables lie in the work folder."""
    name = (v.spark.sparkContext.applicationId, v.sf_dir, heads)
    if name not in _FITTED:
        _FITTED[name] = level_tables.fit_levels(rows(v), heads=heads, num_tokens=TOKENS, **settings)[0]
    return _FITTED[name]


def fitted(v):
    return _once(v, False)


def heads(v):
    return _once(v, True, max_level=4)


def bag_ctes(name: str, source: str, key: str, text: str) -> dict[str, str]:
    """Known n-grams of the texts of a table, with their counts."""
    return {
        f"{name}_words": f"SELECT k, '<' || w || '>' AS w FROM (SELECT {key} AS k, unnest(regexp_split_to_array({text}, '\\s+')) AS w FROM {source}) u WHERE w <> ''",
        f"{name}_grams": f"SELECT k, substr(w, CAST(i AS INTEGER), CAST(n AS INTEGER)) AS ngram FROM (SELECT k, w, n, unnest(range(1, length(w) - n + 2)) AS i "
                         f"FROM {name}_words CROSS JOIN (SELECT unnest([3, 4, 5, 6]) AS n) ns WHERE n <= length(w)) p",
        f"{name}_bag": f"SELECT k, 't' || ngram AS f, count(*) AS tf FROM {name}_grams WHERE ngram IN (SELECT ngram FROM vocab_grams) GROUP BY k, ngram",
        f"{name}_in_all": f"SELECT k, sum(tf) AS tf FROM {name}_bag GROUP BY k",
    }


def norm_ctes(model: str, n: int, fed: bool) -> dict[str, str]:
    """Priors and denominators of a level from its counts."""
    extra = f" + (SELECT count(*) FROM par{n}) + 10" if fed else ""
    return {f"{model}norms{n}": f"""
        SELECT c, ln(a.n + 1) - ln(sum(a.n) OVER () + count(*) OVER ()) AS prior, ln(coalesce(t, 0) + (SELECT count(*) FROM vocab_grams){extra}) AS den
        FROM {model}sizes{n} a LEFT JOIN (SELECT c, sum(n) AS t FROM {model}counts{n} GROUP BY c) b USING (c)"""}


def score_ctes(model: str, name: str, bag: str, n: int, fed: bool, parents: str) -> dict[str, str]:
    """Probabilities of all classes for the rows (k, b, code, conf) of `parents`, whose code feeds the level: `{name}_p{n}`."""
    joins = (f" LEFT JOIN {model}counts{n} pp ON pp.c = m.c AND pp.f = 'p' || i.par LEFT JOIN {model}counts{n} bb ON bb.c = m.c AND bb.f = 'b' || i.bucket" if fed else "")
    more = " + coalesce(ln(pp.n + 1), 0) + coalesce(ln(bb.n + 1), 0)" if fed else ""
    par = f"coalesce(q.par, (SELECT min(par) FROM par{n}))" if fed else "''"
    known = f" LEFT JOIN par{n} q ON q.par = s.code" if fed else ""
    return {
        f"{name}_w{n}": f"SELECT k, c, sum(tf * ln(n + 1)) AS w FROM {bag}_bag JOIN {model}counts{n} USING (f) GROUP BY k, c",
        f"{name}_i{n}": f"SELECT s.k, s.b, coalesce(tf, 0) + {2 if fed else 0} AS tf, {par} AS par, "
                        f"CAST(least(greatest(floor(s.conf * 10), 0), 9) AS INTEGER) AS bucket FROM {parents} s LEFT JOIN {bag}_in_all a ON a.k = s.k{known}",
        f"{name}_s{n}": f"SELECT i.k, i.b, m.c, prior - i.tf * den + coalesce(w.w, 0){more} AS score FROM {name}_i{n} i CROSS JOIN {model}norms{n} m "
                        f"LEFT JOIN {name}_w{n} w ON w.k = i.k AND w.c = m.c{joins}",
        f"{name}_p{n}": f"SELECT k, b, c, exp(score - top) / sum(exp(score - top)) OVER (PARTITION BY k, b) AS p "
                        f"FROM (SELECT *, max(score) OVER (PARTITION BY k, b) AS top FROM {name}_s{n}) t",
    }


def cascade_ctes(model: str, name: str, bag: str, keys: str, levels, top: int = 1, masked: bool = False) -> dict[str, str]:
    """Ranked classes of each level, the first feeding the next level or masking it: `{name}_r{n}` (k, c, p, r)."""
    found: dict[str, str] = {}
    for n in levels:
        start = n == levels[0]
        found[f"{name}_f{n}"] = (f"SELECT k, 1 AS b, CAST(NULL AS VARCHAR) AS code, 0.5e0 AS conf FROM ({keys}) ks" if start
                                 else f"SELECT k, 1 AS b, c AS code, p AS conf FROM {name}_r{n - 1} WHERE r = 1")
        found |= score_ctes(model, name, bag, n, not masked and not start, f"{name}_f{n}")
        source, order = f"{name}_p{n}", "round(-p, 9), c"
        if masked:
            order = "round(p, 9) DESC, c DESC"
            if not start:
                parent = z("split_part(c, '.', 1)") if n == 2 else f"array_to_string(list_slice(string_split(c, '.'), 1, {n - 1}), '.')"
                found[f"{name}_m{n}"] = f"""
                    SELECT k, c, CASE WHEN own = 0 THEN p WHEN NOT ok THEN 0e0 WHEN total > 0 THEN p / total ELSE 1e0 / own END AS p
                    FROM (SELECT *, count(*) FILTER (ok) OVER (PARTITION BY k) AS own, sum(p) FILTER (ok) OVER (PARTITION BY k) AS total
                          FROM (SELECT s.k, s.c, s.p, {parent} = f.code AS ok FROM {name}_p{n} s JOIN {name}_f{n} f ON f.k = s.k) o) t"""
                source = f"{name}_m{n}"
        found[f"{name}_r{n}"] = f"SELECT * FROM (SELECT k, c, p, row_number() OVER (PARTITION BY k ORDER BY {order}) AS r FROM {source}) q WHERE r <= {top}"
    return found


def fit_ctes(levels, masked: bool = False) -> dict[str, str]:
    """The fit on product names: split, vocabulary, and per level the counts, fed by the level above as predicted for three rows in ten."""
    found = {
        "fit_rows": "SELECT p_partkey AS k, label AS t, " + ", ".join(f"{level_sql('code', n)} AS l{n}" for n in levels) + " FROM part_codes",
        "fit_split": """SELECT *, row_number() OVER (PARTITION BY l1 ORDER BY md5('42|' || CAST(k AS VARCHAR))) <= round(0.2e0 * count(*) OVER (PARTITION BY l1)) AS held
                        FROM fit_rows""",
    }
    bag = bag_ctes("fit", "fit_rows", "k", "t")
    found |= {name: bag[name] for name in ("fit_words", "fit_grams")}
    found["vocab_grams"] = ("SELECT ngram FROM fit_grams JOIN (SELECT k FROM fit_split WHERE NOT held) h USING (k) GROUP BY ngram "
                            f"ORDER BY count(*) DESC, ngram LIMIT {TOKENS}")
    found |= {name: bag[name] for name in ("fit_bag", "fit_in_all")}
    for n in levels:
        start = n == levels[0]
        fed = not start and not masked
        found[f"train{n}"] = (f"SELECT k, l{n} AS c{f', l{n - 1} AS par' if not start else ''} FROM fit_split WHERE NOT held AND l{n} IN "
                              f"(SELECT l{n} FROM fit_rows WHERE l{n} IS NOT NULL GROUP BY l{n} HAVING count(*) >= 2)")
        found[f"sizes{n}"] = f"SELECT c, CAST(count(*) AS DOUBLE) AS n FROM train{n} GROUP BY c"
        counted = f"SELECT c, f, CAST(sum(tf) AS DOUBLE) AS n FROM train{n} JOIN fit_bag USING (k) GROUP BY c, f"
        if fed:
            found[f"par{n}"] = f"SELECT DISTINCT par FROM train{n}"
            found |= forced_ctes("fit", n, f"train{n}")
            counted += f" UNION ALL SELECT c, f, CAST(count(*) AS DOUBLE) FROM fit_used{n} GROUP BY c, f"
        found[f"counts{n}"] = counted
        found |= norm_ctes("", n, fed)
        part = cascade_ctes("", "fit", "fit", "SELECT k FROM fit_rows", levels, 1, masked)
        names = [f"fit_{kind}{n}" for kind in "fwispmr" if f"fit_{kind}{n}" in part]
        found |= {name: part[name] for name in names}
    return found


def forced_ctes(name: str, n: int, train: str) -> dict[str, str]:
    """Codes above and buckets of training rows (k, c, par), as features: `{name}_used{n}` (c, f)."""
    drawn = f"CAST(('0x' || left(md5('42|{n}|' || CAST(t.k AS VARCHAR)), 7)) AS BIGINT) % 10000 / 1e4 < 1 - 0.7e0"
    return {f"{name}_drawn{n}": f"""
            SELECT t.c, CASE WHEN {drawn} AND r.c IS NOT NULL THEN r.c ELSE t.par END AS used,
                   CAST(least(greatest(floor(coalesce(r.p, 0.9e0) * 10), 0), 9) AS INTEGER) AS bucket
            FROM {train} t JOIN {name}_r{n - 1} r ON r.k = t.k AND r.r = 1""",
            f"{name}_used{n}": f"""
            SELECT c, 'p' || coalesce(q.par, (SELECT min(par) FROM par{n})) AS f FROM {name}_drawn{n} d LEFT JOIN par{n} q ON q.par = d.used
            UNION ALL SELECT c, 'b' || bucket FROM {name}_drawn{n}"""}


def result_sql(name: str, levels, top: int, threshold: float | None = None) -> tuple[str, dict[str, str]]:
    """Columns of a cascade's result for each k, and the CTEs they need."""
    path = " UNION ALL ".join(f"SELECT k, {n} AS level, c AS code, p AS conf FROM {name}_r{n} WHERE r = 1" for n in levels)
    good = "true" if threshold is None else f"bool_and(conf >= {threshold}) OVER (PARTITION BY k ORDER BY level)"
    ctes = {f"{name}_path": path, f"{name}_final": f"""
        SELECT k, coalesce(max(code) FILTER (top), '') AS predicted_code, coalesce('level' || max(level) FILTER (ok), '') AS final_level,
               coalesce(max(conf) FILTER (top), 0e0) AS confidence, coalesce(product(conf) FILTER (ok), 1e0) AS combined_confidence
        FROM (SELECT *, ok AND level = max(CASE WHEN ok THEN level END) OVER (PARTITION BY k) AS top FROM (SELECT *, {good} AS ok FROM {name}_path) o) p GROUP BY k"""}
    for n in levels:
        ctes[f"{name}_wide{n}"] = f"SELECT k, " + ", ".join(
            f"max(c) FILTER (r = {r}) AS predicted_level{n}{'' if r == 1 else f'_top{r}'}, max(p) FILTER (r = {r}) AS confidence_level{n}{'' if r == 1 else f'_top{r}'}"
            for r in range(1, top + 1)) + f" FROM {name}_r{n} GROUP BY k"
    wide = ", ".join(f"predicted_level{n}{s}, round(confidence_level{n}{s}, 6) AS confidence_level{n}{s}" for n in levels for s in ("", *(f"_top{r}" for r in range(2, top + 1))))
    columns = f"predicted_code, final_level, round(confidence, 6) AS confidence, round(combined_confidence, 6) AS combined_confidence, {wide}"
    joins = f" JOIN {name}_final ON {name}_final.k = {{key}} " + " ".join(f"JOIN {name}_wide{n} ON {name}_wide{n}.k = {{key}}" for n in levels)
    return columns, ctes | {"__joins": joins}


def predicted_sql(levels, top: int, threshold: float | None = None, model: str = "", masked: bool = False, fit: dict[str, str] | None = None) -> tuple[str, dict[str, str]]:
    """SQL of predictions for the product names themselves."""
    columns, ctes = result_sql("own", levels, top, threshold)
    joins = ctes.pop("__joins").format(key="p_partkey")
    own = cascade_ctes(model, "own", "fit", "SELECT k FROM fit_rows", levels, top, masked)
    given = "p_partkey AS id, label AS text, code, " + ", ".join(f"{level_sql('code', n)} AS level{n}" for n in range(1, 6)) + ", left(code, 8) AS code8"
    return f"SELECT {given}, {columns} FROM part_codes{joins}", {**(fit or fit_ctes(levels, masked)), **own, **ctes}


register("hierarchical_predictions", lambda v: level_tables.predict_levels(fitted(v), rows(v), top_k=2, threshold=0.3), *predicted_sql(codes.LEVELS, 2, 0.3))
register("multihead_predictions", lambda v: level_tables.predict_levels(heads(v), rows(v), top_k=2), *predicted_sql(HEADS, 2, masked=True))


def saved(v):
    path = folder(v, "model")
    fitted(v).save(path)
    return level_tables.LevelTables.load(v.spark, path)


register("saved_model_predictions", lambda v: level_tables.predict_levels(saved(v), rows(v)), *predicted_sql(codes.LEVELS, 1))


def summary_sql(levels) -> str:
    return " UNION ALL ".join(
        f"SELECT {n} AS level, count(*) AS n_classes, string_agg(c, ', ' ORDER BY c) FILTER (WHERE rn <= 5) AS samples FROM "
        f"(SELECT c, row_number() OVER (ORDER BY c) AS rn FROM sizes{n}) r" for n in levels)


register("model_summary", lambda v: models.model_summary(fitted(v).summary()), summary_sql(codes.LEVELS), fit_ctes(codes.LEVELS))
register("level_validation", lambda v: level_tables.fit_levels(rows(v), num_tokens=TOKENS)[1],
         " UNION ALL ".join(
             f"SELECT {n} AS level, (SELECT count(*) FROM sizes{n}) AS n_classes, count(*) FILTER (NOT held) AS n_train, count(*) FILTER (held) AS n_validation, "
             f"count(*) FILTER (held AND r.c = l{n}) AS n_right, round(count(*) FILTER (held AND r.c = l{n}) / CAST(nullif(count(*) FILTER (held), 0) AS DOUBLE), 6) AS accuracy "
             f"FROM fit_split s JOIN fit_r{n} r ON r.k = s.k WHERE l{n} IN (SELECT c FROM sizes{n})" for n in codes.LEVELS), fit_ctes(codes.LEVELS))

# ---- beams ---------------------------------------------------------------------------------------------------------


def beam_ctes(size: int, bag: str, keys: str) -> dict[str, str]:
    """The best paths of each text, level by level: `way5` (k, b, lp, path, confs)."""
    found = {"way0": f"SELECT k, 1 AS b, 0e0 AS lp, CAST([] AS VARCHAR[]) AS path, CAST([] AS DOUBLE[]) AS confs FROM ({keys}) ks"}
    for n in codes.LEVELS:
        found[f"beam_f{n}"] = f"SELECT k, b, path[-1] AS code, coalesce(confs[-1], 0.9e0) AS conf FROM way{n - 1}"
        found |= score_ctes("", "beam", bag, n, n > 1, f"beam_f{n}")
        found[f"beam_r{n}"] = (f"SELECT * FROM (SELECT k, b, c, p, row_number() OVER (PARTITION BY k, b ORDER BY round(-p, 9), c) AS r FROM beam_p{n}) q WHERE r <= {size}")
        found[f"way{n}"] = f"""
            SELECT k, b, lp, path, confs FROM (
                SELECT k, row_number() OVER (PARTITION BY k ORDER BY round(-lp, 9), path) AS b, lp, path, confs FROM (
                    SELECT w.k, lp + ln(greatest(p, 1e-9)) AS lp, list_append(path, c) AS path, list_append(confs, p) AS confs
                    FROM way{n - 1} w JOIN beam_r{n} r ON r.k = w.k AND r.b = w.b) g) o WHERE b <= {size}"""
    return found


def beam_columns(top: int) -> str:
    wide = "".join(f", coalesce(w{r}.path[{n}], '') AS predicted_level{n}{s}, round(coalesce(w{r}.confs[{n}], 0e0), 6) AS confidence_level{n}{s}"
                   for n in codes.LEVELS for r, s in ((r, "" if r == 1 else f"_top{r}") for r in range(1, top + 1)))
    return ("w1.path[-1] AS predicted_code, 'level' || len(w1.path) AS final_level, round(w1.confs[-1], 6) AS confidence, "
            f"round(exp(w1.lp), 6) AS combined_confidence{wide}")


register("hierarchical_beam", lambda v: level_tables.predict_beams(fitted(v), rows(v), 3),
         "SELECT p_partkey AS id, label AS text, code, " + ", ".join(f"{level_sql('code', n)} AS level{n}" for n in range(1, 6))
         + f", left(code, 8) AS code8, {beam_columns(0)} FROM part_codes JOIN way5 w1 ON w1.k = p_partkey AND w1.b = 1",
         {**fit_ctes(codes.LEVELS), **beam_ctes(3, "fit", "SELECT k FROM fit_rows")})
register("predict_table_beam", lambda v: level_tables.predict_clean(
    fitted(v), v.products.select("l_orderkey", "l_linenumber", F.col("description_ean").alias("product")), top_k=2, beam=3, words=WORDS),
         f"""SELECT l_orderkey, l_linenumber, clean AS product, description_ean AS product_orig, {beam_columns(2)}
             FROM products JOIN cleaned ON cleaned.k = description_ean JOIN way5 w1 ON w1.k = clean AND w1.b = 1 LEFT JOIN way5 w2 ON w2.k = clean AND w2.b = 2""",
         {"texts": "SELECT DISTINCT description_ean AS product FROM products", **token_ctes("texts", "product", "product", WORDS),
          "clean_texts": "SELECT DISTINCT clean AS t FROM cleaned", **fit_ctes(codes.LEVELS), **bag_ctes("new", "clean_texts", "t", "t"),
          **beam_ctes(3, "new", "SELECT t AS k FROM clean_texts")})

# ---- going on with new rows ----------------------------------------------------------------------------------------

TUNED, WEIGHT = (2, 3), 0.5


def new_rows(v):
    """Labelled orders, as rows that come after a fit."""
    return codes.with_levels(v.preds.select("id", F.col("l_pr_product").alias("text"), "code"))


def tuned_ctes() -> dict[str, str]:
    found = {"new_rows": "SELECT id AS k, l_pr_product AS t, " + ", ".join(f"{level_sql('code', n)} AS l{n}" for n in codes.LEVELS) + " FROM preds",
             **bag_ctes("new", "new_rows", "k", "t")}
    cascade = cascade_ctes("u", "new", "new", "SELECT k FROM new_rows", codes.LEVELS)
    for n in codes.LEVELS:
        if n in TUNED:
            found[f"new_train{n}"] = f"SELECT k, l{n} AS c, l{n - 1} AS par FROM new_rows WHERE l{n} IN (SELECT c FROM sizes{n})"
            found |= forced_ctes("new", n, f"new_train{n}")
            found[f"usizes{n}"] = (f"SELECT c, sum(n) AS n FROM (SELECT * FROM sizes{n} UNION ALL SELECT c, {WEIGHT}e0 * count(*) FROM new_train{n} GROUP BY c) s GROUP BY c")
            found[f"ucounts{n}"] = f"""
                SELECT c, f, sum(n) AS n FROM (
                    SELECT * FROM counts{n} UNION ALL SELECT c, f, {WEIGHT}e0 * sum(tf) FROM new_train{n} JOIN new_bag USING (k) GROUP BY c, f
                    UNION ALL SELECT c, f, {WEIGHT}e0 * count(*) FROM new_used{n} GROUP BY c, f) s GROUP BY c, f"""
        else:
            found |= {f"usizes{n}": f"SELECT * FROM sizes{n}", f"ucounts{n}": f"SELECT * FROM counts{n}"}
        found |= norm_ctes("u", n, n > 1)
        found |= {name: cascade[name] for kind in "fwispr" if (name := f"new_{kind}{n}") in cascade}
    return found


def tuned(v):
    return level_tables.tune_levels(saved(v), new_rows(v), TUNED, WEIGHT)


TUNED_FIT = {**fit_ctes(codes.LEVELS), **tuned_ctes()}
register("tuned_level_predictions", lambda v: level_tables.predict_levels(tuned(v), rows(v), top_k=2), *predicted_sql(codes.LEVELS, 2, model="u", fit=TUNED_FIT))
register("tuned_level_counts", lambda v: tuned(v).counts,
         " UNION ALL ".join(f"SELECT {n} AS level, c AS label, f AS feature, round(n, 6) AS n FROM ucounts{n}" for n in codes.LEVELS), TUNED_FIT)

# ---- a fitted model on annotated rows ------------------------------------------------------------------------------

FLAGS = ("manual_from_app", "suggester")


def annotated(v):
    return codes.with_levels(v.preds.select(F.col("l_pr_product").alias("text"), "code", *FLAGS))


def evaluation_sql() -> tuple[str, dict[str, str]]:
    ctes = {**fit_ctes(codes.LEVELS), "names": "SELECT DISTINCT l_pr_product AS t FROM preds", **bag_ctes("new", "names", "t", "t"),
            **cascade_ctes("", "new", "new", "SELECT t AS k FROM names", codes.LEVELS, 3),
            "facets": "SELECT l_pr_product AS t, code, 'all' AS flag, CAST(NULL AS BOOLEAN) AS value FROM preds "
                      + " ".join(f"UNION ALL SELECT l_pr_product, code, '{flag}', coalesce({flag}, false) FROM preds" for flag in FLAGS)}
    parts = []
    for n in codes.LEVELS:
        joins = " ".join(f"LEFT JOIN new_r{n} r{r} ON r{r}.k = f.t AND r{r}.r = {r}" for r in (1, 2, 3))
        for k in (1, 2, 3):
            hit = " OR ".join(f"r{r}.c = truth" for r in range(1, k + 1))
            parts.append(f"SELECT flag, value, {n} AS level, {k} AS k, round(sum(CASE WHEN {hit} THEN 1e0 ELSE 0e0 END) FILTER (truth IS NOT NULL)"
                         f" / nullif(count(*) FILTER (truth IS NOT NULL), 0), 6) AS accuracy, count(*) FILTER (truth IS NOT NULL) AS n, count(*) AS n_subset "
                         f"FROM (SELECT *, {level_sql('code', n)} AS truth FROM facets) f {joins} GROUP BY flag, value")
    return " UNION ALL ".join(parts), ctes


register("model_evaluation", lambda v: level_tables.evaluate_levels(fitted(v), annotated(v), FLAGS), *evaluation_sql())
