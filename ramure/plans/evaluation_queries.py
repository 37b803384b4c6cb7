"""Registered queries of the evaluation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ramure.functions.text import parse_amount
from ramure.operators import evaluate as ev
from ramure.plans.registry import level_sql, register

FLAGS = ev.SOURCE_FLAGS

register(
    "true_levels", lambda v: ev.ensure_true_labels(v.preds).select("id", *[f"level{n}" for n in range(1, 6)]),
    "SELECT id, " + ", ".join(f"{level_sql('code', n)} AS level{n}" for n in range(1, 6)) + " FROM preds")

register(
    "predicted_levels",
    lambda v: ev.ensure_predicted_levels(v.preds).select(
        "id", *[f"predicted_level{n}{top}" for n in range(1, 6) for top in ("", "_top2", "_top3")]),
    "SELECT id, " + ", ".join(f"predicted_level{n}{top}" for n in range(1, 6) for top in ("", "_top2", "_top3"))
    + " FROM predicted")

LONG = " UNION ALL ".join(
    f"SELECT id, {n} AS level, {rank} AS rank, level{n} AS truth, {name} AS code, "
    f"{f'confidence_level{n}' if rank == 1 else 'CAST(NULL AS DOUBLE)'} AS confidence FROM evaluated"
    for n in range(1, 6)
    for rank, name in enumerate([f"predicted_level{n}", f"predicted_level{n}_top2", f"predicted_level{n}_top3"], start=1))

register("predictions_long", lambda v: ev.to_long(v.evaluated), f"SELECT * FROM ({LONG}) u")

# hit rank per level, from the long form
HITS = """SELECT id, level, max(truth) AS truth, max(CASE WHEN rank = 1 THEN code END) AS top1,
                 CAST(coalesce(min(CASE WHEN code = truth THEN rank END), 0) AS INTEGER) AS hit
          FROM long_rows GROUP BY id, level"""


def topk_sql(source: str, keys: str, ks: int, where: str, max_k: int = 3, limit_k: bool = True) -> str:
    accuracy = "avg(CASE WHEN hit BETWEEN 1 AND k THEN 1e0 ELSE 0e0 END)"
    if limit_k:
        accuracy = f"CASE WHEN k <= {max_k} THEN {accuracy} END"
    return (f"SELECT {keys}level, k, round({accuracy}, 6) AS accuracy, count(*) AS n FROM {source} "
            f"CROSS JOIN (SELECT CAST(unnest(range(1, {ks + 1})) AS INTEGER) AS k) ks {where} GROUP BY {keys}level, k")


register("topk_overall", lambda v: ev.topk_overall(v.evaluated),
         topk_sql("hits", "", 5, "WHERE truth IS NOT NULL AND top1 IS NOT NULL"), {"long_rows": LONG, "hits": HITS})

register("topk_all_rows", lambda v: ev.topk_all_rows(v.evaluated, (1, 2, 3, 4, 5)),
         topk_sql("hits", "", 5, "", limit_k=False), {"long_rows": LONG, "hits": HITS})

register("topk_by_group", lambda v: ev.topk_by_group(v.evaluated, "level1"),
         topk_sql("(SELECT h.*, level1 AS group_value FROM hits h JOIN evaluated USING (id)) g", "group_value, ", 5,
                  "WHERE truth IS NOT NULL AND top1 IS NOT NULL AND level > 1"), {"long_rows": LONG, "hits": HITS})

register(
    "topk_by_flags", lambda v: ev.topk_by_flags(v.evaluated, ["manual_from_app", "suggester"]),
    "SELECT t.*, n_subset FROM ("
    + topk_sql("flagged", "flag, value, ", 5, "WHERE truth IS NOT NULL AND top1 IS NOT NULL")
    + ") t JOIN (SELECT flag, value, count(DISTINCT id) AS n_subset FROM flagged GROUP BY flag, value) s "
      "ON t.flag = s.flag AND t.value IS NOT DISTINCT FROM s.value",
    {"long_rows": LONG, "hits": HITS, "flagged": """
        SELECT 'all' AS flag, CAST(NULL AS BOOLEAN) AS value, hits.* FROM hits
        UNION ALL SELECT 'manual_from_app', manual_from_app, hits.* FROM hits JOIN preds USING (id)
        UNION ALL SELECT 'suggester', suggester, hits.* FROM hits JOIN preds USING (id)"""})

register("filter_true_flags", lambda v: ev.filter_true(v.preds, ["manual_from_app", "suggester"]).select("id", "code"),
         "SELECT id, code FROM preds WHERE manual_from_app AND suggester")

for logic, condition in {
    "any": "manual_from_app OR suggester", "all": "manual_from_app AND suggester",
    "only": "manual_from_app AND suggester AND NOT manual_from_books AND NOT receips_from_app",
    "none": "NOT (manual_from_app OR suggester)",
}.items():
    register(f"filter_sources_{logic}",
             lambda v, logic=logic: ev.filter_sources(v.preds, ["manual_from_app", "suggester"], logic).select("id", "code"),
             f"SELECT id, code FROM preds WHERE {condition}")


def long_levels(keys: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}{n} AS level, level{n} AS truth, predicted_level{n} AS pred, confidence_level{n} AS conf FROM {source}"
        for n in range(1, 5))


CELLS = "SELECT {keys}truth, pred, count(*) AS n FROM {source} WHERE truth IS NOT NULL AND pred IS NOT NULL GROUP BY {keys}truth, pred"


def class_ctes(keys: str, confusion: str) -> dict[str, str]:
    """Class scores from confusion counts by separate sums per truth and predicted class."""
    names = [key.strip() for key in keys.split(",") if key.strip()]
    on = " AND ".join(f"s.{key} = p.{key}" for key in [*names, "cls"])
    out = ", ".join(f"coalesce(s.{key}, p.{key}) AS {key}" for key in [*names, "cls"])
    return {
        "supports": f"SELECT {keys}truth AS cls, sum(n) AS support, sum(CASE WHEN truth = pred THEN n ELSE 0 END) AS tp FROM {confusion} GROUP BY {keys}truth",
        "predicteds": f"SELECT {keys}pred AS cls, sum(n) AS predicted FROM {confusion} WHERE pred IS NOT NULL GROUP BY {keys}pred",
        "classes": f"""SELECT *, CASE WHEN predicted > 0 THEN tp / CAST(predicted AS DOUBLE) ELSE 0 END AS prec,
                              CASE WHEN support > 0 THEN tp / CAST(support AS DOUBLE) ELSE 0 END AS rec,
                              2 * tp / CAST(support + predicted AS DOUBLE) AS f1
                       FROM (SELECT {out}, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp,
                                    coalesce(predicted, 0) AS predicted
                             FROM supports s FULL OUTER JOIN predicteds p ON {on}) joined""",
    }


def confidence_sql(keys: str, thresholds: str) -> str:
    names = [key.strip() for key in keys.split(",") if key.strip()]
    equal = " AND ".join(f"g.{key} = m.{key}" for key in names)
    return f"""
        SELECT {', '.join('g.' + key for key in names)}, g.threshold, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1,
               round(prec, 6) AS precision, round(rec, 6) AS recall,
               round(coalesce(n_samples / CAST(total AS DOUBLE), 0), 6) AS coverage, CAST(coalesce(n_samples, 0) AS BIGINT) AS n_samples
        FROM (SELECT {keys}total, CAST(threshold AS DOUBLE) AS threshold
              FROM (SELECT {keys}count(*) AS total FROM level_rows GROUP BY {', '.join(names)}) t
              CROSS JOIN (SELECT unnest({thresholds}) AS threshold) th) g
        LEFT JOIN (SELECT {keys}threshold, sum(tp) / sum(support) AS accuracy, sum(f1 * support) / sum(support) AS f1,
                          sum(prec * support) / sum(support) AS prec, sum(rec * support) / sum(support) AS rec,
                          sum(support) AS n_samples
                   FROM classes GROUP BY {keys}threshold) m ON {equal} AND g.threshold = m.threshold"""


def confidence_ctes(keys: str, source: str, thresholds: str) -> dict[str, str]:
    return {
        "level_rows": long_levels(keys.replace("level, ", ""), source),
        "at_threshold": f"SELECT * FROM level_rows JOIN (SELECT unnest({thresholds}) AS threshold) t ON conf >= threshold",
        "cells": CELLS.format(keys=f"{keys}threshold, ", source="at_threshold"),
        **class_ctes(f"{keys}threshold, ", "cells"),
    }


TEN = "[0e0, 0.1e0, 0.2e0, 0.3e0, 0.4e0, 0.5e0, 0.6e0, 0.7e0, 0.8e0, 0.9e0]"
register(
    "metrics_by_confidence", lambda v: ev.metrics_by_confidence(v.evaluated),
    f"SELECT *, 'all' AS source_filter FROM ({confidence_sql('level, ', TEN)}) r", confidence_ctes("level, ", "evaluated", TEN))

# unweighted mean over the classes, and shares of all rows
for average in ("macro", "micro"):
    mean = "avg({0})" if average == "macro" else "sum(tp) / sum(support)"
    text = confidence_sql("level, ", TEN)
    for name in ("f1", "prec", "rec"):
        text = text.replace(f"sum({name} * support) / sum(support)", mean.format(name))
    register(f"metrics_by_confidence_{average}", lambda v, a=average: ev.metrics_by_confidence(v.evaluated, average=a),
             f"SELECT *, 'all' AS source_filter FROM ({text}) r", confidence_ctes("level, ", "evaluated", TEN))
FIVE = "[0e0, 0.3e0, 0.5e0, 0.7e0, 0.9e0]"
register(
    "metrics_all_sources", lambda v: ev.metrics_all_sources(v.evaluated),
    confidence_sql("source_filter, level, ", FIVE),
    {"labelled": "SELECT 'all' AS source_filter, * FROM evaluated "
                 + " ".join(f"UNION ALL SELECT 'any({f})', * FROM evaluated WHERE {f}" for f in FLAGS)
                 + f" UNION ALL SELECT 'none({', '.join(FLAGS)})', * FROM evaluated WHERE NOT ({' OR '.join(FLAGS)})",
     **confidence_ctes("source_filter, level, ", "labelled", FIVE)})

REPORT = """
    SELECT 'class' AS kind, cls AS label, round(prec, 6) AS precision, round(rec, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM classes
    UNION ALL SELECT 'accuracy', 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM classes
    UNION ALL SELECT 'macro avg', 'macro avg', round(avg(prec), 6), round(avg(rec), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM classes
    UNION ALL SELECT 'weighted avg', 'weighted avg', round(sum(prec * support) / sum(support), 6), round(sum(rec * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM classes"""

for level, floor in ((1, 0.0), (3, 0.5)):
    register(
        f"classification_report_l{level}",
        lambda v, level=level, floor=floor: ev.classification_report(v.evaluated, level, floor, ["manual_from_app", "suggester"]),
        REPORT, {"chosen": f"SELECT level{level} AS truth, predicted_level{level} AS pred FROM evaluated "
                           f"WHERE confidence_level{level} >= {floor}e0 AND (manual_from_app OR suggester)",
                 "cells": CELLS.format(keys="", source="chosen"), **class_ctes("", "cells")})

ALL_CELLS = "SELECT truth, pred, count(*) AS n FROM (SELECT code AS truth, predicted_code AS pred FROM preds) c GROUP BY truth, pred"
register(
    "exact_match", lambda v: ev.exact_match(v.preds),
    "SELECT CAST(sum(support) AS BIGINT) AS n, round(sum(tp) / sum(support), 6) AS accuracy, "
    "round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM classes",
    {"cells": ALL_CELLS, **class_ctes("", "cells")})

CODE_HIT = """CAST(coalesce(list_position(list_concat([predicted_code],
    [x for x in [predicted_code_top2, predicted_code_top3] if trim(x) <> '']), code), 0) AS INTEGER)"""
register(
    "code_topk", lambda v: ev.code_topk(v.preds, 3),
    "SELECT k, round(avg(CASE WHEN hit BETWEEN 1 AND k THEN 1e0 ELSE 0e0 END), 6) AS accuracy, count(*) AS n "
    f"FROM (SELECT {CODE_HIT} AS hit FROM preds) h CROSS JOIN (SELECT CAST(unnest(range(1, 4)) AS INTEGER) AS k) ks GROUP BY k")


def _annotated(v):
    return v.annotated.withColumns({
        "amount": parse_amount("montant"),
        "is_hypermarche": F.when(F.col("source_file") == "tickets_application", F.col("magasin") == "Hypermarchés"),
    })


FACETS = {
    "typed": "SELECT *, TRY_CAST(replace(trim(montant), ',', '.') AS DOUBLE) AS amount, "
             f"CASE WHEN source_file = 'tickets_application' THEN magasin = 'Hypermarchés' END AS is_hyper, {CODE_HIT} AS hit FROM annotated",
    "facets": "SELECT 'overall' AS facet, 'overall' AS key, code AS truth, predicted_code AS pred, hit FROM typed "
              + " ".join(
                  f"UNION ALL SELECT 'level', 'level{n}', {level_sql('code', n)}, {level_sql('predicted_code', n)}, NULL FROM typed "
                  f"WHERE {level_sql('code', n)} IS NOT NULL AND {level_sql('predicted_code', n)} IS NOT NULL" for n in range(1, 6))
              + """ UNION ALL SELECT 'source', source_file, code, predicted_code, hit FROM typed
                    UNION ALL SELECT 'amount', CASE WHEN amount <= 50 THEN '<= 50€' ELSE '> 50€' END, code, predicted_code, hit FROM typed WHERE amount IS NOT NULL
                    UNION ALL SELECT 'store', CASE WHEN is_hyper THEN 'Hypermarchés' ELSE 'Autres' END, code, predicted_code, hit FROM typed WHERE is_hyper IS NOT NULL""",
    "cells": "SELECT facet, key, truth, pred, count(*) AS n FROM facets GROUP BY facet, key, truth, pred",
    **class_ctes("facet, key, ", "cells"),
}
REPORT_ROWS = """
    SELECT m.*, {tops}
    FROM (SELECT facet, key, CAST(sum(support) AS BIGINT) AS n, round(sum(tp) / sum(support), 6) AS accuracy,
                 round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM classes GROUP BY facet, key) m
    JOIN (SELECT facet, key, {hits} FROM facets GROUP BY facet, key) h ON m.facet = h.facet AND m.key = h.key""".format(
    tops=", ".join(f"round(h{k}, 6) AS top_{k}" for k in (1, 2, 3)),
    hits=", ".join(
        f"CASE WHEN facet <> 'level' THEN avg(CASE WHEN hit BETWEEN 1 AND {k} THEN 1e0 ELSE 0e0 END) END AS h{k}" for k in (1, 2, 3)))

register("evaluation_report", lambda v: ev.evaluation_report(_annotated(v), 3, 50.0), REPORT_ROWS, FACETS)
register(
    "evaluation_metrics_flat", lambda v: ev.flatten_metrics(ev.evaluation_report(_annotated(v), 3, 50.0)),
    """SELECT 'eval.' || CASE WHEN facet = 'overall' THEN 'overall' WHEN facet = 'level' THEN key
              ELSE facet || '.' || regexp_replace(key, '[^a-zA-Z0-9_\\-.]', '_', 'g') END || '.' || metric AS key, value
       FROM (""" + " UNION ALL ".join(
        f"SELECT facet, key, '{metric}' AS metric, {metric} AS value FROM report "
        + ("WHERE facet <> 'level'" if metric.startswith("top") else "")
        for metric in ("accuracy", "f1_weighted", "top_1", "top_2", "top_3")) + ") u",
    {**FACETS, "report": REPORT_ROWS})
