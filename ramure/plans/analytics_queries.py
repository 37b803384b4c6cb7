"""Registered queries of the prediction reports."""

from __future__ import annotations

from ramure.operators import analytics as an
from ramure.plans.registry import level_sql, register

LEVELS = (1, 2, 3, 4)


def share(condition: str) -> str:
    return f"avg(CASE WHEN {condition} THEN 1e0 ELSE 0e0 END)"


def count_if(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


def match(n: int) -> str:
    return f"true_level{n} = predicted_level{n}"


def both(n: int) -> str:
    return f"true_level{n} IS NOT NULL AND predicted_level{n} IS NOT NULL"


CLEAN = "NOT is_technical"
TRUTH4 = "true_level4 IS NOT NULL"

COLUMNS = ("id, true_level1, true_level2, true_level3, true_level4, code_depth, confidence_num, budget_num, annee_int, "
           "text_len, is_technical, err_l1, err_l2, err_l3, err_l4, correct_l4, error_severity, budget_tranche")
for name, attribute in (("enrich_predictions", "base"), ("enrich_predictions_report", "report_base")):
    register(name, lambda v, a=attribute: getattr(v, a).select(*COLUMNS.split(", ")),
             f"SELECT {COLUMNS.replace('confidence_num', 'round(confidence_num, 6) AS confidence_num')} FROM {attribute}")

register("filter_predictions",
         lambda v: an.filter_predictions(v.base, True, "1-URGENT", 1997, 0.25).select("id", "code"),
         f"SELECT id, code FROM base WHERE {CLEAN} AND source = '1-URGENT' AND annee_int = 1997 AND confidence_num >= 0.25")

register("filter_domains", lambda v: an.filter_domains(v.base),
         " UNION ALL ".join(
             f"SELECT DISTINCT '{name}' AS domain, CAST({column} AS VARCHAR) AS value FROM base WHERE {column} IS NOT NULL"
             for name, column in (("source", "source"), ("annee", "annee_int"), ("shop_type_name", "shop_type_name"))))

register("kpi", lambda v: an.kpi(v.base),
         f"SELECT count(*) AS n_total, {count_if('is_technical')} AS n_tech, "
         + ", ".join(f"round({share(f'{CLEAN} AND {match(n)}')} * 100, 6) AS acc_l{n}" for n in (1, 4))
         + f", round(avg(confidence_num) FILTER (WHERE {CLEAN}), 6) AS mean_conf FROM base")

ACC_LEVELS = " UNION ALL ".join(f"""
    SELECT {n} AS level, (SELECT count(*) FROM {{t}} WHERE {both(n)}) AS n,
           (SELECT round({share(match(n))} * 100, 6) FROM {{t}} WHERE {both(n)}) AS accuracy,
           (SELECT round(sum(2e0 * tp * s / (s + p)) / sum(s), 6) FROM (
               SELECT s.c, s, tp, coalesce(p, 0) AS p
               FROM (SELECT true_level{n} AS c, count(*) AS s, {count_if(match(n))} AS tp FROM {{t}} WHERE {both(n)} GROUP BY 1) s
               LEFT JOIN (SELECT predicted_level{n} AS c, count(*) AS p FROM {{t}} WHERE {both(n)} GROUP BY 1) q ON s.c = q.c) f) AS f1_weighted,
           (SELECT count(DISTINCT true_level{n}) FROM {{t}} WHERE {both(n)}) AS n_true,
           (SELECT count(DISTINCT predicted_level{n}) FROM {{t}} WHERE {both(n)}) AS n_pred""" for n in LEVELS)
register("accuracy_by_level", lambda v: an.accuracy_by_level(v.base), ACC_LEVELS.format(t="base"))
register("accuracy_by_level_clean", lambda v: an.accuracy_by_level(an.clean(v.base)), ACC_LEVELS.format(t="tidy"),
         {"tidy": f"SELECT * FROM base WHERE {CLEAN}"})

HIT4 = ("CASE WHEN true_level4 = predicted_level4 THEN 1 WHEN true_level4 = predicted_level4_top2 THEN 2 "
        "WHEN true_level4 = predicted_level4_top3 THEN 3 ELSE 99 END")
TEN = "(SELECT CAST(unnest(range(1, 11)) AS INTEGER) AS k) ks"
register("topk_curve", lambda v: an.topk_curve(v.base),
         f"SELECT k, round({share('hit <= k')}, 6) AS accuracy, count(*) AS n FROM "
         f"(SELECT {HIT4} AS hit FROM base WHERE {both(4)}) h CROSS JOIN {TEN} GROUP BY k")
register("topk_curve_report", lambda v: an.topk_curve(an.clean(v.report_base), require_prediction=False),
         f"SELECT k, round({share('hit <= k')}, 6) AS accuracy, count(*) AS n FROM "
         f"(SELECT {HIT4} AS hit FROM report_base WHERE {CLEAN} AND {TRUTH4}) h CROSS JOIN {TEN} GROUP BY k")
register("topk_by_source", lambda v: an.topk_by_dim(an.clean(v.report_base), "source"),
         f"SELECT source AS dim_val, k, round({share('hit <= k')}, 6) AS accuracy, count(*) AS n FROM "
         f"(SELECT source, {HIT4} AS hit FROM report_base WHERE {CLEAN} AND {TRUTH4} AND source IS NOT NULL) h "
         f"CROSS JOIN {TEN} GROUP BY source, k")

DIMS = ("source", "annee_int", "shop", "shop_type_name", "budget_tranche")
for dim in DIMS:
    value = f"coalesce(CAST({dim} AS VARCHAR), 'N/A')"
    register(f"accuracy_by_{dim}", lambda v, d=dim: an.accuracy_by_dim(v.base, d),
             f"SELECT {value} AS dim_val, count(*) AS n_total, "
             + ", ".join(f"round({share(match(n))} * 100, 6) AS acc_l{n}" for n in LEVELS)
             + " FROM base GROUP BY 1 ORDER BY n_total DESC, dim_val LIMIT 20")
    register(f"volume_by_{dim}", lambda v, d=dim: an.volume_by_dim(v.base, d),
             f"SELECT {value} AS dim_val, count(*) AS n, round(avg(confidence_num), 6) AS mean_conf FROM base "
             "GROUP BY 1 ORDER BY n DESC, dim_val LIMIT 20")
    heat = " UNION ALL ".join(
        f"SELECT dim_val, {n} AS level, round({share(match(n))} * 100, 6) AS accuracy, count(*) AS n FROM tops "
        f"WHERE true_level{n} IS NOT NULL GROUP BY dim_val" for n in LEVELS)
    register(f"heatmap_by_{dim}", lambda v, d=dim: an.heatmap_by_dim(v.base, d), heat,
             {"tops": f"SELECT * FROM (SELECT {value} AS dim_val, * FROM base) b WHERE dim_val IN (SELECT dim_val FROM "
                      f"(SELECT {value} AS dim_val, count(*) AS n FROM base GROUP BY 1 ORDER BY n DESC, dim_val LIMIT 15) t)"})

for dim in ("source", "annee_int"):
    register(f"accuracy_by_{dim}_report",
             lambda v, d=dim: an.accuracy_by_dim(an.clean(v.report_base), d, None, "valid", None),
             f"SELECT CAST({dim} AS VARCHAR) AS dim_val, count(*) AS n_total, "
             + ", ".join(f"round(avg(CASE WHEN {both(n)} THEN CASE WHEN {match(n)} THEN 1e0 ELSE 0e0 END END) * 100, 6) AS acc_l{n}"
                         for n in LEVELS)
             + f" FROM report_base WHERE {CLEAN} AND {dim} IS NOT NULL GROUP BY 1")
for dim in ("shop_type_name", "budget_tranche"):
    register(f"heatmap_by_{dim}_report",
             lambda v, d=dim: an.heatmap_by_dim(an.clean(v.report_base), d, 15, "both", None),
             " UNION ALL ".join(
                 f"SELECT {dim} AS dim_val, {n} AS level, round({share(match(n))} * 100, 6) AS accuracy, count(*) AS n FROM tops "
                 f"WHERE {both(n)} GROUP BY {dim}" for n in LEVELS),
             {"tops": f"SELECT * FROM report_base WHERE {CLEAN} AND {dim} IN (SELECT {dim} FROM (SELECT {dim}, count(*) AS n "
                      f"FROM report_base WHERE {CLEAN} AND {dim} IS NOT NULL GROUP BY 1 ORDER BY n DESC, {dim} LIMIT 15) t)"})

for dim, top in (("shop", 20), ("shop_type_name", 15)):
    register(f"top_{dim}_accuracy", lambda v, d=dim, t=top: an.top_dim_accuracy(an.clean(v.report_base), d, t),
             f"SELECT {dim} AS dim_val, count(*) AS n, round({share('correct_l4')}, 6) AS accuracy, "
             f"(SELECT round({share('correct_l4')}, 6) FROM report_base WHERE {CLEAN} AND {TRUTH4}) AS global_accuracy "
             f"FROM report_base WHERE {CLEAN} AND {TRUTH4} AND {dim} IS NOT NULL GROUP BY 1 ORDER BY n DESC, dim_val LIMIT {top}")

register("shop_accuracy_spread", lambda v: an.dim_accuracy_spread(an.clean(v.report_base), "shop"),
         """SELECT CAST(least(floor((a - lo) / (hi - lo) * 30) + 1, 30) AS INTEGER) AS bin,
                   round(lo + (CAST(least(floor((a - lo) / (hi - lo) * 30) + 1, 30) AS INTEGER) - 1) * (hi - lo) / 30, 6) AS bin_low,
                   round(mean, 6) AS mean_accuracy, count(*) AS n
            FROM sizes CROSS JOIN (SELECT min(a) AS lo, max(a) AS hi, avg(a) AS mean FROM sizes) l GROUP BY 1, 2, 3""",
         {"sizes": f"SELECT shop, {share('correct_l4')} AS a FROM report_base WHERE {CLEAN} AND {TRUTH4} GROUP BY 1 HAVING count(*) >= 20"})

register("confidence_histogram", lambda v: an.confidence_histogram(v.base),
         f"SELECT round(round(confidence_num * 20) / 20, 6) AS conf_bin, count(*) AS n, round({share(match(4))}, 6) AS accuracy "
         f"FROM base WHERE confidence_num IS NOT NULL AND {TRUTH4} GROUP BY 1")

TWENTY = "(SELECT unnest(range(0, 21)) / 20e0 AS threshold) t"
for name, table, where, empty in (("coverage_curve", "base", both(4), "0"), ("coverage_curve_report", "report_base", TRUTH4, "NULL")):
    register(name, lambda v, t=table, e=empty: an.coverage_curve(getattr(v, t), 20, e == "NULL", e == "0"),
             f"SELECT round(threshold, 6) AS threshold, round({share('confidence_num >= threshold')}, 6) AS coverage, "
             f"round(coalesce(avg(CASE WHEN confidence_num >= threshold THEN CASE WHEN correct_l4 THEN 1e0 ELSE 0e0 END END), {empty}), 6) AS accuracy "
             f"FROM {table} CROSS JOIN {TWENTY} WHERE {where} GROUP BY threshold")

# right-closed bins by comparison with their edges
BINS = "(SELECT CAST(unnest(range(1, 21)) AS INTEGER) AS bin) e ON confidence_num > (bin - 1) / 20e0 AND confidence_num <= bin / 20e0"
register("calibration", lambda v: an.calibration(v.report_base),
         f"SELECT bin, round({share('correct_l4')}, 6) AS accuracy, count(*) AS n, round(avg(confidence_num), 6) AS mean_conf "
         f"FROM report_base JOIN {BINS} WHERE {TRUTH4} GROUP BY bin")

TENTHS = "CASE " + " ".join(
    f"WHEN confidence_num {'>=' if i == 0 else '>'} {i / 10}e0 AND confidence_num <= {(i + 1) / 10}e0 THEN '{i / 10:.1f}-{(i + 1) / 10:.1f}'"
    for i in range(10)) + " END"
register("accuracy_by_confidence_band", lambda v: an.accuracy_by_confidence_band(an.clean(v.report_base)),
         " UNION ALL ".join(
             f"SELECT band, count(*) AS n_band, {n} AS level, {count_if(both(n))} AS n, "
             f"round(avg(CASE WHEN {both(n)} THEN CASE WHEN {match(n)} THEN 1e0 ELSE 0e0 END END) * 100, 6) AS accuracy "
             "FROM banded WHERE band IS NOT NULL GROUP BY band" for n in LEVELS),
         {"banded": f"SELECT *, {TENTHS} AS band FROM report_base WHERE {CLEAN}"})

for bins in (50, 40):
    index = f"CAST(least(floor((confidence_num - lo) / (hi - lo) * {bins}) + 1, {bins}) AS INTEGER)"
    register(f"confidence_by_correctness_{bins}", lambda v, b=bins: an.confidence_by_correctness(v.report_base, b),
             f"SELECT k.correct_l4, {index} AS bin, round(lo + ({index} - 1) * ((hi - lo) / {bins}), 6) AS bin_low, count(*) AS n, "
             f"round(count(*) / (max(total) * (max(hi) - max(lo)) / {bins}), 6) AS density "
             "FROM kept k JOIN (SELECT correct_l4, min(confidence_num) AS lo, max(confidence_num) AS hi, count(*) AS total "
             "FROM kept GROUP BY 1) l ON k.correct_l4 = l.correct_l4 GROUP BY 1, 2, 3",
             {"kept": f"SELECT * FROM report_base WHERE {TRUTH4} AND confidence_num IS NOT NULL"})

register("high_confidence_errors", lambda v: an.high_confidence_errors(an.clean(v.report_base)),
         f"SELECT {count_if('confidence_num >= 0.8')} AS n_high, round({share('confidence_num >= 0.8')} * 100, 6) AS share, "
         f"{count_if('confidence_num >= 0.8 AND err_l4')} AS n_errors, "
         f"round(avg(CASE WHEN confidence_num >= 0.8 THEN CASE WHEN err_l4 THEN 1e0 ELSE 0e0 END END) * 100, 6) AS error_rate "
         f"FROM report_base WHERE {CLEAN} AND {TRUTH4}")
register("error_rate_by_high_band", lambda v: an.error_rate_by_high_band(an.clean(v.report_base)),
         f"SELECT bin, round({share('err_l4')}, 6) AS error_rate, count(*) AS n FROM report_base JOIN {BINS} "
         f"WHERE {CLEAN} AND {TRUTH4} AND bin > 10 GROUP BY bin")

FILTER = (f"{both(4)} AND {CLEAN} AND contains(lower(l_pr_product), 'bolt') AND (starts_with(true_level4, '0') OR starts_with(true_level1, '0')) "
          "AND confidence_num >= 0.1 AND confidence_num <= 0.9 AND err_l4")
register("error_filter",
         lambda v: an.error_filter(v.base, text=" Bolt", true_code="0", conf_min=0.1, conf_max=0.9, severity="errors",
                                   exclude_tech=True).select("id", "code", "predicted_code"),
         f"SELECT id, code, predicted_code FROM base WHERE {FILTER}")
register("error_filter_far_miss",
         lambda v: an.error_filter(v.base, pred_code="0", source="2-HIGH", year=1996, severity="far-miss").select("id", "code"),
         f"SELECT id, code FROM base WHERE {both(4)} AND starts_with(predicted_level4, '0') AND source = '2-HIGH' AND annee_int = 1996 "
         "AND confidence_num BETWEEN 0 AND 1 AND error_severity = 'far-miss'")
register("error_stats", lambda v: an.error_stats(v.base),
         f"SELECT count(*) AS n_total, {count_if('err_l4')} AS n_errors, round(avg(confidence_num), 6) AS mean_conf, "
         f"count(DISTINCT true_level4) AS n_codes FROM base WHERE {both(4)}")
register("error_listing", lambda v: an.error_listing(an.error_filter(v.base)),
         "SELECT l_pr_product AS produit, code AS code_vrai, true_level4 AS vrai_l4, predicted_level4 AS pred_l4, "
         "round(confidence_num * 100, 1) AS conf_pct, error_severity AS severite, coalesce(source, '') AS source, "
         f"coalesce(CAST(annee_int AS VARCHAR), '') AS annee FROM base WHERE {both(4)} AND confidence_num BETWEEN 0 AND 1 "
         "ORDER BY confidence_num DESC, id LIMIT 500")
for name, n, floor in (("confusion_pairs", 20, None), ("confusion_pairs_confident", 10, 0.8)):
    register(name, lambda v, n=n, f=floor: an.confusion_pairs(v.base, 4, n, f),
             "SELECT true_level4 AS truth, predicted_level4 AS pred, count(*) AS n FROM base WHERE err_l4 "
             + (f"AND confidence_num >= {floor} " if floor else "") + f"GROUP BY 1, 2 ORDER BY n DESC, truth, pred LIMIT {n}")
register("severity_distribution", lambda v: an.severity_distribution(v.base),
         "SELECT coalesce(error_severity, 'N/A') AS severity, count(*) AS n, round(avg(confidence_num), 6) AS mean_conf "
         f"FROM base WHERE {both(4)} GROUP BY 1")
register("error_cascade", lambda v: an.error_cascade(an.clean(v.report_base)),
         " UNION ALL ".join(
             f"SELECT {n} AS level, round(avg(CASE WHEN NOT err_l1 THEN CASE WHEN err_l{n} THEN 1e0 ELSE 0e0 END END) * 100, 6) AS l1_correct, "
             f"round(avg(CASE WHEN err_l1 THEN CASE WHEN err_l{n} THEN 1e0 ELSE 0e0 END END) * 100, 6) AS l1_wrong, "
             f"{count_if('NOT err_l1')} AS n_ok, {count_if('err_l1')} AS n_ko FROM report_base WHERE {CLEAN} AND {TRUTH4}"
             for n in (2, 3, 4)))
NONE, ONLY4, FROM3, FROM2, FROM1 = an.ERROR_CATEGORIES
register("error_categories", lambda v: an.error_categories(an.clean(v.report_base)),
         "SELECT category, count(id) AS n FROM (SELECT unnest(["
         + ", ".join(f"'{name}'" for name in an.ERROR_CATEGORIES) + "]) AS category) c LEFT JOIN (SELECT id, "
         f"CASE WHEN err_l1 THEN '{FROM1}' WHEN err_l2 THEN '{FROM2}' WHEN err_l3 THEN '{FROM3}' WHEN err_l4 THEN '{ONLY4}' ELSE '{NONE}' END AS category "
         f"FROM report_base WHERE {CLEAN} AND {TRUTH4}) r USING (category) GROUP BY category")
register("confusion_matrix", lambda v: an.confusion_matrix(an.clean(v.report_base)),
         """SELECT truth, pred, n, round(n * 1e2 / nullif(sum(n) OVER (PARTITION BY truth), 0), 6) AS pct
            FROM (SELECT a.l AS truth, b.l AS pred, count(r.id) AS n FROM labels1 a CROSS JOIN labels1 b
                  LEFT JOIN tidy r ON r.true_level1 = a.l AND r.predicted_level1 = b.l GROUP BY 1, 2) c""",
         {"tidy": f"SELECT * FROM report_base WHERE {CLEAN}", "labels1": "SELECT DISTINCT true_level1 AS l FROM tidy"})
RATES = (f"SELECT true_level4 AS code, count(*) AS n, {share('err_l4')} AS error_rate, avg(confidence_num) AS mean_conf "
         f"FROM report_base WHERE {CLEAN} AND {TRUTH4} GROUP BY 1 HAVING count(*) >= 10")
register("best_worst_codes", lambda v: an.best_worst_codes(an.clean(v.report_base)),
         " UNION ALL ".join(
             f"SELECT code, n, round(error_rate, 6) AS error_rate, round(mean_conf, 6) AS mean_conf, '{side}' AS side "
             f"FROM (SELECT * FROM rates ORDER BY error_rate {way}, code LIMIT 15) r" for side, way in (("worst", "DESC"), ("best", "ASC"))),
         {"rates": RATES})

for level, top in ((1, None), (2, 20), (3, 25), (4, 30)):
    register(f"code_distribution_l{level}", lambda v, n=level, t=top: an.code_distribution(v.base, n, t),
             f"SELECT true_level{level} AS code, count(*) AS n FROM base WHERE true_level{level} IS NOT NULL GROUP BY 1"
             + (f" ORDER BY n DESC, code LIMIT {top}" if top else ""))
register("class_counts", lambda v: an.class_counts(v.base),
         " UNION ALL ".join(
             f"SELECT {n} AS level, count(DISTINCT true_level{n}) AS n_classes, "
             f"count(DISTINCT true_level{n}) FILTER (WHERE {CLEAN}) AS n_classes_regular, count(true_level{n}) AS n_obs, "
             f"count(true_level{n}) FILTER (WHERE {CLEAN}) AS n_obs_regular FROM base" for n in LEVELS))
register("depth_distribution", lambda v: an.depth_distribution(v.base),
         f"SELECT code_depth, count(*) AS n, {count_if('is_technical')} AS n_tech, round({share('is_technical')} * 100, 6) AS tech_share "
         "FROM base GROUP BY 1")
register("technical_by_source", lambda v: an.technical_by_source(v.base),
         f"SELECT source, count(*) AS n, {count_if('is_technical')} AS n_tech FROM base WHERE source IS NOT NULL GROUP BY 1")
LENGTHS = "CASE " + " ".join(
    f"WHEN text_len > {a} AND text_len <= {b} THEN '{a}-{b}'"
    for a, b in ((0, 5), (5, 10), (10, 15), (15, 20), (20, 30), (30, 50))) + " WHEN text_len > 50 THEN '50+' END"
register("accuracy_by_text_length", lambda v: an.accuracy_by_text_length(an.clean(v.report_base)),
         f"SELECT {LENGTHS} AS len_bin, count(*) AS n, round({share('err_l4')}, 6) AS error_rate, round(avg(confidence_num), 6) AS mean_conf "
         f"FROM report_base WHERE {CLEAN} AND {TRUTH4} AND text_len > 0 GROUP BY 1")
register("text_length_median", lambda v: an.text_length_median(an.clean(v.report_base)),
         f"SELECT round(median(CAST(text_len AS DOUBLE)), 6) AS median, count(*) AS n FROM report_base WHERE {CLEAN} AND {TRUTH4}")
register("error_vs_training_share", lambda v: an.error_vs_training_share(v.report_base, v.synthetic),
         f"""SELECT true_level1, n_test, round(error_rate, 6) AS error_rate_l1, coalesce(n_train, 0) AS n_train,
                    round(coalesce(n_train, 0) * 1e2 / (SELECT count(*) FROM synthetic), 6) AS pct_train
             FROM (SELECT true_level1, count(*) AS n_test, {share('err_l1')} AS error_rate FROM report_base GROUP BY 1) t
             LEFT JOIN (SELECT {level_sql('code', 1)} AS l, count(*) AS n_train FROM synthetic GROUP BY 1) s ON l = true_level1""")

register("budget_bands", lambda v: v.base.select("id", "budget_tranche"), "SELECT id, budget_tranche FROM base")
register("budget_stats", lambda v: an.budget_stats(an.clean(v.report_base)),
         f"SELECT count(budget_num) AS n_valid, min(budget_num) AS min, max(budget_num) AS max, round(median(budget_num), 6) AS median "
         f"FROM report_base WHERE {CLEAN}")
register("accuracy_by_budget", lambda v: an.accuracy_by_budget(an.clean(v.report_base)),
         f"SELECT budget_tranche, count(*) AS n, round({share('correct_l4')}, 6) AS accuracy FROM report_base "
         f"WHERE {CLEAN} AND {TRUTH4} AND budget_tranche IS NOT NULL GROUP BY 1")
register("confidence_by_budget", lambda v: an.confidence_by_budget(an.clean(v.report_base)),
         "SELECT budget_tranche, count(*) AS n, round(avg(confidence_num), 6) AS mean_conf, round(median(confidence_num), 6) AS median_conf "
         f"FROM report_base WHERE {CLEAN} AND budget_tranche IS NOT NULL GROUP BY 1")

SPENT = f"budget_num IS NOT NULL AND {TRUTH4} AND {CLEAN}"
GOOD = "coalesce(sum(budget_num) FILTER (WHERE correct_l4), 0)"
register("revenue_totals", lambda v: an.revenue_totals(an.clean(v.report_base)),
         f"SELECT count(*) AS n, round(sum(budget_num), 6) AS ca_total, round({GOOD}, 6) AS ca_correct, "
         f"round(sum(budget_num) - {GOOD}, 6) AS ca_wrong, round({GOOD} / sum(budget_num) * 100, 6) AS pct_correct, "
         f"{count_if('correct_l4')} AS n_correct, {count_if('NOT correct_l4')} AS n_wrong, round({share('correct_l4')} * 100, 6) AS pct_n_correct "
         f"FROM report_base WHERE {SPENT}")
REVENUE = (f"round(sum(budget_num), 6) AS ca_total, round({GOOD}, 6) AS ca_correct, count(*) AS n, "
           f"round({GOOD} / nullif(sum(budget_num), 0) * 100, 6) AS pct_correct")
for name, key in (("division", "true_level1"), ("source", "source")):
    register(f"revenue_by_{name}", lambda v, k=key: an.revenue_by(an.clean(v.report_base), k),
             f"SELECT {key} AS value, {REVENUE} FROM report_base WHERE {SPENT} AND {key} IS NOT NULL GROUP BY 1")
register("revenue_by_confidence_band", lambda v: an.revenue_by(an.clean(v.report_base), an.confidence_band_label()),
         f"SELECT {TENTHS} AS value, {REVENUE} FROM report_base WHERE {SPENT} AND confidence_num IS NOT NULL GROUP BY 1")
register("revenue_summary", lambda v: an.revenue_summary(an.clean(v.report_base)),
         f"SELECT {TENTHS} AS value, {REVENUE}, round(sum(budget_num) / (SELECT sum(budget_num) FROM report_base WHERE {SPENT}) * 100, 6) AS pct_ca_total "
         f"FROM report_base WHERE {SPENT} AND confidence_num IS NOT NULL GROUP BY 1")

SUMMARY_LEVELS = "(SELECT level, n, accuracy, f1_weighted, n_true FROM (" + ACC_LEVELS.format(t="tidy") + ") l) lv"
register("prediction_summary", lambda v: an.summary(v.report_base),
         f"""SELECT 'n_total' AS metric, CAST(count(*) AS DOUBLE) AS value FROM report_base
             UNION ALL SELECT 'n_tech', CAST({count_if('is_technical')} AS DOUBLE) FROM report_base
             UNION ALL SELECT 'n_codes', CAST(count(DISTINCT code) AS DOUBLE) FROM tidy
             UNION ALL SELECT 'mean_conf', round(avg(confidence_num), 6) FROM tidy WHERE {TRUTH4}
             UNION ALL SELECT 'median_conf', round(median(confidence_num), 6) FROM tidy WHERE {TRUTH4}
             UNION ALL SELECT 'top_' || k, round({share('hit <= k')} * 100, 6)
                       FROM (SELECT {HIT4} AS hit FROM tidy WHERE {TRUTH4}) h CROSS JOIN (SELECT unnest([1, 5, 10]) AS k) ks GROUP BY k """
         + " ".join(f"UNION ALL SELECT 'level' || level || '_{m}', CAST({m} AS DOUBLE) FROM {SUMMARY_LEVELS}"
                    for m in ("accuracy", "f1_weighted", "n_true", "n")),
         {"tidy": f"SELECT * FROM report_base WHERE {CLEAN}"})
