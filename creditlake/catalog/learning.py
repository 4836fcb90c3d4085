"""Models, forecast and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import ymd_date
from ..operators import forecast as fc
from ..operators import learning as ml
from ..operators import search
from ..operators.topk import top_k
from ..plans import profile
from ..session import scratch_path
from .base import part, query
from .products import gold_features, gold_profile

CROSS_CAT = ["state", "occupation"]
CROSS_NUM = ["age", "net_income", "annual_income", "loan_app_count", "total_loan_financed", "avg_loan_dsr",
             "latest_bureau_score"]
RISK_CAT, RISK_NUM = ["state", "region", "occupation"], ["age", "net_income", "annual_income"]


def cross_sell_model(t):
    rows = gold_features(t)
    return ml.fit_propensity(rows, "label_has_card", CROSS_CAT, CROSS_NUM), rows


@query("ml_01_logistic_fit")
def ml_01(t):
    """Fit of the delinquency model; class balance of the fit's own predictions."""
    rows = gold_profile(t).withColumn("delinquency_risk", F.when(F.col("combined_unpaid") > 0, 1).otherwise(0))
    p = ml.fit_propensity(rows, "delinquency_risk", RISK_CAT, RISK_NUM)
    return ml.predict(p, rows).groupBy("delinquency_risk", "predicted_delinquency_risk").agg(F.count(F.lit(1)).alias("n"))


@query("ml_02_batch_score")
def ml_02(t):
    p, rows = cross_sell_model(t)
    probs = F.col("predicted_label_has_card_probs")
    return ml.predict(p, rows).select("cif_id", "label_has_card", "predicted_label_has_card",
                                      F.round(F.get(probs, F.lit(0))["prob"], 6).alias("prob"))


part("scored_rows", """
SELECT cif_id, CASE WHEN combined_unpaid > 0 THEN 1 ELSE 0 END AS label,
  ((cif_id::bigint * 37) % 101 + CASE WHEN combined_unpaid > 0 THEN 20 ELSE 0 END) / 128e0 AS prob FROM gold_profile""")


@query("ml_03_evaluate", """
SELECT tp / (tp + fp)::double AS precision, tp / (tp + fn)::double AS recall, (tp + tn) / n::double AS accuracy,
  2 * tp / (2 * tp + fp + fn)::double AS f1_score, ll AS log_loss,
  (SELECT sum(CASE WHEN p.prob > q.prob THEN 2 WHEN p.prob = q.prob THEN 1 ELSE 0 END)::double / (2 * count(*))
   FROM scored_rows p, scored_rows q WHERE p.label = 1 AND q.label = 0) AS roc_auc
FROM (SELECT count(*) AS n, count(*) FILTER (label = 1 AND prob >= 0.5) AS tp, count(*) FILTER (label = 0 AND prob >= 0.5) AS fp,
    count(*) FILTER (label = 1 AND prob < 0.5) AS fn, count(*) FILTER (label = 0 AND prob < 0.5) AS tn,
    round(avg(-CASE WHEN label = 1 THEN ln(greatest(prob, 1e-15)) ELSE ln(1 - greatest(prob, 1e-15)) END), 9) AS ll
  FROM scored_rows)""")
def ml_03(t):
    risky = F.col("combined_unpaid") > 0
    scored = gold_profile(t).select(
        F.when(risky, 1).otherwise(0).alias("label"),
        (((F.col("cif_id").cast("bigint") * 37) % 101 + F.when(risky, 20).otherwise(0)).cast("double") / 128.0).alias("prob"))
    return ml.evaluate(scored, "label", "prob")


@query("ml_03b_model_metrics")
def ml_03b(t):
    """Metrics of a fit on the train part, measured on the test part."""
    rows = gold_features(t)
    train, test = ml.split(rows, "cif_id")
    p = ml.fit_propensity(train, "label_has_card", CROSS_CAT, CROSS_NUM)
    probs = F.get("predicted_label_has_card_probs", F.lit(0))["prob"]
    return ml.evaluate(ml.predict(p, test).withColumn("prob", probs), "label_has_card", "prob")


@query("ml_04_global_importance")
def ml_04(t):
    p, rows = cross_sell_model(t)
    return ml.global_importance(p, rows)


@query("ml_05_row_attributions")
def ml_05(t):
    p, rows = cross_sell_model(t)
    out = ml.explain(p, rows, rows)
    return out.select("cif_id", F.round("probability", 6).alias("probability"), F.round("baseline", 6).alias("baseline"),
                      F.round("logit", 6).alias("logit"), *[ml.reason("top_feature_attributions", i).alias(f"reason_{i + 1}")
                                                            for i in range(3)])


@query("ml_06_balance_audit", """
SELECT count(*) AS customers, count(*) FILTER (label_has_card = 1) AS with_card,
  count(*) FILTER (label_has_card = 0) AS without_card,
  count(*) FILTER (label_has_card = 0 AND loan_app_count > 0 AND recv_promo = 'Y') AS eligible_pool,
  round(avg(net_income::decimal(18,2))::decimal(22,6), 2)::double AS avg_income,
  round(avg(latest_bureau_score::decimal(18,2))::decimal(22,6), 1)::double AS avg_score FROM feature_rows""")
def ml_06(t):
    label = F.col("label_has_card")
    return gold_features(t).agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(label == 1).alias("with_card"),
        F.count_if(label == 0).alias("without_card"),
        F.count_if((label == 0) & (F.col("loan_app_count") > 0) & (F.col("recv_promo") == "Y")).alias("eligible_pool"),
        F.round(F.avg(F.col("net_income").cast("decimal(18,2)")), 2).alias("avg_income"),
        F.round(F.avg(F.col("latest_bureau_score").cast("decimal(18,2)")), 1).alias("avg_score"))


part("daily_rows", """
SELECT sales_type, try_strptime(nullif(tx_dt::varchar, '0'), '%Y%m%d')::date AS ds,
  sum(amount::decimal(18,2))::double AS y FROM f_card_sales GROUP BY 1, 2""")
part("trend_fit", """
SELECT *, y - level0 - slope * x AS r FROM (
  SELECT *, avg(y) OVER w - slope * avg(x) OVER w AS level0 FROM (
    SELECT *, regr_slope(y, x) OVER w AS slope FROM (
      SELECT *, (ds - first)::double AS x, dayofweek(ds) AS dow FROM (
        SELECT *, min(ds) OVER w AS first, max(ds) OVER w AS last FROM daily_rows WINDOW w AS (PARTITION BY sales_type)))
    WINDOW w AS (PARTITION BY sales_type))
  WINDOW w AS (PARTITION BY sales_type))""")


@query("ml_07_forecast", """
WITH season AS (SELECT *, avg(r) OVER (PARTITION BY sales_type, dow) AS s FROM trend_fit),
fit AS (SELECT sales_type, first, last, slope, level0, stddev_samp(r - s) AS sd FROM season GROUP BY 1, 2, 3, 4, 5),
days AS (SELECT *, unnest(generate_series(1, 30)) AS h FROM fit),
points AS (SELECT d.*, d.last + d.h::int AS fd, level0 + slope * (d.last + d.h::int - d.first) + coalesce(
    (SELECT min(s) FROM season q WHERE q.sales_type = d.sales_type AND q.dow = dayofweek(d.last + d.h::int)), 0) AS v
  FROM days d)
SELECT sales_type, fd AS forecast_date, v::decimal(18,2)::double AS forecast_value,
  (v - 1.959964 * sd)::decimal(18,2)::double AS lower_bound, (v + 1.959964 * sd)::decimal(18,2)::double AS upper_bound,
  0.95::double AS confidence_level FROM points""")
def ml_07(t):
    daily = fc.daily_series(t.f("card_sales"), ymd_date("tx_dt"), ["sales_type"], "amount")
    return fc.forecast(daily, ["sales_type"])


@query("ml_07b_forecast_hook", """
SELECT sales_type, ds + 7 AS ds, y AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY sales_type ORDER BY ds DESC) AS rn FROM daily_rows WHERE ds IS NOT NULL) WHERE rn <= 7""")
def ml_07b(t):
    """The last week of each series, repeated."""
    daily = fc.daily_series(t.f("card_sales"), ymd_date("tx_dt"), ["sales_type"], "amount").withColumn("value", F.col("value").cast("double"))
    return fc.repeat_last(daily, ["sales_type"])


@query("ml_08_saved_model")
def ml_08(t):
    """Save with metrics, load again and score with the copy."""
    p, rows = cross_sell_model(t)
    probs = F.get("predicted_label_has_card_probs", F.lit(0))["prob"]
    metrics = ml.evaluate(ml.predict(p, rows).withColumn("prob", probs), "label_has_card", "prob")
    root = scratch_path(t.spark, "models")
    runs = ml.save_model(p, root, "v1", metrics, t.spark)
    again = ml.load_model(root, "v1", "label_has_card", CROSS_CAT, CROSS_NUM)
    scored = ml.predict(again, rows).groupBy("predicted_label_has_card").agg(F.count(F.lit(1)).alias("n"))
    return scored.withColumn("version", runs.select(F.max("version")).scalar())


@query("dp_22_next_product_list")
def dp_22(t):
    p, rows = cross_sell_model(t)
    out = ml.explain(p, profile.prequalified(rows), rows)
    return top_k(out, [F.col("probability").desc(), F.col("net_income").desc(), F.col("cif_id").asc()], 15).select(
        "cif_id", "cif_nm", "state", "occupation", "net_income", "loan_app_count", "total_loan_financed", "avg_loan_dsr",
        "latest_bureau_score", F.col("recv_promo").alias("marketing_consent"), F.round("probability", 4).alias("card_probability"),
        *[ml.reason("top_feature_attributions", i).alias(f"top_{i + 1}_reason") for i in range(3)],
        profile.offer().alias("recommended_offer"))


@query("txt_01_keyword_search", "SELECT doc_id, lang FROM documents WHERE lower(text) LIKE '%licen%' OR lower(source) LIKE '%licen%' "
                                "ORDER BY doc_id LIMIT 4")
def txt_01(t):
    return search.keyword_search(t.documents, "Licen", ["text", "source"], "doc_id").select("doc_id", "lang")


@query("txt_02_vector_search", """
WITH c AS (SELECT list(v ORDER BY i) AS q FROM (
  SELECT i, avg(v::double) AS v FROM (SELECT unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)
  GROUP BY i))
SELECT 0 AS query_id, vec_id, round(list_cosine_similarity(embedding::double[], q), 6) AS similarity
FROM embeddings, c ORDER BY similarity DESC, vec_id LIMIT 5""")
def txt_02(t):
    query_vector = search.centroid(t.embeddings, "embedding").scalar()
    return search.nearest(t.embeddings, "embedding", "vec_id", [query_vector], 5)


# A model with one text column has as many free logits as groups, so balanced weights give a closed form: the logit of a group
# is ln((pos_g / pos) / (neg_g / neg)).
part("group_logits", """
SELECT g, n_g, ln((pos_g / pos) / (neg_g / neg)) AS logit, n_g / sum(n_g) OVER () AS share FROM (
  SELECT g, count(*)::double AS n_g, sum(y)::double AS pos_g, sum(1 - y)::double AS neg_g,
    sum(sum(y)) OVER ()::double AS pos, sum(sum(1 - y)) OVER ()::double AS neg
  FROM (SELECT 'g' || (cif_id::bigint % 3)::varchar AS g, CASE WHEN combined_unpaid > 0 THEN 1 ELSE 0 END AS y FROM gold_profile) GROUP BY g)""")
part("group_attributions", "SELECT g, n_g, logit, logit - sum(share * logit) OVER () AS attribution FROM group_logits")


def grouped_risk(t):
    return gold_profile(t).select(F.concat(F.lit("g"), (F.col("cif_id").cast("bigint") % 3).cast("string")).alias("g"),
                                  F.when(F.col("combined_unpaid") > 0, 1).otherwise(0).alias("y"))


def grouped_model(t):
    return ml.fit_propensity(grouped_risk(t), "y", ["g"], [], max_iter=200)


@query("ml_01c_closed_form_scores", "SELECT g, n_g::bigint AS n, round(1 / (1 + exp(-logit)), 4) AS prob FROM group_logits")
def ml_01c(t):
    """Fit and batch scores against the closed form."""
    probs = F.col("predicted_y_probs")[0]["prob"]
    return ml.predict(grouped_model(t), grouped_risk(t)).groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.round(F.max(probs), 4).alias("prob"))


@query("ml_05c_closed_form_attributions", "SELECT g, round(logit, 3) AS logit, round(attribution, 3) AS attribution FROM group_attributions")
def ml_05c(t):
    rows = grouped_risk(t)
    top = F.col("top_feature_attributions")[0]["attribution"]
    return ml.explain(grouped_model(t), rows, rows).groupBy("g").agg(F.round(F.max("logit"), 3).alias("logit"), F.round(F.max(top), 3).alias("attribution"))


@query("ml_04c_closed_form_importance", "SELECT 'g' AS feature, round(sum(n_g * abs(attribution)) / sum(n_g), 3) AS attribution FROM group_attributions")
def ml_04c(t):
    return ml.global_importance(grouped_model(t), grouped_risk(t)).withColumn("attribution", F.round("attribution", 3))


@query("ml_08c_loaded_model_scores", "SELECT g, round(1 / (1 + exp(-logit)), 4) AS prob FROM group_logits")
def ml_08c(t):
    """Scores of a saved and loaded copy."""
    root, rows = scratch_path(t.spark, "models"), grouped_risk(t)
    metrics = t.spark.range(1).select(F.lit(1.0).alias("roc_auc"))
    ml.save_model(grouped_model(t), root, "v1", metrics, t.spark)
    probs = F.col("predicted_y_probs")[0]["prob"]
    return ml.predict(ml.load_model(root, "v1", "y", ["g"], []), rows).groupBy("g").agg(F.round(F.max(probs), 4).alias("prob"))
