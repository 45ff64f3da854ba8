"""Splits, features, models, evaluation and drift."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from rosterlake.functions import text
from rosterlake.operators import drift, evaluation, features, scoring, training
from rosterlake.plans import monitoring
from rosterlake.plans import training as training_plan
from rosterlake.session import scratch_path, store
from rosterlake.sources import tables

from .aggregate_queries import sql_numeric, sql_qualitative
from .base import JOINED_SQL, applicants, jobs, joined, prospects, query, r, table
from .text_queries import sql_sentiment

HASH = "('0x' || substr(md5({0}::varchar || ':42'), 1, 8))::bigint"


# ----------------------------------------------------------------------------------- splits
@query("hash_split", "L2", f"SELECT o_orderkey, {HASH.format('o_orderkey')} < 858993459 AS is_test FROM orders")
def _(spark, sf):
    return training.hash_split(table(spark, sf, "orders"), "o_orderkey").select("o_orderkey", "is_test")


@query("stratified_split", "L2", f"""
    SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {HASH.format('doc_id')}, doc_id)
      <= round(count(*) OVER (PARTITION BY quality) * 0.2::double) AS is_test FROM labels""")
def _(spark, sf):
    return training.stratified_split(table(spark, sf, "labels"), "doc_id", "quality").select("doc_id", "quality", "is_test")


@query("stratified_split_orders", "L2", f"""
    SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {HASH.format('o_orderkey')}, o_orderkey)
      <= round(count(*) OVER (PARTITION BY o_orderstatus) * 0.2::double) AS is_test FROM orders""")
def _(spark, sf):
    return training.stratified_split(table(spark, sf, "orders"), "o_orderkey", "o_orderstatus", bits=6).select(
        "o_orderstatus", "o_orderkey", "is_test")


@query("stratified_split_null_keys", "L2", """
    SELECT o_orderstatus, count(*) AS n, round(count(*) * 0.2::double)::bigint AS n_test FROM (
      SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders) GROUP BY 1""")
def _(spark, sf):
    """A third of the keys and a seventh of the classes are null: every row stays, every class has its share."""
    o = table(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey")).alias("key"), "o_custkey", "o_totalprice",
                                          F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("o_orderstatus"))
    return training.stratified_split(o, "key", "o_orderstatus").groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.count_if("is_test").alias("n_test"))


@query("balanced_weights", "L4", """
    SELECT doc_id, round((SELECT count(*) FROM labels)::double / (2 * count(*) OVER (PARTITION BY toxic)), 6) AS weight FROM labels""")
def _(spark, sf):
    return training.balanced_weight(table(spark, sf, "labels"), "toxic").select("doc_id", r("weight"))


@query("standard_scores", "L3", """
    SELECT l_orderkey, l_linenumber, round((l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER (), 5) AS l_quantity,
      round((l_discount - avg(l_discount) OVER ()) / stddev_samp(l_discount) OVER (), 5) AS l_discount FROM lineitem""")
def _(spark, sf):
    df = training.standardize(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"),
                              ["l_quantity", "l_discount"])
    return df.select("l_orderkey", "l_linenumber", r("l_quantity", 5), r("l_discount", 5))


@query("training_table", "L1,L8,F17,F18,F19,F22", f"""
    WITH {JOINED_SQL}, c AS (SELECT p_recrutador AS v, count(*) AS n FROM joined GROUP BY 1)
    SELECT codigo_vaga, codigo_candidato, linha, coalesce(length(app_cv_pt), 0) AS tamanho_cv, {sql_sentiment('p_comentario', text.SENTIMENT_TRAINING)} AS sentimento_comentario_score,
      CASE WHEN p_recrutador IS NULL OR n >= 10 THEN p_recrutador ELSE 'Outros' END AS p_recrutador_tratado,
      coalesce(p_situacao_candidado IN ('APROVADO', 'ENTREVISTA TÉCNICA'), false)::int AS engajado
    FROM joined LEFT JOIN c ON v = p_recrutador""")
def _(spark, sf):
    return features.baseline_training_table(joined(spark, sf)).select(
        "codigo_vaga", "codigo_candidato", "linha", "tamanho_cv", "sentimento_comentario_score", "p_recrutador_tratado", "engajado")


# ----------------------------------------------------------------------------------- models
def document_frame(spark, sf):
    """Labelled documents with plain text features."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return docs.select("doc_id", "lang", F.col("quality").alias("engajado"), F.col("n_chars").cast("double").alias("n_chars"),
                       F.size(F.split("text", r"\s+")).cast("double").alias("n_words"),
                       (F.length(F.regexp_replace("text", "[^.!?]", "")) / F.greatest(F.col("n_chars"), F.lit(1))).alias("stops"),
                       (F.length(F.regexp_replace("text", "[^A-Z]", "")) / F.greatest(F.col("n_chars"), F.lit(1))).alias("capitals"))


def split_sql(source: str, key: str, label: str) -> str:
    """Rows, test rows and class weight of every class, from the hash split alone."""
    return f"""s AS (SELECT {label} AS label, row_number() OVER (PARTITION BY {label} ORDER BY {HASH.format(key)}, {key})
        <= round(count(*) OVER (PARTITION BY {label}) * 0.2::double) AS is_test FROM {source}),
      k AS (SELECT label, count(*) AS n, count(*) FILTER (is_test) AS n_test, count(*) FILTER (NOT is_test) AS n_train FROM s GROUP BY 1)"""


def run_facts(spark, df, key, label, runs):
    """What the logged run says beside what the split and its weights say, a row per class."""
    split = training.stratified_split(df, key, label)
    weights = training.balanced_weight(split.where("NOT is_test"), label).groupBy(label).agg(F.first("weight").alias("weight"))
    best = training.best_run(spark.read.schema(training.RUN_SCHEMA).parquet(runs))
    logged = best.select("run_name", "params.model", F.expr("metrics.roc_auc BETWEEN 0 AND 1").alias("has_auc"),
                         F.expr("map_contains_key(metrics, 'accuracy')").alias("has_accuracy"))
    return (split.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"), F.count_if("is_test").alias("n_test"))
            .join(weights.select(F.col(label).alias("label"), r("weight")), "label").crossJoin(logged))


@query("train_gbt", "L2,L3,L4,L6,L9,T4", f"""
    WITH d AS (SELECT doc_id, quality FROM labels JOIN documents USING (doc_id)), {split_sql('d', 'doc_id', 'quality')}
    SELECT label, n, n_test, round((SELECT sum(n_train) FROM k)::double / ((SELECT count(*) FROM k) * n_train), 6) AS weight,
      'documents' AS run_name, 'gbt' AS model, true AS has_auc, true AS has_accuracy FROM k""")
def _(spark, sf):
    """Train, evaluate, log the run, read back the best run."""
    runs, models = scratch_path(spark, "runs"), scratch_path(spark, "models")
    df = document_frame(spark, sf)
    training_plan.train_and_log(spark, df, "doc_id", runs, models, "documents", ["n_chars", "n_words", "stops", "capitals"], ["lang"], maxIter=10)
    return run_facts(spark, df, "doc_id", "engajado", runs)


@query("train_engagement", "L5,L8,L9", f"""
    WITH {JOINED_SQL}, d AS (SELECT codigo_vaga || '-' || codigo_candidato || '-' || linha AS row_id,
        coalesce(p_situacao_candidado IN ('APROVADO', 'ENTREVISTA TÉCNICA'), false)::int AS engajado FROM joined), {split_sql('d', 'row_id', 'engajado')}
    SELECT label, n, n_test, round((SELECT sum(n_train) FROM k)::double / ((SELECT count(*) FROM k) * n_train), 6) AS weight,
      'engagement' AS run_name, 'gbt' AS model, true AS has_auc, true AS has_accuracy FROM k""")
def _(spark, sf):
    """Random search over the engagement features of the joined table, the recruiter category included: ten draws, three folds."""
    runs, models = scratch_path(spark, "runs"), scratch_path(spark, "models")
    df = training_plan.engagement_rows(spark, prospects(spark, sf), applicants(spark, sf), jobs(spark, sf),
                                       F.lit("2002-01-01").cast("date"), ["codigo_vaga", "codigo_candidato", "linha"])
    df = df.withColumn("row_id", F.concat_ws("-", "codigo_vaga", "codigo_candidato", "linha"))
    training_plan.train_and_log(spark, df, "row_id", runs, models, "engagement", training.ENGAGEMENT_NUMERIC, tries=training.TRIES)
    return run_facts(spark, df, "row_id", "engajado", runs)


@query("fitted_behaviour", "M11,L8,L9,L10", f"""
    WITH {JOINED_SQL} SELECT codigo_vaga, codigo_candidato, count(*) AS n_rows, true AS best_exported, true AS as_recomputed, count(DISTINCT p_comentario) > 0 AS has_comment FROM joined GROUP BY 1, 2""")
def _(spark, sf):
    """Two linear models of the expanded training set, the better one exported, loaded and applied to the pairs.

    Every score is compared with the one recomputed from the stored coefficients in plain column arithmetic.
    """
    runs, models, exported = scratch_path(spark, "runs"), scratch_path(spark, "models"), scratch_path(spark, "exported")
    built = training_plan.behaviour_rows(spark, prospects(spark, sf), applicants(spark, sf), jobs(spark, sf),
                                         ["codigo_vaga", "codigo_candidato", "linha"])
    rows = training_plan.expanded_table(built).withColumn("row_id", F.concat_ws("-", "codigo_vaga", "codigo_candidato", "linha"))
    rows = store(rows.select("row_id", "engajado", *training.EXPANDED_NUMERIC, *training.BASELINE_CATEGORICAL))
    for name, numeric, categorical in (("days only", training.EXPANDED_NUMERIC[3:4], []), ("expanded", training.EXPANDED_NUMERIC, training.BASELINE_CATEGORICAL)):
        training_plan.train_and_log(spark, rows, "row_id", runs, models, name, numeric, categorical, kind="linear")
    best = training.export_best_model(spark, runs, exported)
    model = training.exported_model(spark, exported)
    scored = scoring.behaviour_score(built.select("codigo_vaga", "codigo_candidato", "p_comentario", "p_recrutador", *training.EXPANDED_NUMERIC[3:]), model)
    comment = text.clean_text(F.col("p_comentario"))
    again = features.sentiment_columns(scored.withColumns({
        "c": comment, "p_recrutador_tratado": text.keep_listed(text.clean_text(F.col("p_recrutador")), text.COMMON_RECRUITERS)}), text.SENTIMENT_SCORING, "c")
    same = F.abs(training.linear_expression(model) - F.col("score_behavioral")) < 1e-9
    log = spark.read.schema(training.RUN_SCHEMA).parquet(runs)
    is_best = log.agg((F.max("metrics.roc_auc") == F.max(F.when(F.col("run_id") == best, F.col("metrics.roc_auc")))).alias("x")).scalar()
    return again.groupBy("codigo_vaga", "codigo_candidato").agg(
        F.count("*").alias("n_rows"), F.bool_and(is_best).alias("best_exported"), F.bool_and(F.coalesce(same, F.lit(False))).alias("as_recomputed"),
        (F.count("p_comentario") > 0).alias("has_comment"))


@query("export_best", "L9,L10,T4", """
    SELECT o_orderstatus AS run_name, round(avg(o_totalprice), 4) AS roc_auc FROM orders GROUP BY 1 ORDER BY 2 DESC LIMIT 1""")
def _(spark, sf):
    """One run per order status, its mean price as the metric."""
    runs = (table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("run_name")).agg(F.avg("o_totalprice").alias("m"))
            .select(F.col("run_name").alias("run_id"), "run_name", F.create_map(F.lit("roc_auc"), "m").alias("metrics")))
    return training.best_run(runs).select("run_name", F.round(F.try_element_at("metrics", F.lit("roc_auc")), 4).alias("roc_auc"))


@query("retrain_gate", "L11,J6,S15", """
    SELECT unnest([0, 1, 2]) AS run, unnest([true, false, true]) AS trained, unnest([(SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0),
      (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0), (SELECT count(*) FROM orders)]) AS known""")
def _(spark, sf):
    """Half of the jobs, the same half again, then all of them."""
    state, out = scratch_path(spark, "tracker"), scratch_path(spark, "gate")
    everything = jobs(spark, sf)
    half = everything.where("cast(codigo_vaga as bigint) % 2 = 0")
    for run, current in enumerate((half, half, everything)):
        trained = training_plan.retrain_if_new(spark, current, state, lambda: None)
        known = tables.processed_ids(spark, state, "codigo_vaga").agg(F.count("*").alias("known"))
        known.select(F.lit(run).alias("run"), F.lit(trained).alias("trained"), "known").write.mode("append").parquet(out)
    return spark.read.parquet(out)


# ------------------------------------------------------------------------------- evaluation
LABELLED = "SELECT d.doc_id, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)"


def labelled(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id")


AUC_SQL = """
    , k AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::double AS rk FROM d)
    SELECT round((sum(rk) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0::double)
      / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)::double), 8) AS roc_auc FROM k"""


@query("auc_rank", "L6", f"WITH d AS (SELECT n_chars AS s, quality AS y FROM ({LABELLED})) {AUC_SQL}")
def _(spark, sf):
    return evaluation.roc_auc(labelled(spark, sf), "n_chars", "quality").select(r("roc_auc", 8))


@query("auc_lineitem", "L6", f"WITH d AS (SELECT l_quantity * (1 + l_discount) AS s, (l_returnflag = 'A')::int AS y FROM lineitem) {AUC_SQL}")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select((F.col("l_quantity") * (1 + F.col("l_discount"))).alias("s"),
                                             (F.col("l_returnflag") == "A").cast("int").alias("y"))
    return evaluation.roc_auc(df, "s", "y").select(r("roc_auc", 8))


@query("confusion_matrix", "L7", f"""
    SELECT quality AS label, count(*) FILTER (n_chars <= 600) AS pred_0, count(*) FILTER (n_chars > 600) AS pred_1 FROM ({LABELLED}) GROUP BY 1""")
def _(spark, sf):
    df = labelled(spark, sf).withColumn("yhat", (F.col("n_chars") > 600).cast("int"))
    return evaluation.confusion(df, "quality", "yhat")


@query("classification_report", "L7", f"""
    WITH c AS (SELECT quality AS y, (n_chars > 600)::int AS p FROM ({LABELLED})), k AS (SELECT unnest([0, 1]) AS label),
    m AS (SELECT label, (SELECT count(*) FROM c WHERE y = label AND p = label)::double AS tp, (SELECT count(*) FROM c WHERE p = label) AS said,
      (SELECT count(*) FROM c WHERE y = label) AS support FROM k),
    d AS (SELECT label, support, coalesce(tp / nullif(said, 0), 0) AS pr, coalesce(tp / nullif(support, 0), 0) AS re FROM m)
    SELECT label, round(pr, 6) AS precision, round(re, 6) AS recall, round(coalesce(2 * pr * re / nullif(pr + re, 0), 0), 6) AS f1, support FROM d""")
def _(spark, sf):
    df = labelled(spark, sf).withColumn("yhat", (F.col("n_chars") > 600).cast("int"))
    return evaluation.classification_report(df, "quality", "yhat").select("label", r("precision"), r("recall"), r("f1"), "support")


@query("accuracy", "L6", f"SELECT round(avg((quality = (n_chars > 600)::int)::int), 6) AS accuracy FROM ({LABELLED})")
def _(spark, sf):
    df = labelled(spark, sf).withColumn("yhat", (F.col("n_chars") > 600).cast("int"))
    return evaluation.accuracy(df, "quality", "yhat").select(r("accuracy"))


@query("performance_alert", "L12", f"""
    WITH a AS (WITH d AS (SELECT n_chars AS s, quality AS y FROM ({LABELLED})) {AUC_SQL})
    SELECT roc_auc, 0.9::double AS baseline_auc, roc_auc < 0.9 * 0.95 AS alert FROM a""")
def _(spark, sf):
    return evaluation.performance_alert(labelled(spark, sf), "n_chars", "quality", 0.9).withColumn("roc_auc", r("roc_auc", 8))


# ------------------------------------------------------------------------------------ drift
CUT = "timestamp '2024-01-24 00:00:00'"


def event_sides(spark, sf):
    events = table(spark, sf, "events").withColumn("hour", F.hour("ts"))
    cut = F.lit("2024-01-24").cast("timestamp_ntz")
    return events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut)


SIDES = (f"e AS (SELECT *, hour(ts) AS hour FROM events), ref AS (SELECT * FROM e WHERE ts < {CUT}), cur AS (SELECT * FROM e WHERE ts >= {CUT})")


def sql_numeric_drift(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count(*) AS n_values, any_value(n) AS n_ref, any_value(m) AS n_cur, max(abs(rt / n - ct / m)) AS ks,
        sum(abs(rt / n - ct / m) * coalesce(nx - x, 0)) / greatest((SELECT stddev_pop({column}) FROM ref), 0.001) AS wasserstein
      FROM (SELECT x, lead(x) OVER (ORDER BY x) AS nx, sum(r) OVER (ORDER BY x)::double AS rt, sum(c) OVER (ORDER BY x)::double AS ct, (sum(r) OVER ())::bigint AS n, (sum(c) OVER ())::bigint AS m
        FROM (SELECT x, sum(r) AS r, sum(c) AS c FROM (SELECT {column}::double AS x, 1 AS r, 0 AS c FROM ref UNION ALL SELECT {column}::double, 0, 1 FROM cur) GROUP BY x))"""


@query("drift_numeric", "D1", f"""
    WITH {SIDES} SELECT column_name, n_values, n_ref, n_cur, round(ks, 8) AS ks, round(wasserstein, 8) AS wasserstein FROM (
      {sql_numeric_drift('value')} UNION ALL {sql_numeric_drift('user_id')} UNION ALL {sql_numeric_drift('hour')})""")
def _(spark, sf):
    df = drift.numeric_drift(*event_sides(spark, sf), ["value", "user_id", "hour"])
    return df.withColumnRenamed("column", "column_name").withColumns({"ks": r("ks", 8), "wasserstein": r("wasserstein", 8)})


def sql_category_drift(column: str) -> str:
    fill = "CASE WHEN {0} > 0 THEN {0} / {1}::double ELSE CASE WHEN {2} / {1}::double <= 0.0001 THEN {2} / {1}::double / 1e6 ELSE 0.0001 END END"
    return f"""SELECT '{column}' AS column_name, count(*) AS n_values, any_value(n) AS n_ref, any_value(m) AS n_cur,
        sum(CASE WHEN r > 0 THEN pow(c - r * m / n::double, 2) / (r * m / n::double) ELSE 'inf'::double END) AS chi2,
        sqrt(sum((p / sp * ln(p / sp / ((p / sp + q / sq) / 2)) + q / sq * ln(q / sq / ((p / sp + q / sq) / 2))) / 2)) AS jensen_shannon
      FROM (SELECT *, sum(p) OVER () AS sp, sum(q) OVER () AS sq FROM (SELECT *, {fill.format('r', 'n', 'mr')} AS p, {fill.format('c', 'm', 'mc')} AS q FROM (
        SELECT x, r, c, (sum(r) OVER ())::bigint AS n, (sum(c) OVER ())::bigint AS m, min(r) FILTER (r > 0) OVER () AS mr, min(c) FILTER (c > 0) OVER () AS mc
        FROM (SELECT x, sum(r) AS r, sum(c) AS c FROM (SELECT {column}::varchar AS x, 1 AS r, 0 AS c FROM ref UNION ALL SELECT {column}::varchar, 0, 1 FROM cur) WHERE x IS NOT NULL GROUP BY x))))"""


@query("drift_category", "D1", f"""
    WITH {SIDES} SELECT column_name, n_values, n_ref, n_cur, round(chi2, 6) AS chi2, round(jensen_shannon, 8) AS jensen_shannon FROM (
      {sql_category_drift('event_type')} UNION ALL {sql_category_drift('user_id')} UNION ALL {sql_category_drift('hour')})""")
def _(spark, sf):
    df = drift.category_drift(*event_sides(spark, sf), ["event_type", "user_id", "hour"])
    return df.drop("z").withColumnRenamed("column", "column_name").withColumns(
        {"chi2": r("chi2"), "jensen_shannon": r("jensen_shannon", 8)})


KS_P = """CASE WHEN x < 0.2 THEN 1.0 ELSE least(greatest(2 * list_sum([pow(-1, k - 1) * exp(-2 * k * k * x * x) for k in range(1, 101)]), 0), 1) END"""
COLUMN_SQL = f"""
    c AS (SELECT *, score >= 0.1 AS drifted FROM (
      SELECT column_name, 'num' AS kind, 'wasserstein' AS test, wasserstein AS score
        FROM ({sql_numeric_drift('value')} UNION ALL {sql_numeric_drift('user_id')} UNION ALL {sql_numeric_drift('hour')})
      UNION ALL SELECT column_name, 'cat', 'jensen_shannon', jensen_shannon FROM ({sql_category_drift('event_type')})))"""


@query("drift_columns", "D1", f"""
    WITH {SIDES}, {COLUMN_SQL} SELECT column_name, kind, test, round(score, 8) AS score, drifted FROM c""")
def _(spark, sf):
    df = drift.column_drift(*event_sides(spark, sf), ["value", "user_id", "hour", "event_type"])
    return df.select(F.col("column").alias("column_name"), "kind", "test", r("score", 8), "drifted")


@query("drift_dataset", "D2,D3", f"""
    WITH {SIDES}, {COLUMN_SQL} SELECT count(*) FILTER (drifted) AS number_of_drifted_columns, count(*) AS number_of_columns,
      count(*) FILTER (drifted) / count(*)::double AS drift_share, count(*) FILTER (drifted) / count(*)::double >= 0.5 AS dataset_drift,
      count(*) FILTER (drifted) / count(*)::double > 0.15 AS alert FROM c""")
def _(spark, sf):
    return drift.dataset_drift(drift.column_drift(*event_sides(spark, sf), ["value", "user_id", "hour", "event_type"]))


@query("drift_small_reference", "D1", f"""
    WITH g AS (SELECT c_nationkey AS g, c_acctbal AS v, c_mktsegment AS s, c_custkey % 2 AS b, c_custkey FROM customer),
    ref AS (SELECT v, s, (b = 0)::varchar AS b FROM g WHERE c_custkey % 3 = 0), cur AS (SELECT v, s, (b = 0 OR c_custkey % 5 = 0)::varchar AS b FROM g WHERE c_custkey % 3 <> 0),
    n AS (SELECT ks, n_ref, n_cur, sqrt(n_ref * n_cur / (n_ref + n_cur)::double) AS rt FROM ({sql_numeric_drift('v')})),
    k AS (SELECT ks, (rt + 0.12 + 0.11 / rt) * ks AS x FROM n),
    c AS (SELECT chi2, (n_values - 1) / 2.0::double AS a, chi2 / 2 AS h FROM ({sql_category_drift('s')})),
    z AS (SELECT (a / n - c / m) / sqrt((a + c) / (n + m) * (1 - (a + c) / (n + m)) * (1 / n + 1 / m)) AS z FROM (SELECT
      (SELECT count(*) FROM ref WHERE b = 'false')::double AS a, (SELECT count(*) FROM cur WHERE b = 'false')::double AS c, (SELECT count(*) FROM ref)::double AS n, (SELECT count(*) FROM cur)::double AS m))
    SELECT 'v' AS column_name, 'ks' AS test, round(ks, 6) AS statistic, round({KS_P}, 6) AS score FROM k
    UNION ALL SELECT 's', 'chi2', round(chi2, 6), abs(round(1 - list_sum([exp(-h + (a + i) * ln(h) - lgamma(a + i + 1)) for i in range(0, 2000)]), 6)) FROM c
    UNION ALL SELECT 'b', 'z', round(z, 6), NULL FROM z""")
def _(spark, sf):
    """The tests with p-values, over all customers: every third one against the others."""
    g = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("v"), F.col("c_mktsegment").alias("s"), (F.col("c_custkey") % 2 == 0).alias("even"))
    ref = g.where("c_custkey % 3 = 0").select("v", "s", F.col("even").cast("string").alias("b"))
    cur = g.where("c_custkey % 3 <> 0").select("v", "s", (F.col("even") | (F.col("c_custkey") % 5 == 0)).cast("string").alias("b"))
    df = drift.column_drift(ref, cur, test="p_value")
    return df.select(F.col("column").alias("column_name"), "test", r("statistic"),
                     F.when(F.col("test") != "z", F.round("score", 6)).alias("score"))


@query("drift_empty_columns", "D1,D2", f"""
    WITH {SIDES} SELECT * FROM (VALUES ('gone', 'one_sided', true), ('new_number', 'one_sided', true), ('none', 'no_values', false)) t(column_name, status, drifted)
    UNION ALL SELECT 'event_type', CASE WHEN (SELECT count(event_type) FROM ref) > 0 AND (SELECT count(event_type) FROM cur) > 0 THEN 'ok' END, jensen_shannon >= 0.1
      FROM ({sql_category_drift('event_type')})""")
def _(spark, sf):
    """Columns without any value on one side or on both."""
    null = F.lit(None).cast("string")
    ref, cur = event_sides(spark, sf)
    ref = ref.select("event_type", F.col("event_type").alias("gone"), F.lit(None).cast("double").alias("new_number"), null.alias("none"))
    cur = cur.select("event_type", null.alias("gone"), F.col("value").alias("new_number"), null.alias("none"))
    return drift.column_drift(ref, cur).select(F.col("column").alias("column_name"), "status", "drifted")


PSI_SHARE = "CASE WHEN {0} > 0 THEN {0} / {1}::double ELSE 0.0001 END"


def sql_psi(column: str) -> str:
    cuts = ", ".join(f"quantile_cont({column}::double, {i / 10})" for i in range(1, 10))
    p, q = PSI_SHARE.format("r", "n"), PSI_SHARE.format("c", "m")
    return f"""SELECT '{column}' AS column_name, round(sum((({q}) - ({p})) * ln(({q}) / ({p}))), 8) AS psi FROM (SELECT *, sum(r) OVER () AS n, sum(c) OVER () AS m FROM (
        SELECT len([k for k in list_distinct(cuts) if k < x]) AS bin, sum(r) AS r, sum(c) AS c FROM (SELECT {column}::double AS x, 1 AS r, 0 AS c FROM ref
          UNION ALL SELECT {column}::double, 0, 1 FROM cur), (SELECT [{cuts}] AS cuts FROM ref) GROUP BY 1))"""


@query("drift_psi", "D5", f"WITH {SIDES} {sql_psi('value')} UNION ALL {sql_psi('user_id')} UNION ALL {sql_psi('hour')}")
def _(spark, sf):
    df = drift.population_stability(*event_sides(spark, sf), ["value", "user_id", "hour"])
    return df.select(F.col("column").alias("column_name"), r("psi", 8))


@query("drift_embedding", "D6", """
    WITH x AS (SELECT label % 2 AS side, unnest(embedding)::double AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings),
    m AS (SELECT pos, avg(v) FILTER (side = 0) AS a, avg(v) FILTER (side = 1) AS b FROM x GROUP BY pos)
    SELECT round(sqrt(sum((a - b) * (a - b))), 8) AS euclidean, round(1 - sum(a * b) / sqrt(sum(a * a)) / sqrt(sum(b * b)), 8) AS cosine_distance FROM m""")
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    return drift.embedding_drift(e.where("label % 2 = 0"), e.where("label % 2 = 1"), "embedding").select(
        r("euclidean", 8), r("cosine_distance", 8))


EVENT_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string", "hour": "int"}
EVENT_NUMBERS = [c for c, kind in EVENT_TYPES.items() if kind in ("bigint", "double", "int")]
QUALITY_FIGURES = ["null_count", "null_percent", "n_unique", "min_len", "max_len", "avg_len", "mean", "std", "min", "q25", "median", "q75", "max", "iqr",
                   "outlier_count", "skewness"]


def sql_side_quality(side: str) -> str:
    figures = ", ".join(f"{f} AS {side}_{f}" for f in QUALITY_FIGURES)
    return f"""{side}_q AS (SELECT column_name, {figures} FROM (SELECT * EXCLUDE (dtype) FROM ({sql_qualitative(side, EVENT_TYPES)}))
      LEFT JOIN (SELECT * EXCLUDE (null_count, n_unique) FROM ({sql_numeric(side, EVENT_NUMBERS)})) USING (column_name))"""


@query("drift_quality", "D4,A7,A10", f"""
    WITH {SIDES}, {sql_side_quality('ref')}, {sql_side_quality('cur')} SELECT * FROM ref_q JOIN cur_q USING (column_name)""")
def _(spark, sf):
    """Every figure of every column of both sides."""
    digits = {"null_percent": 6, "avg_len": 6, "mean": 4, "std": 4, "q25": 6, "median": 6, "q75": 6, "iqr": 6, "skewness": 4}
    found = drift.quality_summary(*event_sides(spark, sf))
    return found.select(F.col("column").alias("column_name"), *[
        r(f"{side}_{f}", digits[f]) if f in digits else F.col(f"{side}_{f}") for side in ("ref", "cur") for f in QUALITY_FIGURES])


@query("drift_report", "D7,D8,S13", f"""
    WITH {SIDES}, {COLUMN_SQL}, auc AS (WITH d AS (SELECT n_chars AS s, quality AS y FROM ({LABELLED})) {AUC_SQL}), s AS (SELECT count(*) FILTER (drifted) AS k, count(*) AS n FROM c)
    SELECT date '2024-02-01' AS report_date, 'ok' AS status, k / n::double >= 0.5 AS dataset_drift, k / n::double AS drift_share, k AS number_of_drifted_columns,
      k / n::double > 0.15 AS alert, roc_auc FROM s, auc
    UNION ALL SELECT date '2024-02-02', 'skipped', false, 0.0, 0, false, NULL""")
def _(spark, sf):
    path = scratch_path(spark, "reports")
    ref, cur = event_sides(spark, sf)
    columns = ["value", "user_id", "hour", "event_type"]
    auc = evaluation.roc_auc(labelled(spark, sf), "n_chars", "quality")
    for day, now, measured in ((datetime.date(2024, 2, 1), cur, auc), (datetime.date(2024, 2, 2), cur.where("false"), None)):
        monitoring.append_report(monitoring.drift_report(ref, now, columns, F.lit(day), measured), path)
    return spark.read.schema("status string, dataset_drift boolean, drift_share double, number_of_drifted_columns bigint, roc_auc double, "
                             "alert boolean, report_date date").parquet(path).withColumn("roc_auc", r("roc_auc", 8))
