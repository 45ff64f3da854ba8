"""Aggregates, profiles and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.operators import joins, ordered, profile, quality, scoring
from rosterlake.session import over_all_cores

from .base import APPLICANTS, CURATED_SQL, applicants, jobs, query, r, table


@query("group_count", "A1", "SELECT l_suppkey, count(*) AS count FROM lineitem GROUP BY 1")
def _(spark, sf):
    return joins.value_counts(table(spark, sf, "lineitem"), "l_suppkey")


@query("filtered_group_count", "A2", """
    SELECT event_type, count(*) AS total FROM events WHERE user_id IS NOT NULL AND value > 10 GROUP BY 1 ORDER BY 2 DESC""")
def _(spark, sf):
    kept = table(spark, sf, "events").where("user_id IS NOT NULL AND value > 10")
    return joins.value_counts(kept, "event_type", "total").orderBy(F.desc("total"))


@query("value_counts", "A3", "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1 ORDER BY 1")
def _(spark, sf):
    return joins.value_counts(table(spark, sf, "orders"), "o_orderpriority").orderBy("o_orderpriority")


@query("global_max_mean", "A4,A5", """
    SELECT max(l_shipdate)::date AS latest, round(avg(l_extendedprice), 4) AS mean_price FROM lineitem""")
def _(spark, sf):
    return table(spark, sf, "lineitem").agg(
        F.max("l_shipdate").cast("date").alias("latest"), F.round(F.avg("l_extendedprice"), 4).alias("mean_price"))


@query("group_mean", "A6", "SELECT c_mktsegment, round(avg(c_acctbal), 4) AS mean_balance FROM customer GROUP BY 1 ORDER BY 1")
def _(spark, sf):
    return (table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.round(F.avg("c_acctbal"), 4).alias("mean_balance"))
            .orderBy("c_mktsegment"))


def sql_qualitative(source: str, columns: dict[str, str]) -> str:
    """Profile rows of the given columns; the value is the Spark type name."""
    parts = []
    for c, kind in columns.items():
        lengths = (f"coalesce(min(length({c})), 0), coalesce(max(length({c})), 0), round(coalesce(avg(length({c})), 0), 6)"
                   if kind == "string" else "NULL::bigint, NULL::bigint, NULL::double")
        parts.append(f"SELECT '{c}', '{kind}', count(*) - count({c}), round((count(*) - count({c})) * 100.0::double / count(*), 6), "
                     f"count(DISTINCT {c}) + max(({c} IS NULL)::int), {lengths} FROM {source}")
    names = "(column_name, dtype, null_count, null_percent, n_unique, min_len, max_len, avg_len)"
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) t{names}"


def shown(df):
    return df.withColumnRenamed("column", "column_name").withColumns({"null_percent": r("null_percent"), "avg_len": r("avg_len")})


APPLICANT_TYPES = {c: {"ib_data_criacao": "timestamp", "ib_data_atualizacao": "timestamp", "ip_data_nascimento": "date"}.get(c, "string") for c in APPLICANTS}
DOCUMENT_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


@query("profile_qualitative", "A7,A8,A9,T2", f"WITH {CURATED_SQL} {sql_qualitative('applicants', APPLICANT_TYPES)}")
def _(spark, sf):
    return shown(profile.qualitative_profile(applicants(spark, sf)))


@query("profile_documents", "A7,A8,A9", sql_qualitative("documents", DOCUMENT_TYPES))
def _(spark, sf):
    return shown(profile.qualitative_profile(table(spark, sf, "documents")))


@query("worst_columns", "T2", f"""
    WITH {CURATED_SQL}, p AS ({sql_qualitative('applicants', APPLICANT_TYPES)})
    SELECT column_name, null_percent FROM p ORDER BY null_percent DESC, column_name LIMIT 5""")
def _(spark, sf):
    df = shown(profile.qualitative_profile(applicants(spark, sf)))
    return df.orderBy(F.desc("null_percent"), "column_name").limit(5).select("column_name", "null_percent")


@query("profile_predicates", "P16", f"""
    WITH p AS ({sql_qualitative('documents', DOCUMENT_TYPES)})
    SELECT 'text' AS kind, column_name FROM p WHERE avg_len > 40 UNION ALL SELECT 'few', column_name FROM p WHERE n_unique > 1 AND n_unique <= 10
    UNION ALL SELECT 'selection', column_name FROM p WHERE n_unique <= 100""")
def _(spark, sf):
    rows = profile.qualitative_profile(table(spark, sf, "documents"))
    parts = {"text": profile.free_text_columns(rows, 40), "few": profile.selection_columns(rows, 1, 10),
             "selection": profile.selection_columns(rows)}
    out = None
    for kind, part in parts.items():
        part = part.select(F.lit(kind).alias("kind"), F.col("column").alias("column_name"))
        out = part if out is None else out.unionAll(part)
    return out


def sql_numeric(source: str, columns: list[str]) -> str:
    parts = []
    for c in columns:
        x = f"{c}::double"
        moments = f"avg({x}) AS m, count({c}) AS n"
        parts.append(f"""
        SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(DISTINCT {c}) + max(({c} IS NULL)::int) AS n_unique,
          round(avg({x}), 4) AS mean, round(stddev_samp({x}), 4) AS std, min({x}) AS min, round(any_value(q1), 6) AS q25,
          round(quantile_cont({x}, 0.5), 6) AS median, round(any_value(q3), 6) AS q75, max({x}) AS max, round(any_value(q3 - q1), 6) AS iqr,
          count(*) FILTER ({x} < q1 - 1.5 * (q3 - q1) OR {x} > q3 + 1.5 * (q3 - q1)) AS outlier_count,
          round((sum(pow({x} - m, 3)) / any_value(n)) / pow(sum(pow({x} - m, 2)) / any_value(n), 1.5), 4) AS skewness
        FROM {source}, (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3 FROM {source}), (SELECT {moments} FROM {source})""")
    return " UNION ALL ".join(parts)


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("profile_quantitative", "A10", sql_numeric("lineitem", NUMBERS))
def _(spark, sf):
    df = profile.numeric_profile(over_all_cores(table(spark, sf, "lineitem")), NUMBERS)
    return df.select(F.col("column").alias("column_name"), "null_count", "n_unique", r("mean", 4), r("std", 4), "min", r("q25"),
                     r("median"), r("q75"), "max", r("iqr"), "outlier_count", r("skewness", 4))


@query("profile_event_values", "A10,F6", sql_numeric("events", ["value", "user_id"]))
def _(spark, sf):
    df = profile.numeric_profile(table(spark, sf, "events"), ["value", "user_id"])
    return df.select(F.col("column").alias("column_name"), "null_count", "n_unique", r("mean", 4), r("std", 4), "min", r("q25"),
                     r("median"), r("q75"), "max", r("iqr"), "outlier_count", r("skewness", 4))


@query("exact_quantiles", "A10,A14", """
    SELECT c_mktsegment, round(quantile_cont(c_acctbal, 0.1), 6) AS p10, round(quantile_cont(c_acctbal, 0.5), 6) AS p50,
      round(quantile_cont(c_acctbal, 0.99), 6) AS p99 FROM customer GROUP BY 1""")
def _(spark, sf):
    df = ordered.quantiles(table(spark, sf, "customer"), "c_acctbal", {"p10": 0.1, "p50": 0.5, "p99": 0.99}, ["c_mktsegment"])
    return df.select("c_mktsegment", r("p10"), r("p50"), r("p99"))


@query("conditional_distinct", "A11", """
    SELECT count(DISTINCT o_custkey) FILTER (o_orderstatus = 'F') AS finished, count(DISTINCT o_custkey) FILTER (o_orderstatus <> 'F') AS others FROM orders""")
def _(spark, sf):
    return profile.distinct_when(table(spark, sf, "orders"), "o_custkey",
                                 {"finished": F.col("o_orderstatus") == "F", "others": F.col("o_orderstatus") != "F"})


@query("duplicates", "A12,Q2", """
    SELECT coalesce(sum(n), 0)::bigint AS n_rows FROM (SELECT count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)""")
def _(spark, sf):
    return quality.count_duplicates(table(spark, sf, "documents"), ["text"])


@query("duplicates_composite", "A12,Q2", """
    SELECT 'duplicate' AS rule, 'user_id,event_type' AS column_name, sum(n)::bigint AS n_rows
    FROM (SELECT count(*) AS n FROM events GROUP BY user_id, event_type HAVING count(*) > 1)""")
def _(spark, sf):
    return quality.check_duplicates(table(spark, sf, "events"), ["user_id", "event_type"]).select(
        "rule", F.col("column").alias("column_name"), "n_rows")


@query("empty_percent", "A13", f"""
    WITH {CURATED_SQL}, s AS (SELECT count(*) AS n, count(*) FILTER (ib_objetivo_profissional = '') AS a, count(*) FILTER (ip_pcd = '') AS b,
      count(*) FILTER (ip_url_linkedin = '') AS c, count(*) FILTER (ip_certificacoes = '') AS d FROM applicants)
    SELECT * FROM (SELECT unnest(['ib_objetivo_profissional', 'ip_pcd', 'ip_url_linkedin', 'ip_certificacoes']) AS column_name,
      unnest([a, b, c, d]) AS n_empty, round(unnest([a, b, c, d]) * 100.0::double / n, 4) AS empty_percent FROM s) WHERE empty_percent > 20""")
def _(spark, sf):
    return profile.empty_share(applicants(spark, sf)).select(
        F.col("column").alias("column_name"), "n_empty", r("empty_percent", 4))


@query("quantile_cap", "A14", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice <= (SELECT quantile_cont(o_totalprice, 0.85) FROM orders)""")
def _(spark, sf):
    return profile.cap_at_quantile(table(spark, sf, "orders"), "o_totalprice").select("o_orderkey", "o_totalprice")


@query("distinct_values", "A15", """
    SELECT DISTINCT l_returnflag, l_linestatus, (SELECT count(*) FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)) AS n_pairs FROM lineitem""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    n_pairs = li.select("l_partkey", "l_suppkey").distinct().agg(F.count("*")).scalar()
    return li.select("l_returnflag", "l_linestatus").distinct().withColumn("n_pairs", n_pairs)


@query("distinct_list_items", "A16", "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()


@query("histogram", "A19", """
    WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
    SELECT least(floor((value - lo) / ((hi - lo) / 30)), 29)::int AS bin, round(any_value(lo) + least(floor((value - lo) / ((hi - lo) / 30)), 29) * any_value((hi - lo) / 30), 6) AS bin_start,
      count(*) AS n_rows FROM events, b WHERE value IS NOT NULL GROUP BY least(floor((value - lo) / ((hi - lo) / 30)), 29)""")
def _(spark, sf):
    return profile.histogram(table(spark, sf, "events"), "value").withColumn("bin_start", r("bin_start"))


@query("running_totals", "L6,D1", """
    SELECT o_orderstatus, o_totalprice, sum(count(*)) OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice)::bigint AS n_upto,
      sum(count(*)) OVER (PARTITION BY o_orderstatus)::bigint AS n_total, lead(o_totalprice) OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) AS next_value
    FROM orders GROUP BY 1, 2""")
def _(spark, sf):
    df = table(spark, sf, "orders").withColumn("n", F.lit(1))
    return ordered.running_totals(df, "o_totalprice", ["n"], ["o_orderstatus"]).drop("n")


# ------------------------------------------------------------------------------ sorts, top-k
@query("first_rows", "T3", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(1000)


@query("score_ranking", "T1", """
    SELECT c_custkey::varchar AS codigo_candidato, round(c_acctbal / 7, 3) AS score FROM customer ORDER BY score DESC""")
def _(spark, sf):
    df = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("codigo_candidato"), (F.col("c_acctbal") / 7).alias("raw"))
    return scoring.ranking(df, {"codigo_candidato": "codigo_candidato", "score": "raw"}, "score")


@query("tier_rank", "W1", """
    SELECT c_mktsegment, (row_number() OVER (ORDER BY avg(c_acctbal)) - 1)::int AS tier FROM customer GROUP BY 1""")
def _(spark, sf):
    centers = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.avg("c_acctbal").alias("center"))
    return scoring.rank_centers(centers).select("c_mktsegment", "tier")


# ------------------------------------------------------------------------------------ quality
def issue_rows(df):
    return df.withColumnRenamed("column", "column_name").select("rule", "column_name", "n_rows")


@query("quality_required", "Q1", f"""
    WITH {CURATED_SQL} SELECT 'required' AS rule, unnest(['ib_telefone', 'ib_email', 'ip_endereco', 'absent']) AS column_name,
      unnest([count(*) FILTER (coalesce(trim(ib_telefone), '') IN ('', '-')), count(*) FILTER (coalesce(trim(ib_email), '') IN ('', '-')),
        count(*) FILTER (coalesce(trim(ip_endereco), '') IN ('', '-')), NULL]) AS n_rows FROM applicants""")
def _(spark, sf):
    return issue_rows(quality.check_required(applicants(spark, sf), ["ib_telefone", "ib_email", "ip_endereco", "codigo_candidato", "absent"]))


@query("quality_domain", "Q3", """
    SELECT 'domain' AS rule, event_type AS value, count(*) AS n_rows FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY event_type""")
def _(spark, sf):
    return quality.check_domain(table(spark, sf, "events"), "event_type", ["click", "view"]).select(
        "rule", F.col("detail").alias("value"), "n_rows")


@query("quality_regex", "Q4", r"""
    SELECT 'regex' AS rule, 'url' AS column_name, count(*) AS n_rows FROM pages WHERE NOT regexp_matches(url, '^(?:https://|ftp:)')""")
def _(spark, sf):
    return issue_rows(quality.check_pattern(table(spark, sf, "pages"), "url", "https://|ftp:"))


@query("quality_range", "Q5", """
    SELECT 'range' AS rule, 'l_discount' AS column_name, unnest([count(*) FILTER (l_discount < 0.02), count(*) FILTER (l_discount > 0.08)]) AS n_rows FROM lineitem""")
def _(spark, sf):
    return issue_rows(quality.check_range(table(spark, sf, "lineitem"), "l_discount", 0.02, 0.08))


@query("quality_cardinality", "Q6", """
    SELECT 'cardinality' AS rule, 'l_extendedprice' AS column_name, count(DISTINCT l_extendedprice) AS n_rows FROM lineitem""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    return issue_rows(quality.check_cardinality(li, "l_extendedprice").unionAll(quality.check_cardinality(li, "l_tax")))


@query("quality_schema", "Q7", """
    SELECT o_orderkey::varchar AS id, 'o_note' AS column_name, 'null in a required field' AS error FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT NULL, 'o_custkey', 'expected string, found bigint' UNION ALL SELECT NULL, 'o_missing', 'missing column'""")
def _(spark, sf):
    expected = T.StructType([T.StructField("o_orderkey", T.LongType(), False), T.StructField("o_custkey", T.StringType()),
                             T.StructField("o_note", T.StringType(), False), T.StructField("o_missing", T.StringType())])
    df = table(spark, sf, "orders").withColumn("o_note", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    return quality.schema_errors(df, expected, "o_orderkey").withColumnRenamed("column", "column_name")


@query("quality_combined", "Q1,Q2,Q9", f"""
    WITH {CURATED_SQL} SELECT 'required' AS rule, 'ib_data_requicisao' AS column_name, count(*) AS n_rows FROM jobs WHERE ib_data_requicisao IS NULL
    UNION ALL SELECT 'duplicate', 'ib_titulo_vaga', sum(n)::bigint FROM (SELECT count(*) AS n FROM jobs GROUP BY ib_titulo_vaga HAVING count(*) > 1)""")
def _(spark, sf):
    df = jobs(spark, sf)
    return issue_rows(quality.check_required(df, ["codigo_vaga", "ib_data_requicisao"]).unionAll(
        quality.check_duplicates(df, ["ib_titulo_vaga"])))
