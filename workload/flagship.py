"""The flagship query: orders ranked as job openings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.functions import matching, temporal, text
from rosterlake.operators.joins import join_renamed, latest_value
from rosterlake.operators.scoring import ranking

from .base import query, table

SQL = """
    WITH j AS (
      SELECT o_orderkey, o_custkey, n_name, c_acctbal,
        CASE WHEN regexp_matches(o_orderpriority, 'HIGH') THEN 'ALTA' WHEN regexp_matches(o_orderpriority, 'MEDIUM') THEN 'MEDIA'
             WHEN regexp_matches(o_orderpriority, 'LOW') THEN 'BAIXA' ELSE 'DESCONHECIDO' END AS priority,
        greatest(date_sub('day', o_orderdate, (SELECT max(o_orderdate) FROM orders)), 0) AS days_open
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
    SELECT o_orderkey::varchar AS codigo_vaga, o_custkey::varchar AS codigo_candidato, n_name AS local, priority AS prioridade,
      days_open AS dias, round(CASE priority WHEN 'ALTA' THEN 0.9 WHEN 'BAIXA' THEN 0.2 ELSE 0.5 END * 0.6
        + 0.4 / (1 + days_open / 365.0::double), 3) AS score
    FROM j"""


@query("candidate_ranking", "J1,F7,F9,F12,J8,M11,T1", SQL)
def candidate_ranking(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer, nation = (table(spark, folder, t) for t in ("orders", "customer", "nation"))
    df = join_renamed(join_renamed(orders, customer, "o_custkey", "c_custkey"), nation, "c_nationkey", "n_nationkey")
    mood = F.when(F.col("priority") == "ALTA", 1).when(F.col("priority") == "BAIXA", -1).otherwise(0)
    df = (df.withColumn("priority", text.priority_class(F.col("o_orderpriority")))
          .withColumn("days_open", temporal.days_or_zero(latest_value(orders, "o_orderdate"), F.col("o_orderdate")))
          .withColumn("codigo_vaga", F.col("o_orderkey").cast("string"))
          .withColumn("codigo_candidato", F.col("o_custkey").cast("string"))
          .withColumn("raw_score", matching.behaviour_score(mood) * 0.6 + 0.4 / (1 + F.col("days_open") / 365.0)))
    ranked = ranking(df.select("codigo_vaga", "codigo_candidato", "n_name", "priority", "days_open", "raw_score"),
                     {"codigo_vaga": "codigo_vaga", "codigo_candidato": "codigo_candidato", "score": "raw_score",
                      "local": "n_name", "prioridade": "priority", "dias": "days_open"}, "score")
    return ranked
