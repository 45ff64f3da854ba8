"""Training rows joined in parts with few columns against the plain join."""

import datetime

import pytest
from pyspark.sql import functions as F

from rosterlake.operators import features, joins, training
from rosterlake.plans import training as plan
from workload import base

KEYS = ["codigo_vaga", "codigo_candidato", "linha"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path, day = str(tmp_path_factory.mktemp("rows")), datetime.date(1998, 3, 1)
    customers = [(i, f"C{i}", i % 25, float(100 * i - 900), ["BUILDING", "MACHINERY"][i % 2]) for i in range(30)] + [(None, "C", 1, 1.0, "BUILDING")]
    orders = [(i, i % 17, "FOP"[i % 3], float(i), day + datetime.timedelta(i), "1-URGENT") for i in range(60)]
    lines = [(i % 70 if i % 23 else None, i % 40, i % 11, 1 + i % 7, "ARN"[i % 3], "OF"[i % 2], day + datetime.timedelta(i % 50)) for i in range(400)]
    for name, rows, shape in (
            ("customer", customers, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
            ("orders", orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"),
            ("lineitem", lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string, l_linestatus string, l_shipdate date")):
        spark.createDataFrame(rows, shape).write.parquet(f"{path}/{name}.parquet")
    return path


def entities(spark, folder):
    return [f(spark, folder) for f in (base.prospects, base.applicants, base.jobs)]


@pytest.mark.parametrize("part_bytes", [1, 1 << 40])
def test_engagement_rows(spark, folder, monkeypatch, part_bytes):
    monkeypatch.setattr(joins, "PART_BYTES", part_bytes)
    now = F.lit("2002-01-01").cast("date")
    mine = plan.engagement_rows(spark, *entities(spark, folder), now, KEYS)
    assert set(mine.columns) == {*KEYS, "engajado", "p_recrutador", *training.ENGAGEMENT_NUMERIC, *training.BASELINE_CATEGORICAL}
    plain = plan.engagement_table(features.build_features(joins.join_entities(*entities(spark, folder))), now).select(*mine.columns)
    assert mine.count() > 100 and mine.exceptAll(plain).count() == plain.exceptAll(mine).count() == 0
    assert mine.dtypes == plain.dtypes


@pytest.mark.parametrize("part_bytes", [1, 1 << 40])
def test_behaviour_rows(spark, folder, monkeypatch, part_bytes):
    monkeypatch.setattr(joins, "PART_BYTES", part_bytes)
    mine = plan.behaviour_rows(spark, *entities(spark, folder), KEYS)
    plain = features.build_features(joins.join_entities(*entities(spark, folder)))
    assert len(mine.columns) == 8 and mine.exceptAll(plain.select(*mine.columns)).count() == plain.select(*mine.columns).exceptAll(mine).count() == 0
    columns = ["engajado", *training.EXPANDED_NUMERIC, *training.BASELINE_CATEGORICAL]
    assert plan.expanded_table(mine).select(columns).exceptAll(plan.expanded_table(plain).select(columns)).count() == 0
