"""The curation pass: what rows need twice is computed once, and no generated method grows with the columns."""

from pyspark.sql import functions as F

from rosterlake.functions import text
from rosterlake.operators import flatten
from rosterlake.plans import curate
from rosterlake.session import small_methods
from rosterlake.sources import schemas

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_counts_share_the_columns_of_the_copy(spark):
    from test_operators import prospects_raw
    flat = flatten.flatten_nested(prospects_raw(spark, ["1"]))
    counts = curate.staged_counts(flat, curate.PROSPECTS)
    assert {"changed:codigo_vaga", "changed:p_codigo", "invalid", "rows"} <= set(counts)
    assert not [name for name, c in counts.items() if "regexp" in str(c)]
    limit = spark.conf.get(LIMIT)
    # "a ! b" cleans to "A  B", which a second cleaning would change again
    out = curate.curate(prospects_raw(spark, ["a ! b", " x y ", "7", " - ", " ", None, "~"]), curate.PROSPECTS)
    assert sorted(r.p_codigo for r in out.collect()) == ["", "7", "A  B", "X Y"]
    assert set(out.columns) == set(flat.columns) and spark.conf.get(LIMIT) == limit


def test_keys_are_judged_as_by_trims(spark):
    values = [None, "", " ", "-", " - ", "--", "- -", "0", "~", "!", "/", "a", " a", "é", " ", " -", "\x7f", "\x85", "-a", "\U0001f600", "{", ":"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    left = text.strip_space(F.btrim(text.strip_space(F.col("v")), F.lit("-")))
    plain = F.coalesce(left == "", F.lit(True)), F.coalesce(text.strip_space(F.col("v")).isin("", "-", " "), F.lit(True))
    rows = df.select("v", text.is_blank_or_dashes(F.col("v")), plain[0], text.is_missing_value(F.col("v")), plain[1], text.begins_plain(F.col("v"))).collect()
    assert all(r[1] == r[2] and r[3] == r[4] for r in rows) and sum(bool(r[5]) for r in rows) == 5


def test_many_columns_stay_small_methods(spark):
    fields = spark.createDataFrame([("a ! b",) * 45], schemas._strings([f"c{i}" for i in range(45)]))
    with small_methods(spark):
        assert spark.conf.get(LIMIT) == "8000"
        assert set(flatten.normalize(fields).first()) == {"A  B"}
