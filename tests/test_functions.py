import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.functions import matching, temporal, text, vectors
from rosterlake.functions.naming import initials, tidy_name
from rosterlake.operators import location


def values(spark, column, rows, schema="x string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.select(column.alias("out")).collect()]


def test_names():
    assert initials("informacoes_basicas") == "ib"
    assert initials("formacao_e_idiomas") == "fei"
    assert initials("perfilVaga") == "pv"
    assert initials("a-b c") == "abc"
    assert tidy_name("pv_nivel profissional") == "pv_nivel_profissional"
    assert tidy_name(" Ação (R$)__x ") == "acao_r_x"


def test_clean_text(spark):
    rows = ["  ação!  teste – ok ", "a \tb", None, "x ! y", "plain TEXT 1", "", "50% @a.b,c-d:e/f", "double  blank"]
    assert values(spark, text.clean_text(F.col("x")), rows) == [
        "AÇÃO TESTE  OK", "A B", None, "X  Y", "PLAIN TEXT 1", "", "50 @A.B,C-D:E/F", "DOUBLE BLANK"]


def test_dates(spark):
    rows = ["04-05-2021", "31-02-2021", "00-00-0000", "", None, "2021-05-04"]
    assert values(spark, temporal.parse_date(F.col("x")), rows) == [dt.date(2021, 5, 4)] + [None] * 5
    assert values(spark, temporal.parse_datetime(F.col("x")), ["04-05-2021 10:11:12", "04-05-2021"]) == [
        dt.datetime(2021, 5, 4, 10, 11, 12), None]


def test_days(spark):
    pair = "a timestamp, b timestamp"
    d = dt.datetime
    rows = [(d(2020, 1, 3), d(2020, 1, 1)), (d(2020, 1, 1), d(2020, 1, 3)), (None, d(2020, 1, 1)),
            (d(2020, 1, 2, 1), d(2020, 1, 1, 2))]
    a, b = F.col("a"), F.col("b")
    assert values(spark, temporal.days_or_zero(a, b), rows, pair) == [2, 0, 0, 0]
    assert values(spark, temporal.days_or_zero(a, b, True), rows, pair) == [2, 2, 0, 0]
    assert values(spark, temporal.calendar_days(a, b), rows, pair) == [2, -2, -1, 1]
    assert values(spark, temporal.flag_or_minus_one(a > b, a, b), rows, pair) == [1, 0, -1, 1]
    assert values(spark, temporal.years_or_zero(a, b), rows, pair)[2] == 0.0


def test_priority_and_lists(spark):
    rows = [" alta: urgente", "Média", "baixa prioridade", None, "5"]
    assert values(spark, text.priority_class(F.col("x")), rows) == ["ALTA", "MEDIA", "BAIXA", "DESCONHECIDO", "DESCONHECIDO"]
    out = values(spark, text.split_clean_list(F.col("x"), ","), ["CLT Full, PJ/Autônomo ,", " , ", None])
    assert out == [["CLT FULL", "PJ/AUTÔNOMO"], ["DESCONHECIDO"], ["DESCONHECIDO"]]


def test_blank_rules(spark):
    rows = [None, "", "  ", "-", "--", " - ", "- -", " ", "a-", "x"]
    assert values(spark, text.is_blank_or_dashes(F.col("x")), rows) == [True] * 8 + [False] * 2
    assert values(spark, text.is_missing_value(F.col("x")), rows) == [True, True, True, True, False, True, False, True, False, False]


def test_money(spark):
    assert values(spark, text.parse_money(F.col("x")), ["R$ 1.234,56", "", None, "a", "1,2,3"]) == [1234.56, None, None, None, None]


def test_sentiment(spark):
    rows = ["Não responde", "NÃO ATENDE", "Interessado, mas desistiu", None, "nada", "AVANCOU"]
    assert values(spark, text.sentiment(F.col("x")), rows) == [-1, -1, 1, 0, 0, 1]
    assert values(spark, text.sentiment(F.col("x"), text.SENTIMENT_SCORING), ["NÃO TEM PERFIL", "Gostei"]) == [-1, 1]


def test_recruiters_ignore_case(spark):
    rows = ["MÔNICA", "Ana", "BIA", None]
    assert values(spark, text.keep_listed(F.col("x"), text.COMMON_RECRUITERS), rows) == ["MÔNICA", "Ana", "Outros", "Outros"]


def test_answers(spark):
    schema = T.StructType.fromDDL("a int")
    rows = ['```json\n{"a": 1}\n```', '{"a": 2}', "broken", "{}", "", '```json\n{"a": 3}', None]
    out = values(spark, text.parse_answer(F.col("x"), schema).a, rows)
    assert out == [1, 2, None, None, None, None, None]


def test_score_row_by_hand(spark):
    job = {"professional": F.lit("PLENO"), "academic": F.lit("ENSINO SUPERIOR COMPLETO"), "english": F.lit("AVANÇADO")}
    candidate = {"professional": F.lit("Sênior"), "academic": F.lit("Pós-graduação"), "english": F.lit("AVANÇADO")}
    out = spark.range(1).select(matching.structured_match(job, candidate)).first()[0]
    assert out == pytest.approx(1.0)
    pairs = [(0.0, 0.0, 1.0), (2.0, 0.0, 0.0), (4.0, 1.0, 0.25), (1.0, 3.0, 1.0)]
    for j, c, expected in pairs:
        assert spark.range(1).select(matching.requirement_ratio(F.lit(j), F.lit(c))).first()[0] == expected


def test_list_coverage(spark):
    rows = [(["a", "b"], ["a", "a", "c"]), (["a"], []), ([], ["a"]), (["a"], None)]
    out = values(spark, matching.list_coverage(F.col("h"), F.col("n")), rows, "h array<string>, n array<string>")
    assert out == [pytest.approx(1 / 3), 1.0, 0.0, 1.0]


def reference_mean_best(need, have, threshold, empty):
    if not need or not have:
        return empty
    a, b = np.array(need), np.array(have)
    sims = (a @ b.T) / np.linalg.norm(a, axis=1)[:, None] / np.linalg.norm(b, axis=1)[None]
    best = sims.max(axis=1)
    return float((best if threshold is None else np.where(best >= threshold, best, 0)).mean())


def test_vector_kernels(spark):
    rng = np.random.default_rng(3)
    rows = [(rng.normal(size=(int(i), 5)).tolist(), rng.normal(size=(int(j), 5)).tolist()) for i, j in rng.integers(0, 7, (200, 2))]
    rows += [(None, [[1.0] * 5]), ([[1.0] * 5], None)]
    df = spark.createDataFrame(rows, "need array<array<float>>, have array<array<float>>")
    for threshold, empty in ((0.5, 0.0), (None, 0.5)):
        out = df.select("need", "have", vectors.mean_best_cosine(F.col("need"), F.col("have"), threshold, empty).alias("s")).collect()
        for r in out:
            assert r.s == pytest.approx(reference_mean_best(r.need, r.have, threshold, empty), abs=1e-9)
    flat = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [2.0, 2.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 1.0])],
                                 "a array<float>, b array<float>")
    assert [r[0] for r in flat.select(vectors.cosine(F.col("a"), F.col("b"))).collect()] == [0.0, pytest.approx(1.0), None, None]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        left = 0
        for j, y in enumerate(b):
            up = row[j + 1]
            row[j + 1] = left + 1 if x == y else max(up, row[j])
            left = up
    return row[-1]


def brute_ratio(a, b):
    a, b = (a, b) if len(a) <= len(b) else (b, a)

    def best(s, t):
        m, n = len(s), len(t)
        windows = [t[:i] for i in range(1, m)] + [t[i:i + m] for i in range(n - m + 1)] + [t[i:] for i in range(n - m + 1, n)]
        return max(200 * lcs(s, w) / (m + len(w)) for w in windows)

    return max(best(a, b), best(b, a)) if len(a) == len(b) else best(a, b)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("abcé ", min_size=1, max_size=12), st.text("abcé ", min_size=1, max_size=25)), min_size=1, max_size=20))
def test_partial_ratio(pairs):
    assert location.partial_ratios(pairs) == pytest.approx([brute_ratio(*p) for p in pairs])


def test_partial_ratio_long_texts():
    draw = random.Random(2)
    pairs = [("".join(draw.choices("abcd", k=70 + i)), "".join(draw.choices("abcd", k=90))) for i in range(4)]
    assert location.partial_ratios(pairs) == pytest.approx([brute_ratio(*p) for p in pairs])


def test_same_place(spark):
    rows = [("São Paulo", None, "SÃO PAULO, SP", None), ("Recife", "", "Porto Alegre", None), (None, None, "X", "Y"),
            ("Sao Paolo", None, "São Paulo", ""), ("", "", "", "")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    out = location.with_same_place(df, ["a", "b"], ["c", "d"], 70).select("ind_mesma_localidade").collect()
    assert [r[0] for r in out] == [True, False, False, brute_ratio("SAO PAOLO", "SÃO PAULO") >= 70, False]
