"""Text, list, date and number expressions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.functions import matching, temporal, text
from rosterlake.operators import features
from rosterlake.operators.extraction import candidate_prompt, job_prompt
from rosterlake.operators.flatten import normalize
from rosterlake.operators.joins import latest_value, prefix_columns

from .base import (CURATED_SQL, JOINED_SQL, SPACE, applicants, joined, jobs, prospects, query, r, sql_clean, sql_days,
                   sql_filled, sql_strip, sql_upper, table)

STRINGS = T.ArrayType(T.StringType())


@query("clean_text", "F1", f"SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query("clean_text_all", "F2", f"""
    SELECT conv_id, turn, {sql_clean('role')} AS role, {sql_clean('text')} AS text,
           try_strptime('0' || (turn % 9 + 1) || '-13-2020', '%d-%m-%Y')::date AS bad_date,
           make_date(2020, 2, (turn % 9 + 1)::int) AS day,
           CASE WHEN turn % 2 = 0 THEN NULL ELSE make_timestamp(2021, 3, 1, 4, (turn % 9 + 1)::int, 6.0) END AS at
    FROM conversations""")
def _(spark, sf):
    n = F.concat(F.lit("0"), (F.col("turn") % 9 + 1).cast("string"))
    raw = table(spark, sf, "conversations").select(
        "conv_id", "turn", "role", "text", F.concat(n, F.lit("-13-2020")).alias("bad_date"),
        F.concat(F.lit(" "), n, F.lit("-02-2020!")).alias("day"),
        F.when(F.col("turn") % 2 == 0, "0000-00-00").otherwise(F.concat(F.lit("01-03-2021  04:"), n, F.lit(":06"))).alias("at"))
    return normalize(raw, dates=["bad_date", "day"], datetimes=["at"])


@query("parse_dates", "F3,F4", """
    WITH s AS (SELECT o_orderkey, o_orderdate,
      CASE o_orderkey % 6 WHEN 0 THEN '31-02-2021' WHEN 1 THEN '' WHEN 2 THEN '00-00-0000' WHEN 3 THEN NULL
           ELSE strftime(o_orderdate, '%d-%m-%Y') END AS d FROM orders)
    SELECT o_orderkey, try_strptime(d, '%d-%m-%Y')::date AS day,
           try_strptime(CASE WHEN length(d) = 10 THEN d || ' 10:20:30' ELSE d END, '%d-%m-%Y %H:%M:%S') AS at FROM s""")
def _(spark, sf):
    k = F.col("o_orderkey") % 6
    d = (F.when(k == 0, "31-02-2021").when(k == 1, "").when(k == 2, "00-00-0000").when(k == 3, None)
         .otherwise(F.date_format("o_orderdate", "dd-MM-yyyy")))
    stamp = F.when(F.length(d) == 10, F.concat(d, F.lit(" 10:20:30"))).otherwise(d)
    return table(spark, sf, "orders").select("o_orderkey", temporal.parse_date(d).alias("day"),
                                             temporal.parse_datetime(stamp).alias("at"))


@query("parse_slash_datetime", "F5", """
    SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE date_trunc('minute', ts) END AS at FROM events""")
def _(spark, sf):
    s = F.when(F.col("event_id") % 5 == 0, "99/99/2024").otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm"))
    return table(spark, sf, "events").select(
        "event_id", temporal.parse_datetime(s, temporal.SLASH_DATETIME_FORMAT).alias("at"))


@query("money_parse", "F6", """
    WITH s AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'R$ ' || replace(c_acctbal::varchar, '.', ',')
               WHEN 1 THEN 'a combinar' WHEN 2 THEN NULL ELSE replace(c_acctbal::varchar, '.', ',') || ',9' END AS m FROM customer)
    SELECT c_custkey, try_cast(regexp_replace(regexp_replace(m, '[^0-9,]', '', 'g'), ',', '.') AS DOUBLE) AS amount FROM s""")
def _(spark, sf):
    k, m = F.col("c_custkey") % 4, F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(","))
    raw = (F.when(k == 0, F.concat(F.lit("R$ "), m)).when(k == 1, "a combinar").when(k == 2, None)
           .otherwise(F.concat(m, F.lit(",9"))))
    return table(spark, sf, "customer").select("c_custkey", text.parse_money(raw).alias("amount"))


PRIORITY_SQL = """CASE WHEN regexp_matches(upper(trim(coalesce({0}, ''))), 'ALTA|HIGH|URGENTE|URGENCY') THEN 'ALTA'
    WHEN regexp_matches(upper(trim(coalesce({0}, ''))), 'MEDIA|MÉDIA|MEDIUM|INTERMEDIARIA|INTERMEDIÁRIA') THEN 'MEDIA'
    WHEN regexp_matches(upper(trim(coalesce({0}, ''))), 'BAIXA|LOW') THEN 'BAIXA' ELSE 'DESCONHECIDO' END"""


@query("priority_class", "F7", f"""
    SELECT o_orderkey, {PRIORITY_SQL.format('o_orderpriority')} AS priority FROM orders""")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", text.priority_class(F.col("o_orderpriority")).alias("priority"))


def sql_split(x: str, sep: str) -> str:
    base = sql_strip(f"regexp_replace(lower(coalesce({x}, '')), '{SPACE}+', ' ', 'g')")
    parts = f"[p for p in [{sql_upper('trim(q)')} for q in string_split({base}, '{sep}')] if p <> '']"
    return f"CASE WHEN len({parts}) = 0 THEN ['DESCONHECIDO'] ELSE {parts} END"


@query("split_list", "F8", f"""
    SELECT doc_id, array_to_string({sql_split("CASE WHEN doc_id % 9 = 0 THEN NULL ELSE text END", ",")}, '|') AS by_comma,
           array_to_string({sql_split("source", "-")}, '|') AS by_dash FROM documents""")
def _(spark, sf):
    body = F.when(F.col("doc_id") % 9 == 0, None).otherwise(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(text.split_clean_list(body, ","), "|").alias("by_comma"),
        F.array_join(text.split_clean_list(F.col("source"), "-"), "|").alias("by_dash"))


@query("split_distinct_items", "F8,A16", f"""
    WITH {CURATED_SQL} SELECT DISTINCT 'tipo' AS kind, unnest({sql_split('ib_tipo_contratacao', ',')}) AS item FROM jobs
    UNION ALL SELECT DISTINCT 'area', unnest({sql_split('pv_areas_atuacao', '-')}) FROM jobs""")
def _(spark, sf):
    lists = features.cleaned_lists(jobs(spark, sf), {"ib_tipo_contratacao": ",", "pv_areas_atuacao": "-"})
    parts = [lists.select(F.lit(kind).alias("kind"), F.explode(f"{c}_cleaned_list").alias("item")).distinct()
             for kind, c in (("tipo", "ib_tipo_contratacao"), ("area", "pv_areas_atuacao"))]
    return parts[0].unionAll(parts[1])


@query("temporal_features", "F9,F10,F11,F12,J8", f"""
    WITH {JOINED_SQL}, t AS (SELECT max(p_data_candidatura)::timestamp AS today FROM joined)
    SELECT codigo_vaga, codigo_candidato, linha,
      {sql_days('app_ib_data_criacao', 'p_data_candidatura', True)} AS tempo_entre_criacao_e_candidatura,
      {sql_days('p_data_candidatura', 'job_ib_data_inicial')} AS tempo_entre_job_inicial_e_candidatura,
      {sql_days('job_ib_limite_esperado_para_contratacao', 'job_ib_data_requicisao')} AS tempo_para_contratacao,
      {sql_days('app_ib_data_atualizacao', 'app_ib_data_criacao')} AS tempo_ultima_atualizacao_aplicacao,
      {sql_days('job_ib_data_final', 'job_ib_data_inicial')} AS tempo_vaga_aberta,
      coalesce((job_ib_data_final > today)::int, -1) AS vaga_em_aberto_no_momento,
      coalesce((p_data_candidatura < job_ib_data_inicial)::int, -1) AS candidatura_antes_da_abertura_oficial,
      {sql_days('today', 'job_ib_data_requicisao')} AS dias_desde_requisicao,
      coalesce((date_sub('day', job_ib_data_requicisao::timestamp, today) < 30)::int, -1) AS vaga_requisitada_recente
    FROM joined, t""")
def _(spark, sf):
    df = features.temporal_features(joined(spark, sf))
    return df.select("codigo_vaga", "codigo_candidato", "linha", "tempo_entre_criacao_e_candidatura",
                     "tempo_entre_job_inicial_e_candidatura", "tempo_para_contratacao",
                     "tempo_ultima_atualizacao_aplicacao", "tempo_vaga_aberta", "vaga_em_aberto_no_momento",
                     "candidatura_antes_da_abertura_oficial", "dias_desde_requisicao", "vaga_requisitada_recente")


@query("truncated_days", "F9", f"""
    SELECT event_id, {sql_days("ts", "timestamp '2024-01-10 12:30:00'")} AS days,
           {sql_days("ts", "timestamp '2024-01-10 12:30:00'", True)} AS abs_days FROM events""")
def _(spark, sf):
    at = F.lit("2024-01-10 12:30:00").cast("timestamp_ntz")
    return table(spark, sf, "events").select(
        "event_id", temporal.days_or_zero(F.col("ts"), at).alias("days"),
        temporal.days_or_zero(F.col("ts"), at, absolute=True).alias("abs_days"))


@query("candidate_age", "F13", f"""
    WITH {CURATED_SQL} SELECT codigo_candidato, round(greatest(coalesce(
      date_sub('day', ip_data_nascimento::timestamp, ib_data_criacao) / 365.25::double, -1), 0), 6) AS idade_candidato FROM applicants""")
def _(spark, sf):
    df = applicants(spark, sf).withColumnsRenamed({"ib_data_criacao": "app_ib_data_criacao", "ip_data_nascimento": "app_ip_data_nascimento"})
    return features.candidate_age(df).select("codigo_candidato", r("idade_candidato"))


@query("calendar_days", "F14,F23", f"""
    WITH {JOINED_SQL}
    SELECT codigo_vaga, codigo_candidato, linha,
      coalesce(datediff('day', job_ib_data_requicisao, p_data_candidatura), -1) AS dias_para_se_candidatar,
      coalesce(datediff('day', p_ultima_atualizacao, date '2002-01-01'), -1) AS dias_desde_ultima_atualizacao,
      coalesce(datediff('day', p_data_candidatura, p_ultima_atualizacao), -1) AS dias_no_processo,
      {sql_filled('app_ib_objetivo_profissional')}::int AS tem_objetivo_profissional,
      {sql_filled('app_ip_remuneracao')}::int AS tem_remuneracao_definida,
      coalesce((p_data_candidatura < job_ib_data_inicial)::int, -1) AS candidatura_proativa
    FROM joined""")
def _(spark, sf):
    now = F.lit("2002-01-01").cast("date")
    df = features.engagement_columns(features.temporal_features(joined(spark, sf)), now)
    return df.select("codigo_vaga", "codigo_candidato", "linha", "dias_para_se_candidatar", "dias_desde_ultima_atualizacao",
                     "dias_no_processo", "tem_objetivo_profissional", "tem_remuneracao_definida", "candidatura_proativa")


@query("benefits_and_pcd", "F15,F16", f"""
    WITH {JOINED_SQL} SELECT codigo_vaga, codigo_candidato, linha,
      {sql_filled('job_b_valor_venda')} OR {sql_filled('job_b_valor_compra_1')} OR {sql_filled('job_b_valor_compra_2')} AS job_ind_beneficios_declarados,
      coalesce(job_pv_vaga_especifica_para_pcd = 'SIM', false) AND {sql_filled('app_ip_pcd')} AS match_pcd FROM joined""")
def _(spark, sf):
    df = features.disability_match(features.benefits_declared(joined(spark, sf)))
    return df.select("codigo_vaga", "codigo_candidato", "linha", "job_ind_beneficios_declarados", "match_pcd")


@query("completeness", "F17,F18,A17", f"""
    WITH {JOINED_SQL} SELECT codigo_vaga, codigo_candidato, linha,
      round(((app_ib_objetivo_profissional IS NOT NULL)::int + (app_ib_local IS NOT NULL)::int + (app_ip_sexo IS NOT NULL)::int
       + (app_ip_estado_civil IS NOT NULL)::int + (app_ip_pcd IS NOT NULL)::int + (app_ip_remuneracao IS NOT NULL)::int
       + (app_fei_nivel_academico IS NOT NULL)::int + (app_fei_nivel_ingles IS NOT NULL)::int) / 8.0::double, 6) AS percentual_perfil_completo,
      coalesce(length(app_cv_pt), 0) AS tamanho_cv FROM joined""")
def _(spark, sf):
    # profiles of candidates before the joins, so that no text of theirs is on a row of a prospect
    people = features.profile_columns(prefix_columns(applicants(spark, sf), "app_", ["codigo_candidato"])).select(
        "codigo_candidato", "percentual_perfil_completo", "tamanho_cv")
    pairs = prospects(spark, sf).withColumnRenamed("p_codigo", "codigo_candidato").join(people, "codigo_candidato")
    return pairs.join(jobs(spark, sf).select("codigo_vaga"), "codigo_vaga").select(
        "codigo_vaga", "codigo_candidato", "linha", r("percentual_perfil_completo"), "tamanho_cv")


def sql_sentiment(column: str, words: dict) -> str:
    def hit(kind):
        return f"coalesce(regexp_matches({column}, '{words[kind]}', 'i'), false)"
    return f"CASE WHEN {hit('positive')} THEN 1 WHEN {hit('negative')} THEN -1 ELSE 0 END"


@query("sentiment_training", "F19", f"""
    WITH {CURATED_SQL} SELECT codigo_vaga, linha, {sql_sentiment('p_comentario', text.SENTIMENT_TRAINING)} AS score FROM prospects""")
def _(spark, sf):
    return prospects(spark, sf).select("codigo_vaga", "linha", text.sentiment(F.col("p_comentario")).alias("score"))


DOC_WORDS = {"positive": r"the|não|çã", "negative": r"\bder\b|ruim"}


@query("sentiment_documents", "F19,M11", f"""
    SELECT doc_id, {sql_sentiment('text', DOC_WORDS)} AS score,
           CASE {sql_sentiment('text', DOC_WORDS)} WHEN 1 THEN 0.9 WHEN -1 THEN 0.2 ELSE 0.5 END::double AS behaviour FROM documents""")
def _(spark, sf):
    score = text.sentiment(F.col("text"), DOC_WORDS)
    return table(spark, sf, "documents").select("doc_id", score.alias("score"), matching.behaviour_score(score).alias("behaviour"))


@query("fixed_recruiters", "F21", f"""
    WITH {CURATED_SQL} SELECT codigo_vaga, linha, CASE WHEN p_recrutador = 'ANA' THEN 'ANA' ELSE 'Outros' END AS recruiter FROM prospects""")
def _(spark, sf):
    return prospects(spark, sf).select(
        "codigo_vaga", "linha", text.keep_listed(F.col("p_recrutador"), text.COMMON_RECRUITERS).alias("recruiter"))


@query("presence_flags", "P10,F23", f"""
    WITH {CURATED_SQL} SELECT codigo_candidato, {sql_filled('ib_telefone')} AS ind_app_telefone, {sql_filled('ib_email')} AS ind_app_email,
      {sql_filled('ip_url_linkedin')} AS ind_app_linkedin, {sql_filled('ip_endereco')} AS ind_app_endereco,
      {sql_filled('ip_facebook')} AS ind_app_facebook, {sql_filled('ip_remuneracao')}::int AS has_pay FROM applicants""")
def _(spark, sf):
    flags = {n: c.removeprefix("app_") for n, c in features.CONTACT_FLAGS.items()}
    df = features.presence_flags(applicants(spark, sf), flags)
    return df.select("codigo_candidato", *flags, text.filled_flag(F.col("ip_remuneracao")).alias("has_pay"))


@query("concat_text", "F24", f"""
    WITH {CURATED_SQL} SELECT codigo_candidato, coalesce(ib_objetivo_profissional, '') || ' ' || coalesce(cv_pt, '') AS both_texts FROM applicants""")
def _(spark, sf):
    return applicants(spark, sf).select(
        "codigo_candidato", text.join_texts(F.col("ib_objetivo_profissional"), F.col("cv_pt")).alias("both_texts"))


@query("list_text", "F25,F30,F31", """
    SELECT p_partkey, array_to_string(list_concat(string_split(p_name, ' '), [p_brand]), ' ') AS joined_lists,
           array_to_string([x for x in string_split(replace(p_name, 'red', ''), ' ') if x <> ''], ' ') AS no_empty,
           len(CASE WHEN p_size % 5 = 0 THEN [] ELSE [p_type] END) AS wrapped,
           array_to_string(list_concat(string_split(p_name, ' '), [p_type]), '/') AS flat FROM part""")
def _(spark, sf):
    words = F.split("p_name", " ")
    return table(spark, sf, "part").select(
        "p_partkey", text.join_lists(words, F.array("p_brand")).alias("joined_lists"),
        F.array_join(text.drop_empty(F.split(F.replace("p_name", F.lit("red"), F.lit("")), " ")), " ").alias("no_empty"),
        F.size(text.as_list(F.when(F.col("p_size") % 5 != 0, F.col("p_type")), T.StringType())).alias("wrapped"),
        F.array_join(text.as_list(F.array(words, F.array("p_type")), T.ArrayType(STRINGS)), "/").alias("flat"))


LEVEL_CASE = "CASE {0} " + " ".join(f"WHEN '{k}' THEN {float(v)}" for k, v in matching.LEVELS.items()) + " ELSE 0.0 END"


def sql_level(x: str) -> str:
    return LEVEL_CASE.format(f"upper(trim({x}))")


@query("level_score", "F26", f"""
    WITH {CURATED_SQL} SELECT codigo_vaga, ({sql_level("' ' || lower(pv_nivel_profissional) || ' '")})::double AS professional,
      ({sql_level('pv_nivel_academico')})::double AS academic, ({sql_level('pv_nivel_ingles')})::double AS english FROM jobs""")
def _(spark, sf):
    messy = F.concat(F.lit(" "), F.lower("pv_nivel_profissional"), F.lit(" "))
    return jobs(spark, sf).select(
        "codigo_vaga", matching.level_score(messy).alias("professional"),
        matching.level_score(F.col("pv_nivel_academico")).alias("academic"),
        matching.level_score(F.col("pv_nivel_ingles")).alias("english"))


@query("first_text", "F27", f"""
    SELECT p_partkey, coalesce(string_split(p_name, ' ')[1], '') AS first_item,
           {sql_strip("'  ' || p_type || chr(9)")} AS trimmed FROM part""")
def _(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", text.first_text(F.split("p_name", " "), STRINGS).alias("first_item"),
        text.first_text(F.concat(F.lit("  "), "p_type", F.lit("\t")), T.StringType()).alias("trimmed"))


@query("prompt_text", "F28", f"""
    WITH {JOINED_SQL} SELECT codigo_vaga, codigo_candidato, linha,
      'Título: ' || job_ib_titulo_vaga || chr(10) || 'Atividades: ' || job_pv_principais_atividades || chr(10) ||
      'Competências: ' || job_pv_competencia_tecnicas_e_comportamentais || chr(10) ||
      'Observações: ' || coalesce(job_pv_demais_observacoes, '') || chr(10) ||
      'Habilidades comportamentais: ' || job_pv_habilidades_comportamentais_necessarias || chr(10) || 'Responda em JSON' AS job_prompt,
      coalesce(app_cv_pt, '') || chr(10) || '---' || chr(10) || 'Responda em JSON' AS candidate_prompt FROM joined""")
def _(spark, sf):
    df = joined(spark, sf)
    return df.select("codigo_vaga", "codigo_candidato", "linha",
                     job_prompt(df, instructions="Responda em JSON").alias("job_prompt"),
                     candidate_prompt(df, instructions="Responda em JSON").alias("candidate_prompt"))


@query("json_answer", "F29", """
    SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE json_extract_string(props, '$.k')::bigint END AS k FROM events""")
def _(spark, sf):
    k, props = F.col("event_id") % 4, F.col("props")
    answer = (F.when(k == 0, F.concat(F.lit("```json\n"), props, F.lit("\n```\n"))).when(k == 1, props)
              .when(k == 2, F.concat(F.lit(" \n"), props, F.lit("\n"))).otherwise(F.concat(F.lit("Resposta: "), props)))
    parsed = text.parse_answer(answer, T.StructType.fromDDL("k bigint"))
    return table(spark, sf, "events").select("event_id", parsed.k.alias("k"))


@query("id_disambiguation", "F32", f"""
    WITH {CURATED_SQL} SELECT linha, codigo_vaga, CASE WHEN p_codigo = codigo_vaga THEN p_codigo || '_cand' ELSE p_codigo END AS codigo_candidato FROM prospects""")
def _(spark, sf):
    return prospects(spark, sf).select(
        "linha", "codigo_vaga", text.tell_apart(F.col("p_codigo"), F.col("codigo_vaga")).alias("codigo_candidato"))


@query("scalar_today", "J8,A4", """
    SELECT o_orderkey, datediff('day', o_orderdate::date, (SELECT max(o_orderdate)::date FROM orders)) AS age_days FROM orders""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.datediff(latest_value(o, "o_orderdate"), F.col("o_orderdate")).alias("age_days"))
