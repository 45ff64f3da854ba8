"""Feature columns of the joined table (one prospect with its candidate and job).

Column names default to the recruiting tables; each step is one projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import temporal, text
from .flatten import normalize, pick_existing
from .joins import add_if_absent, group_rare, latest_value
from .location import with_same_place

# --- fixed values: column names of the recruiting tables --------------------------------
PII_COLUMNS = [
    "p_nome", "app_ib_telefone_recado", "app_ib_telefone", "app_ib_email", "app_ip_nome", "app_ip_cpf",
    "app_ip_email", "app_ip_email_secundario", "app_ip_data_nascimento", "app_ip_telefone_celular",
    "app_ip_telefone_recado", "app_ip_endereco", "app_ip_skype", "app_ip_url_linkedin", "app_ip_facebook",
]
PII_COLUMNS_FULL = PII_COLUMNS + ["app_ib_nome", "job_ib_nome", "job_ib_telefone"]
CONTACT_FLAGS = {
    "ind_app_telefone": "app_ib_telefone",
    "ind_app_email": "app_ib_email",
    "ind_app_linkedin": "app_ip_url_linkedin",
    "ind_app_endereco": "app_ip_endereco",
    "ind_app_facebook": "app_ip_facebook",
}
CANDIDATE_PLACES = ["app_ib_local", "app_ip_endereco"]
JOB_PLACES = ["job_pv_estado", "job_pv_cidade", "job_pv_bairro", "job_pv_regiao", "job_pv_local_trabalho"]
LIST_COLUMNS = {"job_ib_tipo_contratacao": ",", "job_pv_areas_atuacao": "-"}
PAY_COLUMNS = ["job_b_valor_venda", "job_b_valor_compra_1", "job_b_valor_compra_2"]
PROFILE_COLUMNS = [
    "app_ib_objetivo_profissional", "app_ib_local", "app_ip_sexo", "app_ip_estado_civil",
    "app_ip_pcd", "app_ip_remuneracao", "app_fei_nivel_academico", "app_fei_nivel_ingles",
]
SUCCESS_STATUSES = [
    "CONTRATADO PELA DECISION", "CONTRATADO COMO HUNTING", "DOCUMENTAÇÃO PJ",
    "ENCAMINHADO AO REQUISITANTE", "APROVADO", "ENTREVISTA TÉCNICA",
]
RAW_MARKER = "app_ib_telefone"
UNKNOWN_RECRUITER = "Desconhecido"
RECENT_DAYS = 30
# ------------------------------------------------------------------------------------------


def presence_flags(df: DataFrame, flags: Mapping[str, str] = CONTACT_FLAGS) -> DataFrame:
    return df.withColumns({name: text.is_filled(F.col(c)) for name, c in flags.items()})


def drop_personal_data(df: DataFrame, columns: Sequence[str] = PII_COLUMNS_FULL) -> DataFrame:
    return df.drop(*columns)


def is_raw(df: DataFrame) -> bool:
    """True while personal data is still there, that is, before the features were built."""
    return RAW_MARKER in df.columns


def temporal_features(df: DataFrame, today: Column | None = None) -> DataFrame:
    """Day differences and date flags; ``today`` defaults to the latest application date."""
    c = F.col
    today = latest_value(df, "p_data_candidatura") if today is None else today
    days = temporal.days_or_zero
    return df.withColumns({
        "tempo_entre_criacao_e_candidatura": days(c("app_ib_data_criacao"), c("p_data_candidatura"), absolute=True),
        "tempo_entre_job_inicial_e_candidatura": days(c("p_data_candidatura"), c("job_ib_data_inicial")),
        "tempo_para_contratacao": days(c("job_ib_limite_esperado_para_contratacao"), c("job_ib_data_requicisao")),
        "tempo_ultima_atualizacao_aplicacao": days(c("app_ib_data_atualizacao"), c("app_ib_data_criacao")),
        "tempo_vaga_aberta": days(c("job_ib_data_final"), c("job_ib_data_inicial")),
        "vaga_em_aberto_no_momento": temporal.flag_or_minus_one(
            c("job_ib_data_final") > today, c("job_ib_data_final")),
        "candidatura_antes_da_abertura_oficial": temporal.flag_or_minus_one(
            c("p_data_candidatura") < c("job_ib_data_inicial"), c("p_data_candidatura"), c("job_ib_data_inicial")),
        "dias_desde_requisicao": days(today, c("job_ib_data_requicisao")),
        "vaga_requisitada_recente": temporal.flag_or_minus_one(
            temporal.whole_days(today, c("job_ib_data_requicisao")) < RECENT_DAYS, c("job_ib_data_requicisao")),
    })


def candidate_age(df: DataFrame) -> DataFrame:
    """Age at registration; needs the birth date, so it runs before personal data is dropped."""
    return df.withColumn("idade_candidato", temporal.years_or_zero(
        F.col("app_ib_data_criacao"), F.col("app_ip_data_nascimento")))


def benefits_declared(df: DataFrame, columns: Sequence[str] = PAY_COLUMNS) -> DataFrame:
    return df.withColumn("job_ind_beneficios_declarados", text.any_filled(*[F.col(c) for c in columns]))


def disability_match(df: DataFrame) -> DataFrame:
    wanted = F.coalesce(F.col("job_pv_vaga_especifica_para_pcd") == "SIM", F.lit(False))
    return df.withColumn("match_pcd", wanted & text.is_filled(F.col("app_ip_pcd")))


def cleaned_lists(df: DataFrame, columns: Mapping[str, str] = LIST_COLUMNS) -> DataFrame:
    return df.withColumns({f"{c}_cleaned_list": text.split_clean_list(F.col(c), sep) for c, sep in columns.items()})


def build_features(df: DataFrame, today: Column | None = None, pii: Sequence[str] = PII_COLUMNS_FULL,
                   place_threshold: float = 70.0) -> DataFrame:
    """All structured features; a table whose personal data is already gone is returned as it is."""
    if not is_raw(df):
        return df
    today = latest_value(df, "p_data_candidatura") if today is None else today
    df = presence_flags(df)
    df = with_same_place(df, CANDIDATE_PLACES, JOB_PLACES, place_threshold)
    df = drop_personal_data(df, pii)
    df = df.withColumn("job_ib_prioridade_vaga", text.priority_class(F.col("job_ib_prioridade_vaga")))
    df = cleaned_lists(df)
    df = temporal_features(df, today)
    return disability_match(benefits_declared(df))


def sentiment_columns(df: DataFrame, words: Mapping[str, str] = text.SENTIMENT_TRAINING,
                      comment: str = "p_comentario") -> DataFrame:
    """Positive and negative flags of a comment and the score 1 / -1 / 0; no comment column reads as ''."""
    df = add_if_absent(df, comment, F.lit(""))
    df = df.withColumns({
        "contem_palavra_chave_positiva": text.mentions(F.col(comment), words["positive"]),
        "contem_palavra_chave_negativa": text.mentions(F.col(comment), words["negative"]),
    })
    return df.withColumn("sentimento_comentario_score", text.sentiment_from_flags(
        F.col("contem_palavra_chave_positiva"), F.col("contem_palavra_chave_negativa")))


def scoring_behaviour_columns(df: DataFrame) -> DataFrame:
    """The scoring variant: normalised text, its own word list, a fixed recruiter list."""
    df = sentiment_columns(normalize(df), text.SENTIMENT_SCORING)
    return df.withColumn("p_recrutador_tratado", text.keep_listed(F.col("p_recrutador"), text.COMMON_RECRUITERS))


def profile_columns(df: DataFrame, columns: Sequence[str] = PROFILE_COLUMNS, cv: str = "app_cv_pt") -> DataFrame:
    """Share of filled profile columns and length of the CV; a table that has them is returned as it is."""
    if {"percentual_perfil_completo", "tamanho_cv"} <= set(df.columns):
        return df
    present = pick_existing(df, columns)
    return df.withColumns({
        "percentual_perfil_completo": text.filled_share([F.col(c) for c in present]),
        "tamanho_cv": text.char_count(F.col(cv)),
    })


def candidate_flags(df: DataFrame) -> DataFrame:
    """Which of the candidate's declarations are there; a table that has the flags is returned as it is."""
    flags = {"tem_objetivo_profissional": "app_ib_objetivo_profissional", "tem_remuneracao_definida": "app_ip_remuneracao"}
    return df.withColumns({name: text.filled_flag(F.col(c)) for name, c in flags.items() if name not in df.columns})


def engagement_columns(df: DataFrame, now: Column) -> DataFrame:
    """The longer engagement feature set; expects the temporal features."""
    c = F.col
    return candidate_flags(df).withColumns({
        "candidatura_proativa": F.coalesce(c("candidatura_antes_da_abertura_oficial"), F.lit(0)).cast("tinyint"),
        "dias_para_se_candidatar": temporal.calendar_days(c("p_data_candidatura"), c("job_ib_data_requicisao")),
        "dias_desde_ultima_atualizacao": temporal.calendar_days(now, c("p_ultima_atualizacao")),
        "dias_no_processo": temporal.calendar_days(c("p_ultima_atualizacao"), c("p_data_candidatura")),
    })


def rare_recruiters(df: DataFrame, minimum: int = 10, missing: str | None = None) -> DataFrame:
    return group_rare(df, "p_recrutador", "p_recrutador_tratado", minimum, text.OTHERS, missing)


def engagement_target(df: DataFrame, statuses: Sequence[str] = SUCCESS_STATUSES,
                      status: str = "p_situacao_candidado", output: str = "engajado") -> DataFrame:
    return df.withColumn(output, F.coalesce(F.col(status).isin(list(statuses)), F.lit(False)).cast("int"))


def baseline_training_table(joined: DataFrame) -> DataFrame:
    """Joined table -> baseline training columns."""
    df = drop_personal_data(presence_flags(joined))
    return rare_recruiters(engagement_target(sentiment_columns(profile_columns(df))))
