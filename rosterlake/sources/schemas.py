"""Explicit schemas of the recruiting files. All leaves are strings in the raw files."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: field names of the raw files ------------------------------------------------
JOB_FIELDS = {
    "informacoes_basicas": [
        "data_requicisao", "limite_esperado_para_contratacao", "titulo_vaga", "vaga_sap", "cliente",
        "solicitante_cliente", "empresa_divisao", "requisitante", "analista_responsavel", "tipo_contratacao",
        "prazo_contratacao", "objetivo_vaga", "prioridade_vaga", "origem_vaga", "superior_imediato", "nome",
        "telefone", "data_inicial", "data_final",
    ],
    "perfil_vaga": [
        "pais", "estado", "cidade", "bairro", "regiao", "local_trabalho", "vaga_especifica_para_pcd",
        "faixa_etaria", "horario_trabalho", "nivel profissional", "nivel_academico", "nivel_ingles",
        "nivel_espanhol", "outro_idioma", "areas_atuacao", "principais_atividades",
        "competencia_tecnicas_e_comportamentais", "demais_observacoes", "viagens_requeridas",
        "equipamentos_necessarios", "habilidades_comportamentais_necessarias",
    ],
    "beneficios": ["valor_venda", "valor_compra_1", "valor_compra_2"],
}
PROSPECT_FIELDS = ["titulo", "modalidade"]
PROSPECT_ITEM_FIELDS = ["nome", "codigo", "situacao_candidado", "data_candidatura", "ultima_atualizacao",
                        "comentario", "recrutador"]
APPLICANT_FIELDS = {
    "infos_basicas": [
        "telefone_recado", "telefone", "objetivo_profissional", "data_criacao", "inserido_por", "email", "local",
        "sabendo_de_nos_por", "data_atualizacao", "codigo_profissional", "nome",
    ],
    "informacoes_pessoais": [
        "data_aceite", "download_cv", "nome", "cpf", "fonte_indicacao", "email", "email_secundario",
        "data_nascimento", "telefone_celular", "telefone_recado", "sexo", "estado_civil", "pcd", "endereco",
        "skype", "url_linkedin", "facebook",
    ],
    "informacoes_profissionais": [
        "titulo_profissional", "area_atuacao", "conhecimentos_tecnicos", "certificacoes",
        "outras_certificacoes", "remuneracao", "nivel_profissional",
    ],
    "formacao_e_idiomas": [
        "nivel_academico", "instituicao_ensino_superior", "cursos", "ano_conclusao", "nivel_ingles",
        "nivel_espanhol", "outro_idioma",
    ],
}
APPLICANT_TEXTS = ["cv_pt", "cv_en"]
JOB_ID, CANDIDATE_ID = "codigo_vaga", "codigo_candidato"
JOB_DATES = ["ib_data_requicisao", "ib_data_inicial", "ib_data_final", "ib_limite_esperado_para_contratacao"]
PROSPECT_DATES = ["p_data_candidatura", "p_ultima_atualizacao"]
APPLICANT_DATES = ["ip_data_nascimento"]
APPLICANT_DATETIMES = ["ib_data_atualizacao", "ib_data_criacao"]
# ------------------------------------------------------------------------------------------------


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _nested(blocks: dict, extra=()) -> T.StructType:
    return T.StructType([T.StructField(k, _strings(v)) for k, v in blocks.items()]
                        + [T.StructField(n, T.StringType()) for n in extra])


RAW_JOB = _nested(JOB_FIELDS)
RAW_PROSPECT = T.StructType([
    *_strings(PROSPECT_FIELDS).fields,
    T.StructField("prospects", T.ArrayType(_strings(PROSPECT_ITEM_FIELDS))),
])
RAW_APPLICANT = _nested(APPLICANT_FIELDS, APPLICANT_TEXTS)


def with_id(record: T.StructType, id_field: str) -> T.StructType:
    return T.StructType([T.StructField(id_field, T.StringType()), *record.fields])


def flat_contract(record: T.StructType, id_field: str) -> T.StructType:
    """Contract of the flattened table: every column must exist, only the id must not be null."""
    from ..functions.naming import initials, tidy_name

    names = []
    for f in record.fields:
        inner = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if isinstance(inner, T.StructType):
            names += [tidy_name(f"{initials(f.name)}_{i.name}") for i in inner.fields]
        else:
            names.append(tidy_name(f.name))
    return T.StructType([T.StructField(id_field, T.StringType(), False), *_strings(names).fields])


CURATED_JOB = flat_contract(RAW_JOB, JOB_ID)
CURATED_PROSPECT = flat_contract(RAW_PROSPECT, JOB_ID)
CURATED_APPLICANT = flat_contract(RAW_APPLICANT, CANDIDATE_ID)
