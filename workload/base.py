"""Query registry and the mapping of the driver tables to recruiting tables.

The mapping is a set of SQL expressions that Spark and DuckDB read alike, so a query and its
oracle start from the same derived columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    covers: str
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a query; ``covers`` lists the operator ids it exercises."""
    def add(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, covers, run, sql)
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def select_exprs(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {n}" for n, e in expressions.items()])


def sql_select(expressions: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in expressions.items()) + f" FROM {source}"


def r(column: str, digits: int = 6):
    """Rounded column under its own name."""
    return F.round(F.col(column), digits).alias(column)


# ---------------------------------------------------------------------- recruiting tables
# Jobs from orders, candidates from customers, prospects from line items. Part numbers reach
# beyond the customer numbers, so the inner joins drop some prospects.
DAY = "cast(o_orderdate as date)"
JOBS = {
    "codigo_vaga": "cast(o_orderkey as string)",
    "ib_titulo_vaga": "'VAGA ' || cast(o_orderkey % 50 as string)",
    "ib_prioridade_vaga": "o_orderpriority",
    "ib_tipo_contratacao": "case when o_orderstatus = 'F' then 'CLT Full,  PJ/Autônomo , ' "
                           "when o_orderstatus = 'O' then 'Hunting' when o_orderkey % 2 = 0 then null else ' , ' end",
    "ib_data_requicisao": f"case when o_orderkey % 13 = 0 then null else {DAY} end",
    "ib_data_inicial": f"case when o_orderkey % 11 = 0 then null else {DAY} + cast(o_custkey % 40 as int) end",
    "ib_data_final": f"case when o_orderstatus = 'P' then null else {DAY} + cast(o_custkey % 900 as int) end",
    "ib_limite_esperado_para_contratacao": f"case when o_orderkey % 7 = 0 then null else {DAY} + cast(o_custkey % 60 as int) - 5 end",
    "ib_empresa_divisao": "case when o_custkey % 6 = 0 then '' else 'DIVISAO ' || cast(o_custkey % 6 as string) end",
    "ib_requisitante": "'REQ ' || cast(o_custkey % 400 as string)",
    "ib_objetivo_vaga": "'CONTRATACAO ' || o_orderpriority",
    "ib_nome": "'CONTATO ' || cast(o_custkey as string)",
    "ib_telefone": "'11-' || cast(o_custkey as string)",
    "pv_estado": "case when o_custkey % 5 = 0 then '' else 'NATION_' || cast(o_custkey % 25 as string) end",
    "pv_cidade": "'CIDADE ' || cast(o_custkey % 40 as string)",
    "pv_bairro": "case when o_custkey % 3 = 0 then 'CENTRO' else null end",
    "pv_regiao": "case when o_custkey % 4 = 0 then 'ASIA' when o_custkey % 4 = 1 then 'EUROPE' else null end",
    "pv_local_trabalho": "cast(o_custkey % 1000 as string)",
    "pv_vaga_especifica_para_pcd": "case when o_orderkey % 4 = 0 then 'SIM' when o_orderkey % 4 = 1 then 'NÃO' else null end",
    "pv_nivel_profissional": "case o_orderkey % 5 when 0 then 'JÚNIOR' when 1 then 'PLENO' when 2 then 'SÊNIOR' "
                             "when 3 then 'ESPECIALISTA' else null end",
    "pv_nivel_academico": "case o_orderkey % 4 when 0 then 'ENSINO MÉDIO COMPLETO' when 1 then 'ENSINO SUPERIOR COMPLETO' "
                          "when 2 then 'DOUTORADO' else '' end",
    "pv_nivel_ingles": "case o_orderkey % 6 when 0 then 'NENHUM' when 1 then 'BÁSICO' when 2 then 'TÉCNICO' "
                       "when 3 then 'AVANÇADO' when 4 then 'FLUENTE' else 'OUTRO' end",
    "pv_areas_atuacao": "case when o_orderstatus = 'P' then 'TI - Desenvolvimento-Dados -' else 'Comercial' end",
    "pv_principais_atividades": "'ATIVIDADES ' || o_orderpriority",
    "pv_competencia_tecnicas_e_comportamentais": "'PYTHON, SQL; GRUPO ' || cast(o_orderkey % 9 as string)",
    "pv_demais_observacoes": "case when o_orderkey % 2 = 0 then 'VIAGENS; INGLES' else null end",
    "pv_equipamentos_necessarios": "'NOTEBOOK, CELULAR'",
    "pv_habilidades_comportamentais_necessarias": "'COMUNICACAO, LIDERANCA ' || cast(o_orderkey % 3 as string)",
    "b_valor_venda": "case when o_orderkey % 5 = 0 then '' when o_orderkey % 5 = 1 then null else cast(cast(floor(o_totalprice) as bigint) as string) end",
    "b_valor_compra_1": "case when o_orderkey % 3 = 0 then '100,00' else null end",
    "b_valor_compra_2": "case when o_orderkey % 7 = 0 then '' else null end",
}
CREATED = "cast('1996-01-01' as date) + cast(c_custkey % 1500 as int)"
APPLICANTS = {
    "codigo_candidato": "cast(c_custkey as string)",
    "ib_telefone": "case when c_custkey % 9 = 0 then '' when c_custkey % 9 = 1 then null else '21-' || cast(c_custkey as string) end",
    "ib_objetivo_profissional": "case when c_custkey % 8 = 0 then null when c_custkey % 8 = 1 then '' else 'OBJETIVO ' || c_mktsegment end",
    "ib_data_criacao": f"cast({CREATED} as timestamp)",
    "ib_data_atualizacao": f"case when c_custkey % 10 = 0 then null else cast({CREATED} + cast(c_custkey % 100 as int) - 10 as timestamp) end",
    "ib_email": "case when c_custkey % 7 = 0 then null else c_name || '@mail.com' end",
    "ib_local": "case when c_custkey % 12 = 0 then null else 'NATION_' || cast(c_nationkey as string) end",
    "ib_nome": "c_name",
    "ip_nome": "c_name",
    "ip_cpf": "cast(c_custkey * 31 as string)",
    "ip_email": "c_name || '@home.com'",
    "ip_data_nascimento": "case when c_custkey % 6 = 0 then null else cast('1970-01-01' as date) + cast(c_custkey % 9000 as int) end",
    "ip_telefone_celular": "'9' || cast(c_custkey as string)",
    "ip_sexo": "case c_custkey % 3 when 0 then 'FEMININO' when 1 then 'MASCULINO' else null end",
    "ip_estado_civil": "case when c_custkey % 4 = 0 then 'SOLTEIRO' else null end",
    "ip_pcd": "case c_custkey % 3 when 0 then 'SIM' when 1 then '' else null end",
    "ip_endereco": "case when c_custkey % 5 = 0 then '' else 'RUA ' || cast(c_custkey as string) || ' CIDADE ' || cast(c_custkey % 90 as string) end",
    "ip_url_linkedin": "case when c_custkey % 2 = 0 then 'HTTPS://L/' || cast(c_custkey as string) else '' end",
    "ip_facebook": "cast(null as string)",
    "ip_conhecimentos_tecnicos": "'TECNICO ' || c_mktsegment",
    "ip_certificacoes": "case when c_custkey % 4 = 0 then 'AWS, SCRUM' else '' end",
    "ip_remuneracao": "case when c_acctbal < 0 then null when c_custkey % 5 = 0 then '' else cast(cast(floor(c_acctbal) as bigint) as string) end",
    "ip_nivel_profissional": "case c_mktsegment when 'BUILDING' then 'PLENO' when 'MACHINERY' then 'SENIOR' when 'AUTOMOBILE' then 'LÍDER' else null end",
    "fei_nivel_academico": "case c_custkey % 5 when 0 then 'ENSINO SUPERIOR INCOMPLETO' when 1 then 'MESTRADO' when 2 then 'PÓS-GRADUAÇÃO' when 3 then '' else null end",
    "fei_cursos": "'CURSO ' || cast(c_custkey % 30 as string)",
    "fei_nivel_ingles": "case c_custkey % 4 when 0 then 'BÁSICO' when 1 then 'INTERMEDIÁRIO' when 2 then 'FLUENTE' else null end",
    "fei_nivel_espanhol": "case c_custkey % 4 when 0 then 'NENHUM' when 1 then 'BÁSICO' else null end",
    "cv_pt": "case when c_custkey % 10 = 3 then null else 'EXPERIENCIA EM ' || c_mktsegment || ' E PYTHON COM SQL, DISPONIBILIDADE PJ ' || cast(c_custkey % 500 as string) end",
}
PROSPECTS = {
    "codigo_vaga": "cast(l_orderkey as string)",
    "p_codigo": "cast(l_partkey as string)",
    "p_nome": "'NOME ' || cast(l_partkey as string)",
    "p_situacao_candidado": "case when l_returnflag = 'A' then 'APROVADO' when l_returnflag = 'R' and l_linestatus = 'O' then 'ENTREVISTA TÉCNICA' "
                            "when l_linenumber = 7 then null else 'PROSPECT' end",
    "p_data_candidatura": "case when l_linenumber = 6 then null else cast(l_shipdate as date) end",
    "p_ultima_atualizacao": "case when l_linenumber = 5 then null else cast(l_shipdate as date) + cast(l_suppkey % 30 as int) end",
    "p_comentario": "case l_linenumber when 1 then 'CANDIDATO INTERESSADO, BOM PERFIL' when 2 then 'NÃO RESPONDE E DESISTIU' "
                    "when 3 then 'PERFIL FRACO MAS AVANÇOU' when 4 then '' when 5 then null when 6 then 'MOTIVADO' else 'SEM INTERESSE' end",
    "p_recrutador": "case when l_suppkey % 10 = 0 then null when l_suppkey % 10 < 4 then 'ANA' "
                    "else 'RECRUTADOR ' || cast(l_partkey % 1200 as string) end",
}


def jobs(spark, folder):
    return select_exprs(table(spark, folder, "orders"), JOBS)


def applicants(spark, folder):
    return select_exprs(table(spark, folder, "customer"), APPLICANTS)


def prospects(spark, folder):
    return select_exprs(table(spark, folder, "lineitem"), {**PROSPECTS, "linha": "l_linenumber"})


CURATED_SQL = (f"jobs AS ({sql_select(JOBS, 'orders')}), applicants AS ({sql_select(APPLICANTS, 'customer')}), "
               f"prospects AS ({sql_select({**PROSPECTS, 'linha': 'l_linenumber'}, 'lineitem')})")
JOINED_SQL = (
    CURATED_SQL + ", joined AS (SELECT "
    + ", ".join(f"p.{c}" for c in PROSPECTS if c not in ("p_codigo", "codigo_vaga")) + ", p.linha, p.codigo_vaga, p.p_codigo AS codigo_candidato, "
    + ", ".join(f"a.{c} AS app_{c}" for c in APPLICANTS if c != "codigo_candidato") + ", "
    + ", ".join(f"j.{c} AS job_{c}" for c in JOBS if c != "codigo_vaga")
    + " FROM prospects p JOIN applicants a ON p.p_codigo = a.codigo_candidato JOIN jobs j ON p.codigo_vaga = j.codigo_vaga)")


def joined(spark, folder):
    from rosterlake.operators.joins import join_entities
    return join_entities(prospects(spark, folder), applicants(spark, folder), jobs(spark, folder))


# -------------------------------------------------------------------- SQL text helpers
SPACE = r"[\t-\r \x{85}\p{Z}]"
WORD = r"\p{L}\p{M}\p{Nl}\p{Nd}\p{Pc}\x{200c}\x{200d}"


def sql_upper(x: str) -> str:
    return f"replace(replace(upper({x}), 'ẞ', 'SS'), 'ß', 'SS')"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_clean(x: str) -> str:
    squeezed = f"regexp_replace({x}, '{SPACE}+', ' ', 'g')"
    return sql_upper(f"trim(regexp_replace({squeezed}, '[^{WORD} @.,\\-:/]', '', 'g'))")


def sql_filled(x: str) -> str:
    return f"coalesce({x} <> '', false)"


def sql_days(later: str, earlier: str, absolute: bool = False) -> str:
    days = f"date_sub('day', {earlier}::timestamp, {later}::timestamp)"
    return f"greatest(coalesce({f'abs({days})' if absolute else days}, -1), 0)"
