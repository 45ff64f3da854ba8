"""Sources and sinks, flattening, joins, set operations and filters."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.functions import matching
from rosterlake.functions.naming import tidy_name
from rosterlake.operators import features, flatten, joins, quality
from rosterlake.plans import curate
from rosterlake.session import scratch_path
from rosterlake.sources import documents, keyed_json, ledger, schemas, tables

from .base import (APPLICANTS, CURATED_SQL, JOBS, JOINED_SQL, PROSPECTS, applicants, joined, jobs, prospects, query, r,
                   sql_clean, sql_filled, table)


# ---------------------------------------------------------------------- sources and sinks
def keyed_entries():
    """Records of customers as raw blocks, and their type."""
    record = T.StructType.fromDDL("dados struct<nome:string, `segmentô`:string>, saldo double")
    entry = F.struct(F.struct(F.col("c_name").alias("nome"), F.col("c_mktsegment").alias("segmentô")).alias("dados"),
                     F.col("c_acctbal").alias("saldo"))
    return record, entry


@query("keyed_json_files", "S1,P3,P4", """
    SELECT c_custkey::varchar AS codigo, c_name AS d_nome, c_mktsegment AS d_segmento, c_acctbal AS saldo, l.layout FROM customer, (VALUES ('object'), ('list')) l(layout)""")
def _(spark, sf):
    """Files of one keyed object each, and files of one list each; both of 500 customers."""
    record, entry = keyed_entries()
    customers, part = table(spark, sf, "customer"), F.floor(F.col("c_custkey") / 500).alias("part")
    key = F.col("c_custkey").cast("string")
    objects = customers.groupBy(part).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(key, entry)))).alias("value"))
    lists = customers.groupBy(part).agg(F.to_json(F.collect_list(F.struct(key.alias("codigo"), entry.dados.alias("dados"), entry.saldo.alias("saldo")))).alias("value"))
    out = None
    for layout, df, name in (("object_per_file", objects, "object"), ("list", lists, "list")):
        path = scratch_path(spark, layout)
        df.select("value").write.option("maxRecordsPerFile", 1).text(path)
        rows = flatten.flatten_nested(keyed_json.read_keyed_json(spark, path, "codigo", record, layout)).withColumn("layout", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("keyed_json_scan", "S1,P3,P4", """
    SELECT c_custkey::varchar AS codigo, c_name AS d_nome, c_mktsegment AS d_segmento, c_acctbal AS saldo FROM customer""")
def _(spark, sf):
    """Each line of the file is one keyed object."""
    record, entry = keyed_entries()
    path = scratch_path(spark, "keyed")
    lines = table(spark, sf, "customer").select(
        F.to_json(F.create_map(F.col("c_custkey").cast("string"), entry)).alias("value"))
    lines.write.text(path)
    return flatten.flatten_nested(keyed_json.read_keyed_json(spark, path, "codigo", record, "object_per_line"))


@query("json_lines_scan", "S1,S5,S7", "SELECT doc_id, text, lang, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END AS source FROM documents")
def _(spark, sf):
    path = scratch_path(spark, "lines")
    docs = table(spark, sf, "documents").select(
        "doc_id", "text", "lang", F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("source"))
    tables.write_jsonl(docs.where("doc_id % 2 = 0"), path)
    tables.write_jsonl(docs.where("doc_id % 2 = 1"), path, append=True)
    return tables.read_jsonl(spark, path, docs.schema)


@query("json_lines_skip_bad", "S6", "SELECT event_id, user_id, event_type FROM events WHERE event_id % 4 <> 0")
def _(spark, sf):
    path = scratch_path(spark, "bad")
    line = F.to_json(F.struct("event_id", "user_id", "event_type"))
    events = table(spark, sf, "events")
    events.select(F.when(F.col("event_id") % 4 == 0, F.substring(line, 1, 12)).otherwise(line)).write.text(path)
    return tables.read_jsonl(spark, path, "event_id bigint, user_id bigint, event_type string", skip_bad=True)


@query("parquet_overwrite", "S2,S3", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'O'")
def _(spark, sf):
    path, o = scratch_path(spark, "over"), table(spark, sf, "orders")
    tables.write_parquet(o.where("o_orderstatus = 'O'"), path)
    tables.write_parquet(o.where("o_orderstatus <> 'O'"), path)
    return tables.read_parquet(spark, path).select("o_orderkey", "o_custkey", "o_totalprice")


@query("parquet_append_relaxed", "S4,U1", """
    SELECT c_custkey AS id, c_acctbal AS amount, NULL::varchar AS note FROM customer
    UNION ALL SELECT s_suppkey, floor(s_acctbal), s_name FROM supplier""")
def _(spark, sf):
    path = scratch_path(spark, "append")
    ledger.append_parquet(table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_acctbal AS amount"), path)
    ledger.append_parquet(table(spark, sf, "supplier").selectExpr(
        "cast(s_suppkey as int) AS id", "cast(floor(s_acctbal) as int) AS amount", "s_name AS note"), path)
    return ledger.read_appended(spark, path).select("id", "amount", "note")


@query("ledger_commits", "S4,E1,J6", """
    SELECT user_id, min(event_id % 18) AS part, count(*) AS n_events, true AS few_folders FROM events WHERE user_id IS NOT NULL GROUP BY user_id""")
def _(spark, sf):
    """Eighteen commits of ids that overlap, one of them repeated, and a second table that must change with the first."""
    book, e = ledger.Ledger(spark, scratch_path(spark, "ledger")), table(spark, sf, "events").where("user_id IS NOT NULL")
    for part in [*range(18), 17]:
        mine = e.where(F.col("event_id") % 18 == part)
        book.commit({"first": mine.select("user_id", F.lit(part).cast("bigint").alias("part")).distinct(), "all": mine.select("user_id", "event_id")}, batch=("q", part))
    seen = book.read("first").groupBy("user_id").agg(F.min("part").alias("part"))
    counts = book.read("all").groupBy("user_id").agg(F.count("*").alias("n_events"))
    few = all(len(t["folders"]) <= ledger.MAX_FOLDERS for t in book.manifest()["tables"].values())
    return seen.join(counts, "user_id").withColumn("few_folders", F.lit(few))


@query("union_relaxed", "U1", """
    SELECT c_custkey AS id, c_acctbal AS amount FROM customer UNION ALL SELECT s_suppkey, s_nationkey::double FROM supplier""")
def _(spark, sf):
    return joins.union_relaxed(
        table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_acctbal AS amount"),
        table(spark, sf, "supplier").selectExpr("s_nationkey AS amount", "cast(s_suppkey as int) AS id"))


@query("csv_scores", "S8", "SELECT c_custkey, c_name || ', \"x\"' AS c_name, c_acctbal FROM customer")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    tables.write_csv(table(spark, sf, "customer").withColumn("c_name", F.concat("c_name", F.lit(', "x"'))), path,
                     ["c_custkey", "c_name", "c_acctbal"])
    return tables.read_csv(spark, path, "c_custkey bigint, c_name string, c_acctbal double")


@query("quality_issue_log", "S9,Q1,Q5", """
    SELECT 'lineitem' AS label, '20240101_000000' AS written,
      '[RANGE] l_quantity: ' || count(*) || ' rows, above 45' AS message FROM lineitem WHERE l_quantity > 45""")
def _(spark, sf):
    path = scratch_path(spark, "issues")
    issues = quality.check_range(table(spark, sf, "lineitem"), "l_quantity", 0, 45)
    tables.save_issues(issues, "lineitem", path, F.lit("2024-01-01").cast("timestamp"))
    return spark.read.schema("message string, label string, written string").parquet(path)


@query("schema_profile", "A18", """
    WITH c AS (SELECT count(*) AS n, count(l_orderkey) AS orders, count(l_partkey) AS parts, count(l_suppkey) AS suppliers, count(CASE WHEN l_tax > 0 THEN 1 END) AS taxes,
        count(CASE WHEN l_discount > 0 THEN 1 END) + count(CASE WHEN l_quantity > 20 THEN 1 END) AS amounts,
        count(CASE WHEN l_returnflag <> 'N' THEN 1 END) + count(CASE WHEN l_returnflag <> 'N' AND l_linestatus = 'F' THEN 1 END) AS flags FROM lineitem)
    SELECT unnest(['l_orderkey', 'item.part', 'item.supplier.key', 'item.supplier.tax', 'amounts[].name', 'amounts[].value', 'flags[]']) AS path,
      unnest(['bigint', 'bigint', 'bigint', 'double', 'string', 'double', 'string']) AS type,
      unnest([orders, parts, suppliers, taxes, 2 * n, amounts, flags]::bigint[]) AS n_values FROM c""")
def _(spark, sf):
    """Order lines as nested records: a struct in a struct, a list of structs, a list that may be null or hold nulls."""
    above = lambda c, limit: F.when(F.col(c) > limit, F.col(c))
    amount = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    supplier = F.struct(F.col("l_suppkey").alias("key"), above("l_tax", 0).alias("tax"))
    flags = F.array("l_returnflag", F.when(F.col("l_linestatus") == "F", F.col("l_linestatus")))
    nested = table(spark, sf, "lineitem").select(
        "l_orderkey", F.struct(F.col("l_partkey").alias("part"), supplier.alias("supplier")).alias("item"),
        F.array(amount("discount", above("l_discount", 0)), amount("quantity", above("l_quantity", 20))).alias("amounts"),
        F.when(F.col("l_returnflag") != "N", flags).alias("flags"))
    return flatten.schema_profile(nested)


@query("document_router", "S10", """
    SELECT 'cv_' || doc_id || CASE doc_id % 4 WHEN 0 THEN '.TXT' WHEN 1 THEN '.pdf' WHEN 2 THEN '.png' ELSE '.txt' END AS path,
      CASE doc_id % 4 WHEN 1 THEN 'pdf' WHEN 2 THEN NULL ELSE 'txt' END AS kind,
      CASE doc_id % 4 WHEN 2 THEN NULL ELSE text END AS text,
      CASE doc_id % 4 WHEN 2 THEN 'unsupported file type' END AS reason FROM documents""")
def _(spark, sf):
    k = F.col("doc_id") % 4
    suffix = F.when(k == 0, ".TXT").when(k == 1, ".pdf").when(k == 2, ".png").otherwise(".txt")
    content = F.encode("text", "UTF-8")
    damaged = F.concat(content, F.unhex(F.lit("FF")))  # an invalid last byte is dropped
    files = table(spark, sf, "documents").select(
        F.concat(F.lit("cv_"), "doc_id", suffix).alias("path"),
        F.when(k == 3, damaged).otherwise(content).alias("content"), F.col("text").alias("layer"))
    return documents.parse_documents(files, pdf_text="layer")


CONTROL = r"[\x00-\x08\x0B-\x1F\x{FFFE}\x{FFFF}]"  # not allowed in XML


@query("documents_from_files", "S10", f"""
    WITH f AS (SELECT doc_id // 25 AS n, string_agg(regexp_replace(coalesce(text, ''), '{CONTROL}', '', 'g'), E'\\n' ORDER BY doc_id) AS text FROM documents GROUP BY 1)
    SELECT 'cv_' || n || CASE n % 4 WHEN 0 THEN '.docx' WHEN 1 THEN '.DOC' WHEN 2 THEN '.txt' ELSE '.odt' END AS name, CASE n % 4 WHEN 0 THEN 'docx' WHEN 1 THEN 'docx' WHEN 2 THEN 'txt' END AS kind,
      CASE WHEN n % 4 < 3 THEN text END AS text, CASE n % 4 WHEN 3 THEN 'unsupported file type' END AS reason FROM f""")
def _(spark, sf):
    """Word and text files, written to the shared folder and read as files; 25 documents in each."""
    clean = F.regexp_replace(F.coalesce("text", F.lit("")), CONTROL, "")
    packed = table(spark, sf, "documents").groupBy(F.expr("doc_id div 25").alias("n")).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", clean.alias("text")))).alias("rows"))
    k, text = F.col("n") % 4, F.array_join("rows.text", "\n")
    files = packed.select(F.concat(F.lit("cv_"), "n", F.when(k == 0, ".docx").when(k == 1, ".DOC").when(k == 2, ".txt").otherwise(".odt")).alias("name"),
                          F.when(k < 2, documents.word_file(F.split(text, "\n"))).otherwise(F.encode(text, "UTF-8")).alias("content"))
    folder = scratch_path(spark, "files")
    documents.write_files(files, folder)
    read = documents.parse_documents(documents.read_files(spark, folder))
    # the writer ends every file with a line break
    whole = F.when(F.col("kind") == "txt", F.expr("substring(text, 1, length(text) - 1)")).otherwise(F.col("text"))
    return read.select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), "kind", whole.alias("text"), "reason")


@query("ocr_decision", "S11", """
    SELECT doc_id, doc_id % 7 = 0 OR length(trim(text, E' \\n\\t')) < 50 AS needs_ocr,
      CASE WHEN (doc_id % 7 = 0 OR length(trim(text, E' \\n\\t')) < 50) AND doc_id % 3 <> 0 THEN 'ocr ' || doc_id ELSE text END AS chosen FROM documents""")
def _(spark, sf):
    text = F.col("text")
    ocr = F.when(F.col("doc_id") % 3 == 0, "  ").otherwise(F.concat(F.lit("ocr "), "doc_id"))
    force = F.col("doc_id") % 7 == 0
    return table(spark, sf, "documents").select(
        "doc_id", documents.needs_ocr(text, force).alias("needs_ocr"), documents.choose_text(text, ocr, force).alias("chosen"))


@query("inline_lookup", "S12,P13", """
    SELECT c_custkey, c_mktsegment, CASE c_mktsegment WHEN 'BUILDING' THEN 2.0 WHEN 'MACHINERY' THEN 3.0 END AS weight FROM customer""")
def _(spark, sf):
    rows = tables.rows_table(spark, [{"c_mktsegment": "BUILDING", "weight": 2.0}, {"c_mktsegment": "MACHINERY", "weight": 3.0}],
                             "c_mktsegment string, weight double")
    return joins.attach(table(spark, sf, "customer"), rows, ["c_mktsegment"]).select("c_custkey", "c_mktsegment", "weight")


@query("key_lookup", "P13", """
    SELECT c_custkey, c_name FROM customer WHERE c_custkey = (SELECT max(o_custkey) FROM orders)""")
def _(spark, sf):
    key = joins.latest_value(table(spark, sf, "orders"), "o_custkey")
    return table(spark, sf, "customer").where(F.col("c_custkey") == key).select("c_custkey", "c_name").limit(1)


@query("reference_or_empty", "S13", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(spark, sf):
    events = table(spark, sf, "events")
    absent = tables.read_or_empty(spark, scratch_path(spark, "none"), events.schema)
    there = tables.read_or_empty(spark, f"{sf}/events.parquet", events.schema)
    return absent.unionByName(there).groupBy("event_type").agg(F.count("*").alias("n"))


@query("production_window", "S14", """
    SELECT event_id, event_type FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAYS""")
def _(spark, sf):
    return tables.recent_rows(table(spark, sf, "events"), "ts", 7).select("event_id", "event_type")


@query("processed_state", "S15,J6", "SELECT o_orderkey::varchar AS o_orderkey FROM orders WHERE o_orderstatus <> 'F'")
def _(spark, sf):
    path, o = scratch_path(spark, "state"), table(spark, sf, "orders")
    ids = o.select(F.col("o_orderkey").cast("string"))
    tables.save_processed_ids(o.where("o_orderstatus = 'O'"), path, "o_orderkey")
    tables.save_processed_ids(o.where("o_orderstatus = 'F'"), path, "o_orderkey")
    return joins.new_ids(ids, tables.processed_ids(spark, path, "o_orderkey"), "o_orderkey")


# -------------------------------------------------------------------------------- nested data
@query("flatten_struct", "P1,P3,P4", """
    SELECT o_orderkey, o_orderstatus AS ib_status, o_orderpriority AS ib_nivel_profissional, o_totalprice AS pv_valor_venda_r FROM orders""")
def _(spark, sf):
    nested = table(spark, sf, "orders").select(
        "o_orderkey", F.struct(F.col("o_orderstatus").alias("Status"), F.col("o_orderpriority").alias("nível profissional")).alias("informacoes_basicas"),
        F.struct(F.col("o_totalprice").alias("valor__venda (R$)")).alias("perfilVaga"))
    return flatten.flatten_nested(nested)


@query("explode_children", "P2,J5", """
    SELECT l_orderkey, l_linenumber, unnest(CASE WHEN l_linenumber % 3 = 0 THEN [NULL::varchar]
      ELSE [l_returnflag, l_linestatus] END) AS p_codigo FROM lineitem""")
def _(spark, sf):
    item = lambda c: F.struct(F.col(c).alias("codigo"))
    empty = F.array().cast("array<struct<codigo:string>>")
    children = (F.when(F.col("l_linenumber") % 6 == 3, F.lit(None)).when(F.col("l_linenumber") % 6 == 0, empty)
                .otherwise(F.array(item("l_returnflag"), item("l_linestatus"))))
    return flatten.flatten_nested(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", children.alias("prospects")))


def raw_block(fields, prefix, expressions, dates):
    columns = []
    for f in fields:
        name = tidy_name(f"{prefix}_{f}")
        e = expressions.get(name, "cast(null as string)")
        if name in dates:
            e = f"date_format({e}, '{dates[name]}')"
        columns.append(F.expr(e).cast("string").alias(f))
    return F.struct(*columns)


def raw_jobs(spark, sf):
    dates = dict.fromkeys(schemas.JOB_DATES, "dd-MM-yyyy")
    messy = {**JOBS, "ib_titulo_vaga": f"'  ' || {JOBS['ib_titulo_vaga']} || '!  x'"}
    return table(spark, sf, "orders").select(F.expr(JOBS["codigo_vaga"]).alias("codigo_vaga"), *[
        raw_block(fields, flatten.initials(block), messy, dates).alias(block) for block, fields in schemas.JOB_FIELDS.items()])


def raw_prospects(spark, sf):
    dates = dict.fromkeys(schemas.PROSPECT_DATES, "dd-MM-yyyy")
    bad = {**PROSPECTS, "p_codigo": f"case when l_linenumber = 7 then ' -- ' else {PROSPECTS['p_codigo']} || '/' || cast(l_linenumber as string) || '/' || cast(cast(l_extendedprice * 100 as bigint) as string) || '/' || cast(l_suppkey as string) end"}
    child = raw_block(schemas.PROSPECT_ITEM_FIELDS, "p", bad, dates)
    return table(spark, sf, "lineitem").select(
        F.expr(PROSPECTS["codigo_vaga"]).alias("codigo_vaga"), F.lit(" cargo ").alias("titulo"),
        F.lit(None).cast("string").alias("modalidade"), F.array(child).alias("prospects"))


def raw_applicants(spark, sf):
    dates = {**dict.fromkeys(schemas.APPLICANT_DATES, "dd-MM-yyyy"), **dict.fromkeys(schemas.APPLICANT_DATETIMES, "dd-MM-yyyy HH:mm:ss")}
    return table(spark, sf, "customer").select(F.expr(APPLICANTS["codigo_candidato"]).alias("codigo_candidato"), *[
        raw_block(fields, flatten.initials(block), APPLICANTS, dates).alias(block) for block, fields in schemas.APPLICANT_FIELDS.items()],
        F.expr(APPLICANTS["cv_pt"]).alias("cv_pt"), F.lit(None).cast("string").alias("cv_en"))


def clean_columns(expressions, names, dates=()):
    return ", ".join(f"{c}" if c in dates else f"{sql_clean(c)} AS {c}" for c in names)


JOB_SHOWN = ["ib_tipo_contratacao", "ib_data_requicisao", "ib_data_inicial", "ib_data_final", "ib_limite_esperado_para_contratacao",
             "pv_nivel_profissional", "pv_areas_atuacao", "b_valor_venda"]


@query("curated_jobs", "Q9,Q7,Q8,S1,F2", f"""
    WITH {CURATED_SQL} SELECT codigo_vaga, ib_titulo_vaga || ' X' AS ib_titulo_vaga, {clean_columns(JOBS, JOB_SHOWN, schemas.JOB_DATES)} FROM jobs""")
def _(spark, sf):
    return curate.curate(raw_jobs(spark, sf), curate.JOBS).select("codigo_vaga", "ib_titulo_vaga", *JOB_SHOWN)


@query("curated_prospects", "Q10,P11,P2,F2", f"""
    WITH {CURATED_SQL} SELECT codigo_vaga, 'CARGO' AS titulo, p_codigo || '/' || linha AS p_codigo, p_data_candidatura,
      p_ultima_atualizacao, {sql_clean('p_comentario')} AS p_comentario FROM prospects WHERE linha <> 7""")
def _(spark, sf):
    issues = scratch_path(spark, "removed")
    df = curate.curate(raw_prospects(spark, sf), curate.PROSPECTS, issues)
    return df.select("codigo_vaga", "titulo", F.regexp_extract("p_codigo", r"^(\d+/\d+)", 1).alias("p_codigo"),
                     "p_data_candidatura", "p_ultima_atualizacao", "p_comentario")


APP_SHOWN = ["ib_nome", "ib_email", "ib_data_criacao", "ib_data_atualizacao", "ip_data_nascimento", "ip_endereco", "fei_nivel_academico", "cv_pt"]


@query("curated_applicants", "Q9,F2,F4", f"""
    WITH {CURATED_SQL} SELECT codigo_candidato, {clean_columns(APPLICANTS, APP_SHOWN, schemas.APPLICANT_DATES + schemas.APPLICANT_DATETIMES)} FROM applicants""")
def _(spark, sf):
    return curate.curate(raw_applicants(spark, sf), curate.APPLICANTS).select("codigo_candidato", *APP_SHOWN)


@query("three_entity_flatten", "P18", f"""
    WITH {CURATED_SQL} SELECT p.codigo_vaga, p.linha::varchar AS linha, 'CONTATO ' || regexp_extract(j.ib_nome, '[0-9]+') AS ib_nome, p.p_nome AS pr_nome,
      a.ip_nome FROM prospects p JOIN jobs j USING (codigo_vaga) JOIN applicants a ON a.codigo_candidato = p.p_codigo""")
def _(spark, sf):
    fixed = table(spark, sf, "lineitem").select(
        F.expr(PROSPECTS["codigo_vaga"]).alias("codigo_vaga"), F.expr("cast(l_linenumber as string)").alias("linha"),
        F.array(raw_block(schemas.PROSPECT_ITEM_FIELDS, "p", PROSPECTS, dict.fromkeys(schemas.PROSPECT_DATES, "dd-MM-yyyy"))).alias("prospects"))
    j, p, a = flatten.flatten_entities(raw_jobs(spark, sf), fixed, raw_applicants(spark, sf))
    return (p.withColumnRenamed("pr_codigo_candidato", "codigo_candidato")
            .join(j.select("codigo_vaga", "ib_nome"), "codigo_vaga")
            .join(a.select("codigo_candidato", "ip_nome"), "codigo_candidato")
            .select("codigo_vaga", "linha", "ib_nome", "pr_nome", "ip_nome"))


# ---------------------------------------------------------------------- projections, filters
@query("required_rows", "P11,W2", r"""
    SELECT doc_id FROM documents WHERE NOT coalesce(trim(regexp_replace(trim(CASE doc_id % 5 WHEN 0 THEN ' -- ' WHEN 1 THEN '- -' WHEN 2 THEN NULL
      WHEN 3 THEN ' ' ELSE text END, E' \n\t'), '^-+|-+$', '', 'g'), E' \n\t') = '', true)""")
def _(spark, sf):
    k = F.col("doc_id") % 5
    messy = F.when(k == 0, " -- ").when(k == 1, "- -").when(k == 2, None).when(k == 3, " ").otherwise(F.col("text"))
    valid, _ = quality.split_required(table(spark, sf, "documents").withColumn("value", messy), ["value", "doc_id"])
    return valid.select("doc_id")


@query("membership_flag", "P12,L1", f"""
    WITH {CURATED_SQL} SELECT codigo_vaga, linha, coalesce(p_situacao_candidado IN ('CONTRATADO PELA DECISION', 'CONTRATADO COMO HUNTING',
      'DOCUMENTAÇÃO PJ', 'ENCAMINHADO AO REQUISITANTE', 'APROVADO', 'ENTREVISTA TÉCNICA'), false)::int AS engajado FROM prospects""")
def _(spark, sf):
    return features.engagement_target(prospects(spark, sf)).select("codigo_vaga", "linha", "engajado")


@query("prefixed_columns", "P5,P6,P7,P8,P9", f"""
    WITH {CURATED_SQL} SELECT codigo_candidato, ib_local AS app_ib_local, cv_pt AS app_cv_pt, '' AS p_comentario FROM applicants""")
def _(spark, sf):
    df = joins.prefix_columns(applicants(spark, sf).drop("cv_pt"), "app_", ["codigo_candidato"])
    df = df.join(applicants(spark, sf).select("codigo_candidato", "cv_pt"), "codigo_candidato")
    df = joins.add_if_absent(joins.rename_if_absent(df, "cv_pt", "app_cv_pt"), "p_comentario", F.lit(""))
    kept = features.drop_personal_data(df)
    return kept.select("codigo_candidato", "app_ib_local", "app_cv_pt", "p_comentario")


@query("typed_columns", "P14,P15", """
    SELECT doc_id, n_chars FROM documents UNION ALL SELECT vec_id, label FROM embeddings""")
def _(spark, sf):
    out = None
    for name in ("documents", "embeddings"):
        df = table(spark, sf, name)
        numeric, _ = flatten.split_types(df)
        part = df.select(*flatten.pick_existing(df, [*numeric, "absent"])).toDF("doc_id", "n_chars")
        out = part if out is None else joins.union_relaxed(out, part)
    return out


@query("plain_filters", "P19", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority IS NOT NULL")
def _(spark, sf):
    return table(spark, sf, "orders").where((F.col("o_orderstatus") == "P") & F.col("o_orderpriority").isNotNull()).select("o_orderkey")


# -------------------------------------------------------------------------------------- joins
@query("join_entities", "J1,P5", f"""
    WITH {JOINED_SQL} SELECT codigo_vaga, codigo_candidato, linha, p_situacao_candidado, app_ib_local, job_ib_titulo_vaga FROM joined""")
def _(spark, sf):
    return joined(spark, sf).select("codigo_vaga", "codigo_candidato", "linha", "p_situacao_candidado", "app_ib_local", "job_ib_titulo_vaga")


@query("join_renamed_keys", "J2,P6", f"""
    WITH {CURATED_SQL} SELECT p.codigo_vaga, p.p_codigo, p.linha, a.ib_nome AS app_ib_nome, j.ib_nome AS job_ib_nome
    FROM prospects p JOIN applicants a ON p.p_codigo = a.codigo_candidato JOIN jobs j ON p.codigo_vaga = j.codigo_vaga""")
def _(spark, sf):
    a, j = joins.prefix_columns(applicants(spark, sf), "app_"), joins.prefix_columns(jobs(spark, sf), "job_")
    df = joins.join_renamed(prospects(spark, sf), a, "p_codigo", "app_codigo_candidato")
    return joins.join_renamed(df, j, "codigo_vaga", "job_codigo_vaga").select(
        "codigo_vaga", "p_codigo", "linha", "app_ib_nome", "job_ib_nome")


@query("attach_scores", "J3", """
    WITH s AS (SELECT l_orderkey, l_partkey, count(*) * 1.5::double AS score FROM lineitem WHERE l_quantity > 10 GROUP BY 1, 2)
    SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, s.score FROM lineitem l LEFT JOIN s USING (l_orderkey, l_partkey)""")
def _(spark, sf):
    li, keys = table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"]
    scores = li.where("l_quantity > 10").groupBy(*keys).agg((F.count("*") * 1.5).alias("score"))
    return joins.attach(li.select(*keys, "l_linenumber"), scores, keys)


@query("enrich_extracted", "J4", """
    SELECT l_orderkey::varchar AS codigo_vaga, l_partkey::varchar AS codigo_candidato, l_linenumber, o_orderpriority AS job_x, c_mktsegment AS app_x
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus <> 'P' JOIN customer ON l_partkey = c_custkey AND c_custkey % 3 <> 0""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").selectExpr("cast(l_orderkey as string) codigo_vaga", "cast(l_partkey as string) codigo_candidato", "l_linenumber")
    done_jobs = table(spark, sf, "orders").where("o_orderstatus <> 'P'").selectExpr("cast(o_orderkey as string) codigo_vaga", "o_orderpriority job_x")
    done_people = table(spark, sf, "customer").where("c_custkey % 3 <> 0").selectExpr("cast(c_custkey as string) codigo_candidato", "c_mktsegment app_x")
    return joins.enrich(li, done_jobs, done_people)


@query("anti_new_ids", "J5", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, sf):
    return joins.not_in(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id").select("doc_id", "lang")


@query("except_ids", "J6,U2", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def _(spark, sf):
    processed = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.new_ids(table(spark, sf, "customer"), processed, "c_custkey")


RARE_SQL = """
    WITH {sql}, c AS (SELECT {value} AS v, count(*) AS n FROM prospects GROUP BY 1)
    SELECT codigo_vaga, linha, CASE WHEN {value} IS NULL OR n >= 10 THEN {value} ELSE 'Outros' END AS p_recrutador_tratado
    FROM prospects LEFT JOIN c ON v = {value}"""


@query("rare_category", "F22,J7,A1", RARE_SQL.format(sql=CURATED_SQL, value="p_recrutador"))
def _(spark, sf):
    return features.rare_recruiters(prospects(spark, sf)).select("codigo_vaga", "linha", "p_recrutador_tratado")


@query("rare_category_filled", "F22,J7", RARE_SQL.format(sql=CURATED_SQL, value="coalesce(p_recrutador, 'Desconhecido')"))
def _(spark, sf):
    return features.rare_recruiters(prospects(spark, sf), missing=features.UNKNOWN_RECRUITER).select(
        "codigo_vaga", "linha", "p_recrutador_tratado")


# ------------------------------------------------------------------------------- array set ops
@query("skill_union", "U3", """
    SELECT p_partkey, array_to_string(list_sort(list_distinct(list_concat(string_split(p_name, ' '), [p_type, 'red']))), ',') AS skills FROM part""")
def _(spark, sf):
    both = matching.list_union(F.split("p_name", " "), F.array(F.col("p_type"), F.lit("red")))
    return table(spark, sf, "part").select("p_partkey", F.array_join(F.array_sort(both), ",").alias("skills"))


@query("list_coverage", "U4", """
    WITH s AS (SELECT l_orderkey, l_linenumber, string_split(p.p_name, ' ') AS have,
        CASE WHEN l_linenumber = 7 THEN [] WHEN l_linenumber = 6 THEN list_concat(string_split(q.p_name, ' '), string_split(q.p_name, ' '))
             ELSE string_split(q.p_name, ' ') END AS need
      FROM lineitem JOIN part p ON l_partkey = p.p_partkey JOIN part q ON l_suppkey = q.p_partkey)
    SELECT l_orderkey, l_linenumber, round(CASE WHEN len(need) = 0 THEN 1.0 ELSE len(list_intersect(have, need))::double / len(need) END, 6) AS covered FROM s""")
def _(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    df = (table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
          .join(part.toDF("l_partkey", "have"), "l_partkey").join(part.toDF("l_suppkey", "need"), "l_suppkey"))
    need = (F.when(F.col("l_linenumber") == 7, F.array().cast("array<string>"))
            .when(F.col("l_linenumber") == 6, F.concat("need", "need")).otherwise(F.col("need")))
    return df.select("l_orderkey", "l_linenumber", matching.list_coverage(F.col("have"), need).alias("covered")).withColumn("covered", r("covered"))


FEATURE_COLUMNS = ["ind_app_email", "ind_app_linkedin", "job_ib_prioridade_vaga", "tempo_vaga_aberta", "dias_desde_requisicao",
                   "job_ind_beneficios_declarados", "match_pcd"]


@query("feature_table", "J1,P9,P10,P17,F7,F8,F10,F15,F16", f"""
    WITH {JOINED_SQL}, t AS (SELECT max(p_data_candidatura)::timestamp AS today FROM joined)
    SELECT codigo_vaga, codigo_candidato, linha, {sql_filled('app_ib_email')} AS ind_app_email, {sql_filled('app_ip_url_linkedin')} AS ind_app_linkedin,
      CASE WHEN job_ib_prioridade_vaga LIKE '%HIGH%' THEN 'ALTA' WHEN job_ib_prioridade_vaga LIKE '%MEDIUM%' THEN 'MEDIA'
           WHEN job_ib_prioridade_vaga LIKE '%LOW%' THEN 'BAIXA' ELSE 'DESCONHECIDO' END AS job_ib_prioridade_vaga,
      greatest(coalesce(date_sub('day', job_ib_data_inicial::timestamp, job_ib_data_final::timestamp), -1), 0) AS tempo_vaga_aberta,
      greatest(coalesce(date_sub('day', job_ib_data_requicisao::timestamp, today), -1), 0) AS dias_desde_requisicao,
      {sql_filled('job_b_valor_venda')} OR {sql_filled('job_b_valor_compra_1')} OR {sql_filled('job_b_valor_compra_2')} AS job_ind_beneficios_declarados,
      coalesce(job_pv_vaga_especifica_para_pcd = 'SIM', false) AND {sql_filled('app_ip_pcd')} AS match_pcd,
      'app_ip_nome' AS hidden FROM joined, t""")
def _(spark, sf):
    df = features.build_features(joined(spark, sf))
    leaked = [c for c in features.PII_COLUMNS_FULL if c in df.columns]
    hidden = "app_ip_nome" if not leaked else ",".join(leaked)
    return df.select("codigo_vaga", "codigo_candidato", "linha", *FEATURE_COLUMNS, F.lit(hidden).alias("hidden"))


# Longest common subsequences by anti-diagonals: cell i of diagonal d is the length for i characters of the short name and
# d - i of the window, from the two diagonals before; the last cell of the last diagonal is the length for both.
LOCATION_SQL = """
    WITH RECURSIVE place AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
    rows AS (SELECT l_orderkey, l_linenumber, c.n_name || ' ' || c.r_name AS c_place, c.r_name AS c_region, s.r_name || ', ' || s.n_name AS s_place,
        CASE WHEN s_suppkey % 2 = 0 THEN s.n_name END AS s_nation
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN place c ON c_nationkey = c.n_nationkey
      JOIN supplier ON l_suppkey = s_suppkey JOIN place s ON s_nationkey = s.n_nationkey),
    tuples AS (SELECT DISTINCT c_place, c_region, s_place, s_nation FROM rows),
    met AS (SELECT *, unnest([c_place, c_region]) AS x, NULL AS y FROM tuples),
    names AS (SELECT c_place, c_region, s_place, s_nation, upper(x) AS a, upper(unnest([s_place, s_nation])) AS b FROM met),
    pairs AS (SELECT DISTINCT a, b FROM names WHERE a <> '' AND b <> ''),
    sides AS (SELECT a, b, a AS s, b AS l FROM pairs WHERE length(a) <= length(b) UNION ALL SELECT a, b, b, a FROM pairs WHERE length(b) <= length(a)),
    cuts AS (SELECT a, b, s, l[p:p + length(s) - 1] AS w FROM (SELECT *, unnest(range(1, length(l) + 1)) AS p FROM sides)
      UNION SELECT a, b, s, l[1:p] FROM (SELECT *, unnest(range(1, length(s))) AS p FROM sides)),
    lcs AS (SELECT s, w, 0 AS d, [0 FOR i IN range(0, length(s) + 1)] AS d1, [0 FOR i IN range(0, length(s) + 1)] AS d2 FROM (SELECT DISTINCT s, w FROM cuts)
      UNION ALL SELECT s, w, d + 1, [CASE WHEN i >= 1 AND d + 1 - i BETWEEN 1 AND length(w)
          THEN greatest(d1[i], d1[i + 1], d2[i] + CASE WHEN s[i] = w[d + 1 - i] THEN 1 ELSE 0 END) ELSE 0 END FOR i IN range(0, length(s) + 1)], d1
      FROM lcs WHERE d < length(s) + length(w)),
    score AS (SELECT a, b, max(200.0::double * d1[length(s) + 1] / (length(s) + length(w))) AS best FROM cuts JOIN lcs USING (s, w) WHERE d = length(s) + length(w) GROUP BY a, b),
    near AS (SELECT c_place, c_region, s_place, s_nation, bool_or(coalesce(best >= 70, false)) AS near FROM names LEFT JOIN score USING (a, b) GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, rows.c_place, rows.s_place, near AS ind_mesma_localidade FROM rows JOIN near ON near.c_place = rows.c_place
      AND near.c_region = rows.c_region AND near.s_place = rows.s_place AND near.s_nation IS NOT DISTINCT FROM rows.s_nation"""


@query("fuzzy_location", "J9", LOCATION_SQL)
def _(spark, sf):
    """Customer place against supplier place of every line item."""
    from rosterlake.operators.location import with_same_place
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    place = nation.select("n_nationkey", "n_name", "r_name")
    people = joins.join_renamed(table(spark, sf, "customer"), place, "c_nationkey", "n_nationkey").select(
        "c_custkey", F.concat_ws(" ", "n_name", "r_name").alias("c_place"), F.col("r_name").alias("c_region"))
    sites = joins.join_renamed(table(spark, sf, "supplier"), place, "s_nationkey", "n_nationkey").select(
        "s_suppkey", F.concat_ws(", ", "r_name", "n_name").alias("s_place"), F.when(F.col("s_suppkey") % 2 == 0, F.col("n_name")).alias("s_nation"))
    df = (table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
          .join(people, F.col("o_custkey") == F.col("c_custkey")).join(sites, F.col("l_suppkey") == F.col("s_suppkey")))
    return with_same_place(df, ["c_place", "c_region"], ["s_place", "s_nation"], 70).select(
        "l_orderkey", "l_linenumber", "c_place", "s_place", "ind_mesma_localidade")




