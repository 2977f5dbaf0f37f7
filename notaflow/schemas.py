"""Declared table shapes and contract loading (SRC-8, SRC-9, SNK-4, CHK-1).

FIXED VALUES — column names, types and required flags of the tables the
reference declares, in their declared order.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, DoubleType, LongType,
                               StringType, StructField, StructType, TimestampType)

# Invoice table (27 columns, all nullable); money is decimal(18,2) inside the engine.
INVOICE = [
    ("numero_nfse", "STRING"), ("codigo_verificacao", "STRING"), ("data_emissao", "DATE"),
    ("data_competencia", "DATE"), ("prestador_cnpj", "STRING"), ("prestador_razao_social", "STRING"),
    ("tomador_cnpj", "STRING"), ("tomador_cpf", "STRING"), ("tomador_razao_social", "STRING"),
    ("tomador_endereco", "STRING"), ("tomador_municipio", "STRING"), ("tomador_uf", "STRING"),
    ("tomador_cep", "STRING"), ("valor_servicos", "MONEY"), ("valor_deducoes", "MONEY"),
    ("valor_pis", "MONEY"), ("valor_cofins", "MONEY"), ("valor_inss", "MONEY"), ("valor_ir", "MONEY"),
    ("valor_csll", "MONEY"), ("valor_iss", "MONEY"), ("valor_liquido", "MONEY"),
    ("discriminacao", "STRING"), ("item_lista_servico", "STRING"), ("data_processamento", "DATE"),
    ("origem_consulta", "STRING"), ("hash_nfse", "STRING"),
]

# Flexible raw table (15 columns); arquivo_nome is required.
RAW = [
    ("arquivo_nome", "STRING", True), ("arquivo_tipo", "STRING", False), ("aba_nome", "STRING", False),
    ("dados_json", "STRING", False), ("cnpj", "STRING", False), ("data_emissao", "DATE", False),
    ("valor", "FLOAT", False), ("cliente", "STRING", False), ("linha_original", "INTEGER", False),
    ("hash_linha", "STRING", False), ("_ingestion_timestamp", "TIMESTAMP", False),
    ("_ingestion_batch_id", "STRING", False), ("_source_bucket", "STRING", False),
    ("_processing_status", "STRING", False), ("_processing_error", "STRING", False),
]

# File metadata table (16 columns).
FILE_METADATA = [
    ("arquivo_nome", "STRING", True), ("arquivo_hash", "STRING", False), ("tamanho_bytes", "INTEGER", False),
    ("data_modificacao", "TIMESTAMP", False), ("total_abas", "INTEGER", False),
    ("abas_nomes", "ARRAY<STRING>", False), ("total_linhas", "INTEGER", False),
    ("colunas_detectadas", "ARRAY<STRING>", False), ("tipo_arquivo", "STRING", False),
    ("periodo_inicio", "DATE", False), ("periodo_fim", "DATE", False), ("status", "STRING", False),
    ("erro_mensagem", "STRING", False), ("criado_em", "TIMESTAMP", False),
    ("processado_em", "TIMESTAMP", False), ("movido_para_armazenados", "BOOLEAN", False),
]

# Tax rows contract (10 columns).
NF_TRIBUTOS = [
    ("id", "STRING", True), ("numero_nfse", "STRING", True), ("tipo_tributo", "STRING", True),
    ("valor", "NUMERIC(15,2)", True), ("base_calculo", "NUMERIC(15,2)", False), ("aliquota", "NUMERIC(5,2)", False),
    ("retido", "BOOLEAN", False), ("responsavel_retencao", "STRING", False), ("observacoes", "STRING", False),
    ("data_criacao", "TIMESTAMP", True),
]

# Submission log contract (17 columns).
RPS_LOG = [
    ("id", "STRING", True), ("rps_numero", "STRING", True), ("rps_serie", "STRING", True),
    ("rps_tipo", "STRING", True), ("data_envio", "TIMESTAMP", True), ("protocolo", "STRING", False),
    ("status", "STRING", True), ("numero_nfse_gerado", "STRING", False), ("codigo_erro", "STRING", False),
    ("mensagem_erro", "STRING", False), ("xml_enviado", "STRING", False), ("xml_resposta", "STRING", False),
    ("tentativa", "INTEGER", True), ("tempo_processamento_segundos", "NUMERIC(10,2)", False),
    ("data_processamento", "TIMESTAMP", False), ("data_criacao", "TIMESTAMP", True),
    ("data_atualizacao", "TIMESTAMP", False),
]

# FIXED VALUES — the wide invoice contract: name, type, required, in the contract's order.
NF_EMITIDAS = [
    ("id", "STRING", True), ("numero_nfse", "STRING", True), ("codigo_verificacao", "STRING", True),
    ("data_emissao", "TIMESTAMP", True), ("data_competencia", "DATE", False), ("status_nfse", "STRING", True),
    ("nfse_substituida", "STRING", False), ("prestador_cnpj", "STRING", True),
    ("prestador_inscricao_municipal", "STRING", False), ("prestador_razao_social", "STRING", True),
    ("prestador_nome_fantasia", "STRING", False), ("prestador_endereco", "STRING", False),
    ("prestador_numero", "STRING", False), ("prestador_complemento", "STRING", False),
    ("prestador_bairro", "STRING", False), ("prestador_codigo_municipio", "STRING", False),
    ("prestador_uf", "STRING", False), ("prestador_cep", "STRING", False), ("prestador_telefone", "STRING", False),
    ("prestador_email", "STRING", False), ("tomador_cpf_cnpj", "STRING", False),
    ("tomador_inscricao_municipal", "STRING", False), ("tomador_razao_social", "STRING", False),
    ("tomador_endereco", "STRING", False), ("tomador_numero", "STRING", False),
    ("tomador_complemento", "STRING", False), ("tomador_bairro", "STRING", False),
    ("tomador_codigo_municipio", "STRING", False), ("tomador_uf", "STRING", False), ("tomador_cep", "STRING", False),
    ("tomador_telefone", "STRING", False), ("tomador_email", "STRING", False),
    ("intermediario_cpf_cnpj", "STRING", False), ("intermediario_razao_social", "STRING", False),
    ("valor_servicos", "NUMERIC(15,2)", True), ("valor_deducoes", "NUMERIC(15,2)", False),
    ("valor_pis", "NUMERIC(15,2)", False), ("valor_cofins", "NUMERIC(15,2)", False),
    ("valor_inss", "NUMERIC(15,2)", False), ("valor_ir", "NUMERIC(15,2)", False),
    ("valor_csll", "NUMERIC(15,2)", False), ("outras_retencoes", "NUMERIC(15,2)", False),
    ("valor_total_tributos", "NUMERIC(15,2)", False), ("base_calculo", "NUMERIC(15,2)", False),
    ("aliquota", "NUMERIC(5,2)", False), ("valor_iss", "NUMERIC(15,2)", False),
    ("valor_iss_retido", "NUMERIC(15,2)", False), ("valor_liquido_nfse", "NUMERIC(15,2)", True),
    ("valor_credito", "NUMERIC(15,2)", False), ("desconto_incondicionado", "NUMERIC(15,2)", False),
    ("desconto_condicionado", "NUMERIC(15,2)", False), ("iss_retido", "BOOLEAN", False),
    ("responsavel_retencao", "STRING", False), ("item_lista_servico", "STRING", False),
    ("codigo_cnae", "STRING", False), ("codigo_tributacao_municipio", "STRING", False),
    ("codigo_nbs", "STRING", False), ("discriminacao", "STRING", False),
    ("codigo_municipio_prestacao", "STRING", False), ("codigo_pais", "STRING", False),
    ("exigibilidade_iss", "STRING", False), ("municipio_incidencia", "STRING", False),
    ("numero_processo", "STRING", False), ("rps_numero", "STRING", False), ("rps_serie", "STRING", False),
    ("rps_tipo", "STRING", False), ("rps_data_emissao", "DATE", False), ("codigo_obra", "STRING", False),
    ("art", "STRING", False), ("regime_especial_tributacao", "STRING", False),
    ("optante_simples_nacional", "BOOLEAN", False), ("incentivo_fiscal", "BOOLEAN", False),
    ("outras_informacoes", "STRING", False), ("orgao_gerador_municipio", "STRING", False),
    ("orgao_gerador_uf", "STRING", False), ("xml_original", "STRING", False), ("url_nfse", "STRING", False),
    ("data_processamento", "TIMESTAMP", True), ("data_criacao", "TIMESTAMP", True),
    ("data_atualizacao", "TIMESTAMP", False),
]

NF_EMITIDAS_REQUIRED = tuple(name for name, _, required in NF_EMITIDAS if required)


def spark_type(t: str) -> DataType:
    t = t.strip().upper()
    if t == "MONEY":
        return DecimalType(18, 2)
    if t.startswith("NUMERIC(") or t.startswith("DECIMAL("):
        p, s = t[t.index("(") + 1:-1].split(",")
        return DecimalType(int(p), int(s))
    if t == "NUMERIC":
        return DecimalType(15, 2)
    if t.startswith("ARRAY<"):
        from pyspark.sql.types import ArrayType
        return ArrayType(spark_type(t[6:-1]))
    return {"STRING": StringType(), "INTEGER": LongType(), "INT64": LongType(), "FLOAT": DoubleType(),
            "FLOAT64": DoubleType(), "BOOLEAN": BooleanType(), "BOOL": BooleanType(), "DATE": DateType(),
            "TIMESTAMP": TimestampType(), "DATETIME": TimestampType()}[t]


def struct(columns) -> StructType:
    """(name, type[, required]) triples -> StructType (required -> not nullable)."""
    return StructType([StructField(c[0], spark_type(c[1]), nullable=not (len(c) > 2 and c[2]))
                       for c in columns])


def required_columns(columns) -> list[str]:
    return [c[0] for c in columns if len(c) > 2 and c[2]]


def load_contract(text: str) -> list[tuple[str, str, bool]]:
    """SRC-9: a JSON column list ``[{name, type, mode}]`` -> (name, type, required)."""
    out = []
    for f in json.loads(text):
        t = f["type"].upper()
        if t == "NUMERIC" and "precision" in f:
            t = f"NUMERIC({f['precision']},{f.get('scale', 0)})"
        out.append((f["name"], t, f.get("mode", "NULLABLE").upper() == "REQUIRED"))
    return out


def table_schema(spark: SparkSession, path: str) -> dict[str, str]:
    """SRC-8: column name -> type of a stored table (metadata only)."""
    return {f.name: f.dataType.simpleString() for f in spark.read.parquet(path).schema.fields}
