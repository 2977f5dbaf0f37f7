"""Thresholds, weights and labels of every rule, held as data.

FIXED VALUES — these must equal the reference's literals for results to
match; they are stated here together, in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass

# Fixed as-of date used by the test adapter (FIXTURES.md §3).
ADAPTER_AS_OF = "2001-11-15"

# ---------------------------------------------------------------- fixed values
# File-type labels and the fallback label shared by ingest and staging.
TYPE_HISTORIC_BILLING = "faturamento_historico"
TYPE_OLD_COMPANIES = "empresas_antigas"
TYPE_CURRENT_CLIENTS = "clientes_atuais"
TYPE_FALLBACK = "desconhecido"
TYPE_ERROR = "erro"
HISTORIC_YEARS = ("2006", "2007", "2008", "2009", "2010")

BILLING_TYPES = (TYPE_HISTORIC_BILLING, TYPE_CURRENT_CLIENTS, TYPE_FALLBACK)
COMPANY_TYPES = (TYPE_OLD_COMPANIES, TYPE_FALLBACK)

STATUS_PROCESSED = "processed"
STATUS_PENDING = "pending"
STATUS_ERROR = "error"

# Target table per file type (default generic).
TABLE_BY_TYPE = {
    TYPE_HISTORIC_BILLING: "faturamento_historico",
    TYPE_OLD_COMPANIES: "empresas_antigas",
    TYPE_CURRENT_CLIENTS: "clientes_atuais",
}
TABLE_DEFAULT = "dados_genericos"

# Cells treated as blank (whole-cell match).
BLANK_CELLS = ("nan", "None", "NaT", ".", "")

# Spreadsheet serial day zero and the largest serial day accepted (9999-12-31).
SERIAL_EPOCH = "1899-12-30"
SERIAL_MAX = 2958465

STRING_CELL_LIMIT = 1000
NAME_DEFAULT = "Nome não identificado"

# Staging document keys, in coalesce order.
KEYS_CLIENTE = ("cliente", "Cliente", "CLIENTE", "razao_social", "empresa", "EMPRESA")
KEYS_DATE_ISO = ("data_emissao", "data", "Data")
KEYS_DATE_SERIAL = ("emissao", "Emissão")
KEYS_CNPJ = ("cnpj", "CNPJ")
KEYS_NUMERO = ("nota_fiscal", "numero_nota", "Num.", "Nota Fiscal nº", "Nota_Fiscal_nº")
KEYS_LIQUIDO = ("valor_liquido", "Liquido", "Líquido", "valor_nota_fiscal",
                "VALOR_NOTA_FISCAL", "VALOR NOTA FISCAL")
KEYS_BRUTO = ("valor_bruto", "Bruto")
KEYS_HONORARIOS = ("honorarios", "Honorários")
KEY_TIPO, KEY_SITUACAO, KEY_CONSULTOR = "tipo", "situacao", "consultor"

KEYS_RAZAO = ("razao_social", "Razão_Social", "Razão Social", "razão_social")
KEYS_FANTASIA = ("nome_fantasia", "Nome_Fantasia", "Nome Fantasia")
KEYS_SITUACAO_CAD = ("situacao_cadastral", "Situação_Cadastral", "Situação Cadastral")
KEYS_DATA_SITUACAO = ("data_situacao", "Data_Situação", "Data Situação")
KEYS_ENDERECO = ("endereco", "Endereço")

# Contract domains.
NFSE_STATUS = ("Normal", "Cancelado")
TAX_TYPES = ("PIS", "COFINS", "INSS", "IR", "CSLL", "ISS", "OUTROS")
RPS_STATUS = ("ENVIADO", "PROCESSANDO", "SUCESSO", "ERRO", "CANCELADO")
RPS_TYPES = ("1", "2", "3")

# Calendar range (inclusive).
CALENDAR_START = "2006-01-01"
CALENDAR_END = "2030-12-31"

# Check-digit weights (public CNPJ / CPF rule).
CNPJ_W1 = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
CNPJ_W2 = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
CPF_W1 = (10, 9, 8, 7, 6, 5, 4, 3, 2)
CPF_W2 = (11, 10, 9, 8, 7, 6, 5, 4, 3, 2)


@dataclass(frozen=True)
class Rules:
    """Band tables: (bound, value) pairs checked in order, then a default."""

    # customer performance
    reactivation_days: tuple = ((30, 100), (90, 80), (180, 60), (365, 40))
    reactivation_default: int = 20
    value_class: tuple = ((50000, "PREMIUM"), (20000, "ALTO_VALOR"), (5000, "MEDIO_VALOR"))
    value_class_default: str = "BAIXO_VALOR"
    value_class_weight: tuple = (("PREMIUM", 100), ("ALTO_VALOR", 80), ("MEDIO_VALOR", 60))
    value_class_weight_default: int = 40
    activity_days: tuple = ((90, "ATIVO"), (365, "INATIVO_RECENTE"))
    activity_default: str = "INATIVO_LONGO"
    crosssell_potential: tuple = ((12, 5000, "ALTO"), (6, 2000, "MEDIO"))
    crosssell_potential_default: str = "BAIXO"
    ltv_years: int = 2
    opportunity_weights: tuple = (0.4, 0.6)
    # geography
    recent_months: int = 12
    market_class: tuple = ((100000, 10, "MERCADO_MADURO"), (50000, 5, "OPORTUNIDADE_ALTA"),
                           (20000, 3, "OPORTUNIDADE_MEDIA"), (0, 1, "MERCADO_EMERGENTE"))
    market_default: str = "NAO_ATENDIDO"
    market_weight: tuple = (("OPORTUNIDADE_ALTA", 4), ("OPORTUNIDADE_MEDIA", 3),
                            ("MERCADO_EMERGENTE", 2), ("MERCADO_MADURO", 1))
    roi_factor: int = 10
    # executive KPIs
    growth_class: tuple = ((20, "EXCELENTE"), (10, "BOM"), (0, "ESTAVEL"))
    growth_default: str = "DECLINIO"
    recovery_target: float = 0.15
    moving_rows: int = 3
    # sales opportunities
    upsell: tuple = ((50000, 12, 100), (20000, 6, 80), (10000, 3, 60), (5000, 0, 40))
    upsell_default: int = 20
    crosssell_score: tuple = ((1, 100), (2, 70), (3, 50))
    crosssell_default: int = 30
    urgency_days: tuple = ((30, "URGENTE"), (90, "ALTA"), (180, "MEDIA"))
    urgency_default: str = "BAIXA"
    extra_revenue_factor: int = 3
    final_weights: tuple = (0.6, 0.4)
    # tax recovery
    recovery_factor: float = 1.2
    fee_factor: float = 0.30
    recovery_class: tuple = ((10000, "ALTO_POTENCIAL"), (5000, "MEDIO_POTENCIAL"),
                             (1000, "BAIXO_POTENCIAL"))
    recovery_class_default: str = "SEM_POTENCIAL"
    recovery_priority: tuple = ((10000, 90, 100), (5000, 180, 80), (1000, 365, 60))
    recovery_priority_default: int = 30
    # customer dimension
    status_months: tuple = ((12, "ATIVO"), (24, "INATIVO_RECENTE"), (36, "INATIVO_MEDIO"))
    status_old: str = "INATIVO_ANTIGO"
    status_none: str = "SEM_NOTAS"
    segment: tuple = ((50000, "VIP"), (20000, "PREMIUM"), (5000, "STANDARD"))
    segment_default: str = "LOW_TICKET"
    # documented client score (README prose)
    score_registration: tuple = (("ATIVA", 40), ("INAPTA", 20))
    score_revenue: tuple = ((1000000, 30), (500000, 25), (200000, 20))
    score_notes: tuple = ((50, 20), (20, 15))
    client_class: tuple = ((80, 1000000, "OPORTUNIDADE_PREMIUM"), (60, 500000, "OPORTUNIDADE_ALTA"),
                           (40, 100000, "OPORTUNIDADE_MÉDIA"))
    class_active_low: str = "CLIENTE_ATIVO_BAIXO_POTENCIAL"
    class_inactive: str = "CLIENTE_INATIVO_RECUPERÁVEL"
    class_other: str = "SEM_HISTORICO"
    action_revenue: tuple = ((1000000, "CONTATO_IMEDIATO_PREMIUM"), (500000, "CONTATO_PRIORITARIO"),
                             (100000, "INCLUIR_CAMPANHA_COMERCIAL"))
    action_reactivate: str = "CAMPANHA_REATIVACAO"
    action_default: str = "MONITORAR"
    # incremental windows
    history_months: int = 24
    window_days: int = 30
    lookback_hours: int = 72
    daily_validation_lot: int = 150


RULES = Rules()

#: The raw table's document as a Variant, where it is written with one.
VARIANT_COLUMN = "documento"
