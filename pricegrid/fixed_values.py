"""Names, codes and lookup tables that results depend on.

Nothing here is computed. Each table is listed in the order in which it is
consulted; for alias and key lists the first match wins.
"""

# Federative unit -> macro-region (27 entries).
REGION_BY_UF = {
    "AC": "Norte",
    "AP": "Norte",
    "AM": "Norte",
    "PA": "Norte",
    "RO": "Norte",
    "RR": "Norte",
    "TO": "Norte",
    "AL": "Nordeste",
    "BA": "Nordeste",
    "CE": "Nordeste",
    "MA": "Nordeste",
    "PB": "Nordeste",
    "PE": "Nordeste",
    "PI": "Nordeste",
    "RN": "Nordeste",
    "SE": "Nordeste",
    "DF": "Centro-Oeste",
    "GO": "Centro-Oeste",
    "MT": "Centro-Oeste",
    "MS": "Centro-Oeste",
    "ES": "Sudeste",
    "MG": "Sudeste",
    "RJ": "Sudeste",
    "SP": "Sudeste",
    "PR": "Sul",
    "RS": "Sul",
    "SC": "Sul",
}

# Canonical column -> source names, first present wins.
COLUMN_ALIASES = {
    "codigo_item_catalogo": ("codigo_item_catalogo", "codigoitemcatalogo", "catmat", "_catmat"),
    "descricao_item": ("descricao_item", "descricaoitem", "descricao"),
    "unidade_original": (
        "nome_unidade_medida",
        "nomeunidademedida",
        "sigla_unidade_medida",
        "siglaunidademedida",
        "unidade",
        "unidade_medida",
    ),
    "quantidade": ("quantidade", "qtd"),
    "preco_unitario": ("preco_unitario", "precounitario", "valor_unitario", "valorunitario"),
    "data_compra": ("data_compra", "datacompra"),
    "data_resultado": ("data_resultado", "dataresultado"),
    "data_hora_atualizacao_compra": ("data_hora_atualizacao_compra", "datahoraatualizacaocompra"),
    "data_hora_atualizacao_item": ("data_hora_atualizacao_item", "datahoraatualizacaoitem"),
    "uf": ("estado", "uf", "sigla_uf", "siglauf"),
    "municipio": ("municipio", "nome_municipio", "nomemunicipio"),
    "codigo_municipio": ("codigo_municipio", "codigomunicipio"),
    "codigo_uasg": ("codigo_uasg", "codigouasg"),
    "nome_uasg": ("nome_uasg", "nomeuasg"),
    "codigo_orgao": ("codigo_orgao", "codigoorgao"),
    "nome_orgao": ("nome_orgao", "nomeorgao"),
    "ni_fornecedor": ("ni_fornecedor", "nifornecedor", "cnpj_cpf_fornecedor"),
    "nome_fornecedor": ("nome_fornecedor", "nomefornecedor"),
    "modalidade": ("modalidade", "nome_modalidade", "nomemodalidade"),
    "esfera": ("esfera",),
    "poder": ("poder",),
    "id_compra": ("id_compra", "idcompra"),
    "id_item_compra": ("id_item_compra", "iditemcompra"),
    "record_hash": ("_record_hash", "record_hash"),
    "pipeline_run_id": ("_pipeline_run_id", "pipeline_run_id"),
    "ingestion_timestamp": ("_ingestion_timestamp", "ingestion_timestamp"),
    "extract_type": ("_extract_type", "extract_type"),
}

# How canonical columns are typed; every other one is a string.
NUMBER_COLUMNS = ("quantidade", "preco_unitario")
TIMESTAMP_COLUMNS = (
    "data_compra",
    "data_resultado",
    "data_hora_atualizacao_compra",
    "data_hora_atualizacao_item",
    "ingestion_timestamp",
)
TRIMMED_COLUMNS = (
    "descricao_item",
    "unidade_original",
    "uf",
    "municipio",
    "nome_uasg",
    "nome_orgao",
    "nome_fornecedor",
    "modalidade",
    "esfera",
    "poder",
)

# Keys under which a page keeps its records and its page count.
RECORD_KEYS = ("resultado", "resultados", "data", "dados", "items", "content", "registros")
TOTAL_PAGE_KEYS = ("totalPaginas", "total_paginas", "totalPages", "pages", "total_pages")
PAGE_INFO_KEYS = ("paginacao", "pagination", "meta", "metadata")

# The record source label and the extract types.
SOURCE_LABEL = "compras.gov.br"
EXTRACT_TYPES = ("FULL", "INCREMENTAL")

# Catalogue columns joined onto a record.
CATALOGUE_COLUMNS = ("material_id", "material", "categoria_material", "unidade_padrao")

# Validity flag -> issue code, in the order codes are listed.
ISSUE_CODES = {
    "is_valid_catmat": "CATMAT_INVALIDO",
    "is_valid_date": "DATA_COMPRA_INVALIDA",
    "is_valid_price": "PRECO_INVALIDO",
    "is_valid_quantity": "QUANTIDADE_INVALIDA",
    "is_valid_uf": "UF_INVALIDA",
}

# Keys of a purchase line, mart grains and series keys.
TECHNICAL_KEY = ("id_compra", "id_item_compra", "codigo_item_catalogo")
HASHED_FIELDS = (
    "id_compra",
    "id_item_compra",
    "codigo_item_catalogo",
    "quantidade",
    "preco_unitario",
    "data_compra",
    "ni_fornecedor",
)
MONTHLY_DIMENSIONS = (
    "codigo_item_catalogo",
    "material_id",
    "material",
    "categoria_material",
    "unidade_normalizada",
    "ano",
    "mes",
    "ano_mes",
)
STATE_DIMENSIONS = (
    "codigo_item_catalogo",
    "material_id",
    "material",
    "categoria_material",
    "unidade_normalizada",
    "uf",
    "regiao",
    "ano",
    "mes",
    "ano_mes",
)
MONTHLY_SERIES = ("codigo_item_catalogo", "material_id")
STATE_SERIES = ("codigo_item_catalogo", "material_id", "uf")
REQUIRED_FOR_MARTS = ("codigo_item_catalogo", "data_compra", "preco_normalizado", "quantidade")

# Names of the published tables.
MONTHLY_TABLE = "material_price_monthly"
STATE_TABLE = "material_price_state_monthly"

# Audit table columns, in order.
AUDIT_COLUMNS = (
    "run_id",
    "material_id",
    "catmat",
    "inicio",
    "fim",
    "duracao_segundos",
    "paginas_consultadas",
    "registros_recebidos",
    "registros_novos",
    "registros_atualizados",
    "registros_duplicados",
    "registros_invalidos",
    "outliers",
    "watermark_anterior",
    "watermark_novo",
    "status",
    "erro",
)
