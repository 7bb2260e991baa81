"""Column roles, presets and business constants.

Every operator in the library is ``op(df, roles, **params) -> DataFrame``.
``PanelRoles`` names which column of the input plays which part (price,
cost, product, ...), so the same operators run on any price panel: raw
fuel-price CSVs (``FUEL``) or the star-schema test tables (``STAR``).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# These must equal the reference's business rules exactly.
# ---------------------------------------------------------------------------

# Product synonyms -> canonical product (unmapped values keep their text).
FUEL_PRODUCT_MAP = {
    "GASOLINA": "GASOLINA COMUM",
    "GASOLINA COMUM": "GASOLINA COMUM",
    "GASOLINA ADITIVADA": "GASOLINA ADITIVADA",
    "ALCOOL": "ETANOL",
    "ETANOL": "ETANOL",
    "DIESEL": "ÓLEO DIESEL",
    "ÓLEO DIESEL": "ÓLEO DIESEL",
    "ÓLEO DIESEL S10": "ÓLEO DIESEL S10",
    "DIESEL S10": "ÓLEO DIESEL S10",
    "GNV": "GNV",
    "GLP": "GLP",
}

# Region synonyms -> canonical region (unmapped values keep their text).
FUEL_REGION_MAP = {
    "N": "NORTE",
    "NORTE": "NORTE",
    "NE": "NORDESTE",
    "NORDESTE": "NORDESTE",
    "CO": "CENTRO-OESTE",
    "CENTRO-OESTE": "CENTRO-OESTE",
    "CENTRO OESTE": "CENTRO-OESTE",
    "SE": "SUDESTE",
    "SUDESTE": "SUDESTE",
    "S": "SUL",
    "SUL": "SUL",
}

# State code -> region code (v1 geography; unmapped states get null).
STATE_REGION_MAP = {
    "AC": "N", "AP": "N", "AM": "N", "PA": "N", "RO": "N", "RR": "N", "TO": "N",
    "AL": "NE", "BA": "NE", "CE": "NE", "MA": "NE", "PB": "NE", "PE": "NE",
    "PI": "NE", "RN": "NE", "SE": "NE",
    "DF": "CO", "GO": "CO", "MT": "CO", "MS": "CO",
    "ES": "SE", "MG": "SE", "RJ": "SE", "SP": "SE",
    "PR": "S", "SC": "S", "RS": "S",
}
VALID_REGION_CODES = ["N", "NE", "CO", "SE", "S"]
VALID_STATE_CODES = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA",
    "MT", "MS", "MG", "PA", "PB", "PR", "PE", "PI", "RJ", "RN",
    "RS", "RO", "RR", "SC", "SP", "SE", "TO",
]

# Brand cleaning: remove this token, then these leftovers mean "unbranded".
BRAND_STRIP_TOKEN = "POSTO"
BRAND_UNBRANDED_VALUES = ["", "DA ESQUINA", "CONVENIENCIA"]
BRAND_UNBRANDED_LABEL = "BRANCA"

# Product category (v2): first matching substring wins, else OUTROS.
FUEL_CATEGORY_RULES = [
    ("GASOLINA", "COMBUSTIVEL_LIQUIDO"),
    ("ETANOL", "COMBUSTIVEL_RENOVAVEL"),
    ("ALCOOL", "COMBUSTIVEL_RENOVAVEL"),
    ("DIESEL", "COMBUSTIVEL_DIESEL"),
    ("GNV", "COMBUSTIVEL_GASOSO"),
    ("GLP", "GAS_COZINHA"),
]
CATEGORY_DEFAULT = "OUTROS"

# Product category (v1): null -> DESCONHECIDO; first match wins, else OUTROS.
FUEL_CATEGORY_RULES_V1 = [
    ("GASOLINA", "GASOLINA"),
    ("ETANOL", "ETANOL"),
    ("ALCOOL", "ETANOL"),
    ("DIESEL", "DIESEL"),
    ("GLP", "GLP"),
    ("GAS", "GLP"),
]
CATEGORY_V1_NULL = "DESCONHECIDO"

# Brand category (v1): null -> DESCONHECIDA; first match wins, else OUTRAS.
BRAND_CATEGORY_RULES_V1 = [
    ("PETROBRAS", "PETROBRAS"),
    ("IPIRANGA", "IPIRANGA"),
    ("SHELL", "SHELL"),
    ("RAIZEN", "RAIZEN"),
    ("BRANCA", "BRANCA"),
    ("INDEPENDENTE", "BRANCA"),
]
BRAND_CATEGORY_V1_DEFAULT = "OUTRAS"
BRAND_CATEGORY_V1_NULL = "DESCONHECIDA"

# Major brands: five for the Silver size flag, four for the Gold comparison.
FUEL_MAJOR_BRANDS_SILVER = ["PETROBRAS", "SHELL", "IPIRANGA", "RAIZEN", "ALESAT"]
FUEL_MAJOR_BRANDS_GOLD = ["PETROBRAS", "SHELL", "IPIRANGA", "RAIZEN"]

# Price bands: right-closed bins, lowest edge included.
FUEL_BAND_EDGES = [0.0, 2.0, 4.0, 6.0, 8.0, float("inf")]
BAND_LABELS = ["MUITO_BAIXO", "BAIXO", "MEDIO", "ALTO", "MUITO_ALTO"]

# Validation rules and thresholds.
VALID_PRODUCTS = [
    "GASOLINA COMUM", "GASOLINA ADITIVADA", "ETANOL", "ÓLEO DIESEL",
    "ÓLEO DIESEL S10", "GNV", "GLP",
]
VALID_REGIONS = ["NORTE", "NORDESTE", "CENTRO-OESTE", "SUDESTE", "SUL"]
MIN_PRICE = 0.1
MAX_PRICE = 15.0
MIN_QUALITY_SCORE = 0.8
PAIR_RATIO_THRESHOLD = 0.7          # ethanol viable when ratio <= 0.7
PAIR_RATIO_THRESHOLD_PCT = 70.0     # v1 uses the ratio in percent
ISSUE_MIN_COMPLETENESS = 0.9
ISSUE_MIN_VALIDITY = 0.8
ISSUE_MIN_UNIQUENESS = 0.95
ISSUE_MIN_OVERALL = 0.8
# v1 validation
V1_PRICE_RANGE = (0.1, 20.0)
V1_COST_RANGE = (0.1, 18.0)
V1_DATE_RANGE = ("2020-01-01", "2024-12-31")
V1_MIN_COMPLETENESS = 0.95
V1_MAX_DUPLICATE_RATE = 0.05
V1_MAX_OUTLIER_RATE = 0.10
V1_SCORE_WEIGHTS = {
    "completeness": 25.0, "duplicates": 15.0, "schema": 20.0,
    "prices": 25.0, "outliers": 15.0,
}
V1_STATUS_BANDS = [(90.0, "EXCELENTE"), (75.0, "BOM"), (60.0, "REGULAR")]
V1_STATUS_DEFAULT = "CRÍTICO"
# Raw v2 schema (12 columns), v1 raw schema (16 columns).
FUEL_RAW_COLUMNS = [
    "Regiao", "Estado", "Municipio", "Revenda", "CNPJ", "Endereco", "Produto",
    "Data_Coleta", "Valor_Venda", "Valor_Compra", "Unidade_Medida", "Bandeira",
]
FUEL_V1_RAW_COLUMNS = [
    "Regiao - Sigla", "Estado - Sigla", "Municipio", "Revenda", "CNPJ da Revenda",
    "Nome da Rua", "Numero Rua", "Complemento", "Bairro", "Cep", "Produto",
    "Data da Coleta", "Valor de Venda", "Valor de Compra", "Unidade de Medida",
    "Bandeira",
]
FUEL_V1_RENAME = {
    "Regiao - Sigla": "regiao_sigla", "Estado - Sigla": "estado_sigla",
    "Municipio": "municipio", "Revenda": "revenda",
    "CNPJ da Revenda": "cnpj_revenda", "Nome da Rua": "nome_rua",
    "Numero Rua": "numero_rua", "Complemento": "complemento",
    "Bairro": "bairro", "Cep": "cep", "Produto": "produto",
    "Data da Coleta": "data_coleta", "Valor de Venda": "valor_venda",
    "Valor de Compra": "valor_compra", "Unidade de Medida": "unidade_medida",
    "Bandeira": "bandeira",
}
FUEL_V1_REQUIRED = ["regiao_sigla", "estado_sigla", "categoria_produto", "data_coleta", "valor_venda"]
FUEL_V1_KEY = ["estado_sigla", "municipio", "revenda", "produto", "data_coleta"]
FUEL_V1_TEXT_COLUMNS = ["municipio", "revenda", "nome_rua", "bairro", "bandeira", "produto"]
NULL_TEXT_TOKENS = ["NAN", "NONE", "NULL", ""]
DATE_FORMAT = "dd/MM/yyyy"
PARTITION_COLUMNS = ["ano", "mes"]
TIME_GRAINS = ["day", "week", "month", "quarter", "year"]
DASH_MAIN_PRODUCTS = ["GASOLINA COMUM", "ETANOL", "ÓLEO DIESEL"]


@dataclass(frozen=True)
class PanelRoles:
    """Which column plays which role, plus per-panel business parameters."""

    price: str = "price"
    cost: str = "cost"
    product: str = "product"
    brand: str = "brand"
    region: str = "region"
    state: str = "state"
    city: str = "city"
    station: str = "station"
    tax_id: str = "station_code"
    date: str = "obs_date"
    year: str = "year"
    month: str = "month"
    category: str = "product_category"
    key: tuple = ("l_orderkey", "l_linenumber")
    tiebreak: tuple = ()
    # Business parameters.
    pair: tuple = ("ECONOMY", "STANDARD")   # (substitute, reference) products
    pair_threshold: float = PAIR_RATIO_THRESHOLD
    variant_token: str = "M"                # "contains DIESEL"-style filter
    majors_silver: tuple = ()
    majors_gold: tuple = ()
    main_products: tuple = ()
    product_map: dict = field(default_factory=dict)
    region_map: dict = field(default_factory=dict)
    category_rules: tuple = ()
    band_edges: tuple = tuple(FUEL_BAND_EDGES)

    def with_(self, **kw) -> "PanelRoles":
        return replace(self, **kw)


# Star-schema panel over the test tables (see plans/panel.py).
STAR_CATEGORY_RULES = (
    ("PROMO", "PROMOTIONAL"),
    ("ECONOMY", "BUDGET"),
    ("STANDARD", "BUDGET"),
    ("SMALL", "SIZED"),
    ("MEDIUM", "SIZED"),
)
STAR = PanelRoles(
    tiebreak=("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"),
    majors_silver=("BRAND#1", "BRAND#2", "BRAND#3", "BRAND#4", "BRAND#5"),
    majors_gold=("BRAND#1", "BRAND#2", "BRAND#3", "BRAND#4"),
    main_products=("STANDARD", "ECONOMY", "PROMO"),
    product_map={"ECONOMY": "ECONOMY", "STANDARD": "STANDARD", "PROMO": "PROMO",
                 "PROMOTIONAL": "PROMO", "SMALL": "SMALL", "MEDIUM": "MEDIUM",
                 "LARGE": "LARGE"},
    region_map={"MIDDLE EAST": "MIDDLE-EAST", "MIDDLE-EAST": "MIDDLE-EAST"},
    category_rules=STAR_CATEGORY_RULES,
    band_edges=(0.0, 500.0, 1000.0, 2000.0, 4000.0, float("inf")),
)

# Raw v2 fuel CSVs.
FUEL = PanelRoles(
    price="Valor_Venda", cost="Valor_Compra", product="Produto", brand="Bandeira",
    region="Regiao", state="Estado", city="Municipio", station="Revenda",
    tax_id="CNPJ", date="data_coleta_parsed", year="ano", month="mes",
    category="categoria_produto",
    key=("CNPJ", "Data_Coleta", "Produto"),
    tiebreak=tuple(c for c in FUEL_RAW_COLUMNS if c not in ("CNPJ", "Data_Coleta", "Produto")),
    pair=("ETANOL", "GASOLINA COMUM"), variant_token="DIESEL",
    majors_silver=tuple(FUEL_MAJOR_BRANDS_SILVER),
    majors_gold=tuple(FUEL_MAJOR_BRANDS_GOLD),
    main_products=tuple(DASH_MAIN_PRODUCTS),
    product_map=dict(FUEL_PRODUCT_MAP), region_map=dict(FUEL_REGION_MAP),
    category_rules=tuple(FUEL_CATEGORY_RULES),
)


def silver_roles(roles: PanelRoles) -> PanelRoles:
    """Roles of a Silver frame: Gold groups on the normalised columns."""
    return roles.with_(product="product_norm", region="region_norm",
                       brand="brand_norm", category="product_category")
