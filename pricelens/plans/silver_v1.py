"""R2/R5/R7/R8 of the first generation: raw v1 file -> standardise -> clean -> enrich ->
validate -> Silver, and every v1 check on it (Q17)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import PanelRoles
from ..operators import clean, enrich, normalize
from ..operators import quality as Q
from ..sources import files

#: What breaks ties between rows of a key.
TIES = ["valor_venda", "valor_compra", "cnpj_revenda", "cep", "nome_rua", "numero_rua", "complemento", "bairro",
        "unidade_medida", "bandeira"]
CODE_LENGTHS = {"cnpj_revenda": 14, "cep": 8}


@dataclass(frozen=True)
class V1Settings:
    """What differs between panels; the defaults are those of the fuel files."""

    price_range: tuple = C.V1_PRICE_RANGE
    cost_range: tuple = C.V1_COST_RANGE
    date_range: tuple = C.V1_DATE_RANGE
    regions: dict = field(default_factory=lambda: dict(C.STATE_REGION_MAP))
    product_rules: tuple = tuple(C.FUEL_CATEGORY_RULES_V1)
    brand_rules: tuple = tuple(C.BRAND_CATEGORY_RULES_V1)
    code_lengths: dict = field(default_factory=lambda: dict(CODE_LENGTHS))
    keep: tuple = ()            # columns that only break ties between rows of a key


#: Roles of a v1 Silver frame: N0-N14 group on the two categories.
ROLES = PanelRoles(price="valor_venda", cost="valor_compra", product="categoria_produto", brand="categoria_bandeira",
                   region="regiao_sigla", state="estado_sigla", city="municipio", station="revenda", tax_id="cnpj_revenda",
                   date="data_coleta", year="ano", month="mes", category="categoria_produto", key=tuple(C.FUEL_V1_KEY))


def standardize(raw: DataFrame, s: V1Settings) -> DataFrame:
    return clean.standardize_columns(raw)


def clean_stage(df: DataFrame, s: V1Settings) -> DataFrame:
    """Empty rows out, texts trimmed and null tokens nulled, codes to digits, values out of
    range to null."""
    df = df.na.drop(how="all", subset=[c for c in df.columns if c not in s.keep])
    df = clean.clean_text_nullify(df, [*C.FUEL_V1_TEXT_COLUMNS, "regiao_sigla", "estado_sigla"])
    for column, length in s.code_lengths.items():
        df = clean.clean_digits_code(df, column, length)
    df = clean.nullify_out_of_range(df, "valor_venda", *s.price_range)
    df = clean.nullify_out_of_range(df, "valor_compra", *s.cost_range)
    return clean.nullify_out_of_range(df, "data_coleta", *s.date_range)


def label_stage(df: DataFrame, s: V1Settings) -> DataFrame:
    """Categories and the region of the state (it wins over the file's)."""
    df = enrich.categorize_product_v1(df, "produto", "categoria_produto", rules=s.product_rules)
    df = enrich.categorize_brand(df, "bandeira", "categoria_bandeira", rules=s.brand_rules)
    df = normalize.region_from_state(df, "estado_sigla", "regiao_sigla", s.regions)
    return df.withColumn("regiao_sigla", F.coalesce("region_v1", "regiao_sigla")).drop("region_derived", "region_v1")


def measure_stage(df: DataFrame) -> DataFrame:
    """Calendar and rounded margin."""
    return enrich.margin_metrics(enrich.temporal_dimensions(df, ROLES), ROLES, digits=2)


def enrich_stage(df: DataFrame, s: V1Settings) -> DataFrame:
    return measure_stage(label_stage(df, s))


def validate_stage(df: DataFrame, s: V1Settings, by=None, written: bool = False) -> DataFrame:
    """Required fields, then one row a key, the last by the other columns; ``by`` and
    ``written`` as in ``build_silver_v1``."""
    if by is not None and not written:
        # before the check: Spark would compute the required fields again to check them below a join
        df = clean.write_rows(clean.clustered(df, by))
    df = clean.drop_missing_required(df, C.FUEL_V1_REQUIRED)
    ties = [*s.keep, *TIES]
    return clean.dedup(df, C.FUEL_V1_KEY, ties, "last") if by is None else clean.dedup_written(df, C.FUEL_V1_KEY, ties, "last", by)


def build_silver_v1(raw: DataFrame, s: V1Settings = V1Settings(), by=None, written: bool = False) -> DataFrame:
    """R2 -> R5 -> R7 -> R8. What is computed from a row's other columns comes after the dedup,
    which therefore moves less. Lazy by default; with ``by`` the clean rows are first written,
    clustered by these expressions (``[]``: as they come), and hashes of their keys alone are
    shuffled. Rows that are ``written``, as Bronze, are read where they are."""
    df = label_stage(clean_stage(standardize(raw, s), s), s)
    return measure_stage(validate_stage(df, s, by, written))


def run_silver_v1(spark: SparkSession, raw: DataFrame, out: str, s: V1Settings = V1Settings()) -> dict:
    """The job: build, write by (ano, mes), report; a failure is reported whole."""
    from .pipeline import timed_report
    report = timed_report("silver_v1")
    try:
        months = [F.year("data_coleta"), F.month("data_coleta")]
        files.write_layer(build_silver_v1(raw, s, months), out, clustered=True)
        return report("completed", records=files.read_layer(spark, out).count(), path=out)
    except Exception as e:  # noqa: BLE001 - the report carries the failure
        return report("failed", error=str(e))


def run_checks_v1(df: DataFrame, s: V1Settings = V1Settings()) -> DataFrame:
    """Q17: all v1 checks on one frame as rows (check, value, passed)."""
    checks = Q.run_quality_checks_v1(
        df, C.FUEL_V1_REQUIRED, "valor_venda", "valor_compra", "data_coleta", s.price_range, s.cost_range, s.date_range,
        {"region": ("regiao_sigla", sorted({*s.regions.values()})), "state": ("estado_sigla", sorted(s.regions))})
    c, out = checks["checks"], []

    def row(frame: DataFrame, name: str, value, passed) -> None:
        out.append(frame.select(F.lit(name).alias("check"), value.cast("double").alias("value"), passed.alias("passed")))

    row(c, "completeness", F.col("completeness"), F.col("completeness_passed"))
    row(c, "critical_fields", F.col("critical_fields_missing").cast("int"), ~F.col("critical_fields_missing"))
    row(c, "duplicates", F.col("duplicate_rate"), F.col("duplicates_passed"))
    row(checks["prices"].agg(F.sum("invalid_count").alias("n")), "prices", F.col("n"), F.col("n") == 0)
    row(checks["dates"], "dates", F.col("invalid_format_count") + F.col("out_of_range_count"), F.col("passed"))
    row(checks["geography"].agg(F.coalesce(F.sum(F.when(~F.col("is_valid"), F.col("n_rows"))), F.lit(0)).alias("n")),
        "geography", F.col("n"), F.col("n") == 0)
    row(checks["outliers"].agg(F.max("overall_rate").alias("r"), F.bool_and("passed").alias("p")), "outliers", F.col("r"), F.col("p"))
    total = out[0]
    for part in out[1:]:
        total = total.unionByName(part)
    return total
