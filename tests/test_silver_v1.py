"""The first-generation Silver job on a hand-made raw fuel file, and its v1 checks."""

from pricelens import config as C
from pricelens.plans import gold_v1, silver_v1
from pricelens.session import scratch_path

COLUMNS = C.FUEL_V1_RAW_COLUMNS


def _row(**kw):
    base = {"Regiao - Sigla": "SE", "Estado - Sigla": "SP", "Municipio": " campinas ", "Revenda": "Posto A",
            "CNPJ da Revenda": "12.345.678/0001-95", "Nome da Rua": "nan", "Numero Rua": "1", "Complemento": None,
            "Bairro": "Centro", "Cep": "13000-000", "Produto": "GASOLINA", "Data da Coleta": "2021-03-05",
            "Valor de Venda": "5.5", "Valor de Compra": "5.0", "Unidade de Medida": "R$ / litro", "Bandeira": "SHELL"}
    return tuple((base | kw)[c] for c in COLUMNS)


def _raw(spark):
    rows = [_row(), _row(**{"Valor de Venda": "5.7"}), _row(**{"Data da Coleta": "2019-01-01"}),
            _row(**{"Valor de Venda": "99", "Revenda": "Posto B"}), _row(**{"Valor de Venda": "abc", "Revenda": "Posto C"}),
            _row(**{"Estado - Sigla": "RJ", "Regiao - Sigla": "S", "Revenda": "Posto D", "Cep": "123"}),
            tuple(None for _ in COLUMNS)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in COLUMNS))


def test_silver_v1(spark):
    out = scratch_path(spark, "silver-v1")
    report = silver_v1.run_silver_v1(spark, _raw(spark), out)
    assert (report["status"], report["records"]) == ("completed", 2)
    rows = {r["revenda"]: r for r in spark.read.parquet(out).collect()}
    a, d = rows["POSTO A"], rows["POSTO D"]
    assert (a["valor_venda"], a["municipio"], a["nome_rua"], a["cnpj_revenda"]) == (5.7, "CAMPINAS", None, "12345678000195")
    assert (a["ano"], a["mes"], a["margin_pct"], a["region_consistent"]) == (2021, 3, 14.0, True)
    assert (d["cep"], d["region_consistent"]) == (None, False)
    assert d["regiao_sigla"] == C.STATE_REGION_MAP["RJ"] == a["regiao_sigla"]


def test_v1_analytics_group_by_category(spark):
    df = silver_v1.build_silver_v1(_raw(spark))
    got = gold_v1.monthly_change(df, silver_v1.ROLES)
    assert "categoria_produto" in got.columns and got.count() >= 1


def test_failure_is_reported(spark):
    assert silver_v1.run_silver_v1(spark, _raw(spark).drop("Produto"), "/nowhere/x")["status"] == "failed"


def test_checks(spark):
    df = silver_v1.enrich_stage(silver_v1.standardize(_raw(spark), silver_v1.V1Settings()), silver_v1.V1Settings())
    got = {r["check"]: r for r in silver_v1.run_checks_v1(df).collect()}
    assert set(got) == {"completeness", "critical_fields", "duplicates", "prices", "dates", "geography", "outliers"}
    assert not got["prices"]["passed"] and not got["dates"]["passed"] and not got["critical_fields"]["passed"]
