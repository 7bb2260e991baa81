"""The FUEL preset end to end on a hand-made raw CSV (FIXTURES.md §1 schema):
Bronze -> Silver -> Gold with the original column names."""

from pyspark.sql import functions as F

from pricelens.config import FUEL, silver_roles
from pricelens.plans import gold, pipeline
from pricelens.session import scratch_path
from pricelens.sources import files

ROWS = [
    # Regiao, Estado, Municipio, Revenda, CNPJ, Endereco, Produto, Data_Coleta, venda, compra, unidade, Bandeira
    ("SE", "SP", "CIDADE-0001", "POSTO A", "12.345.678/0001-90", "RUA A, 1", "GASOLINA", "05/03/2021", 5.0, 4.5, "R$ / litro", "POSTO SHELL"),
    ("SE", "SP", "CIDADE-0001", "POSTO A", "12.345.678/0001-90", "RUA A, 1", "GASOLINA", "05/03/2021", 5.5, 4.6, "R$ / litro", "POSTO SHELL"),  # dup key
    ("SE", "SP", "CIDADE-0001", "POSTO A", "12.345.678/0001-90", "RUA A, 1", "ALCOOL", "05/03/2021", 3.4, 3.0, "R$ / litro", "POSTO SHELL"),
    ("SE", "SP", "CIDADE-0002", "POSTO B", "22.345.678/0001-90", "RUA B, 2", "ETANOL", "25/03/2021", 3.6, 3.1, "R$ / litro", "POSTO DA ESQUINA"),
    ("SE", "SP", "CIDADE-0002", "POSTO B", "22.345.678/0001-90", "RUA B, 2", "GASOLINA COMUM", "25/03/2021", 5.2, 4.7, "R$ / litro", "POSTO DA ESQUINA"),
    ("NE", "BA", "CIDADE-0003", "POSTO C", "32.345.678/0001-90", "RUA C, 3", "DIESEL", "10/04/2021", 4.1, 3.8, "R$ / litro", "IPIRANGA"),
    ("NE", "BA", "CIDADE-0003", "POSTO C", "32.345.678/0001-90", "RUA C, 3", "DIESEL S10", "10/04/2021", 4.3, 3.9, "R$ / litro", "IPIRANGA"),
    ("S", "PR", "CIDADE-0004", "POSTO D", "42.345.678/0001-90", "RUA D, 4", "GLP", "bad date", 110.0, 95.0, "R$ / 13Kg", "BRANCA"),
    ("CO", "GO", "CIDADE-0005", "POSTO E", "52.345.678/0001-90", "RUA E, 5", "GNV", "01/01/2024", 4.0, 3.5, "R$ / m3", "POSTO RAIZEN"),
]


def test_fuel_preset_end_to_end(spark):
    raw = spark.createDataFrame(ROWS, files.fuel_raw_schema())
    landing = scratch_path(spark, "fuel-csv")
    files.write_csv(raw, landing)
    df = files.read_csv(spark, landing, files.fuel_raw_schema())
    assert files.csv_header_check(spark, landing, files.fuel_raw_schema().fieldNames())["valid"]

    root = scratch_path(spark, "fuel")
    b = pipeline.run_bronze(spark, df, FUEL, f"{root}/bronze", date_source="Data_Coleta")
    assert b["status"] == "completed" and b["records"] == 8          # unparseable date dropped
    s = pipeline.run_silver(spark, f"{root}/bronze", FUEL, f"{root}/silver")
    assert s["status"] == "completed"
    silver = files.read_layer(spark, f"{root}/silver")
    # dedup kept one of the two rows sharing the business key
    assert silver.filter("CNPJ = '12.345.678/0001-90' AND Produto = 'GASOLINA'").count() == 1
    got = {r.Produto: r.product_norm for r in silver.select("Produto", "product_norm").distinct().collect()}
    assert got["ALCOOL"] == "ETANOL" and got["DIESEL S10"] == "ÓLEO DIESEL S10" and got["GASOLINA"] == "GASOLINA COMUM"
    brands = {r.Bandeira: r.brand_norm for r in silver.select("Bandeira", "brand_norm").distinct().collect()}
    assert brands["POSTO DA ESQUINA"] == "BRANCA" and brands["POSTO SHELL"] == "SHELL"
    v = silver.filter("product_norm = 'ETANOL' AND Estado = 'SP' AND data_coleta_parsed = DATE'2021-03-25'").first()
    assert v.pair_viable is True                                      # 3.6 / 5.2 = 0.69
    g = pipeline.run_gold(spark, f"{root}/silver", FUEL, f"{root}/gold")
    assert g["status"] == "completed"
    hist = files.read_gold(spark, f"{root}/gold", "ethanol_ratio_history").filter("Estado = 'SP'").collect()
    assert any(r.pair_ratio is not None for r in hist)
    sr = silver_roles(FUEL)
    assert gold.variant_comparison(silver, sr).select("product_norm").distinct().count() == 2  # two DIESEL kinds
