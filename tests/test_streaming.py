"""Incremental ingest gives one result whatever the batches, keeps rejects, and
replays a batch without change."""

import random

import pytest
from pyspark.sql import functions as F

from pricelens.config import FUEL
from pricelens.session import scratch_path
from pricelens.sources import files
from pricelens.streaming import incremental
from pricelens.streaming.incremental import incremental_ingest

SCHEMA = files.fuel_raw_schema()
ROLES = FUEL.with_(key=("CNPJ", "Produto"), tiebreak=("Valor_Venda",))


def _row(cnpj, prod, date, price):
    return ("SE", "SP", "CIDADE-0001", "POSTO A", cnpj, "RUA A, 1", prod, date, price, price * 0.9,
            "R$ / litro", "SHELL")


def _land(spark, landing, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").option("header", True).csv(landing)


def _rows(seed=1, n=240):
    r = random.Random(seed)
    return [_row(str(r.randrange(60)), r.choice(["GASOLINA", "ETANOL"]),
                 r.choice(["05/03/2021", "07/04/2021", "31/12/2019", "01/01/2024", "31/02/2021", "sem data"]),
                 round(r.uniform(3, 6), 2)) for _ in range(n)]


def _expected(rows):
    best = {}
    for x in rows:
        if x[7] in ("31/02/2021", "sem data"):
            continue
        k = (x[4], x[6])
        best[k] = min(best.get(k, x), x, key=lambda y: (y[8], *[str(v) for v in y]))
    return sorted(best.values())


@pytest.mark.parametrize("per_batch", [1, 3, 1000])
def test_batches_make_no_difference(spark, per_batch):
    landing, out, ckpt = (scratch_path(spark, n) for n in ("land", "out", "ckpt"))
    rows = _rows()
    for k in range(0, len(rows), 30):   # eight files, dates in no order
        _land(spark, landing, rows[k:k + 30])
    incremental_ingest(spark, landing, SCHEMA, ROLES, out, ckpt, max_files_per_trigger=per_batch).awaitTermination()
    got = spark.read.parquet(out).select(*SCHEMA.fieldNames(), "ano", "mes").collect()
    assert sorted(tuple(x)[:-2] for x in got) == _expected(rows)
    assert all(x["Data_Coleta"].endswith(f"{x['mes']:02d}/{x['ano']}") for x in got)
    bad = spark.read.parquet(f"{out}_rejects")
    assert bad.count() == sum(x[7] in ("31/02/2021", "sem data") for x in rows)


def test_later_runs_and_replays(spark):
    landing, out, ckpt = (scratch_path(spark, n) for n in ("land", "out", "ckpt"))
    first = [_row("1", "GASOLINA", "05/03/2021", 5.0), _row("2", "ETANOL", "05/03/2021", 3.5)]
    _land(spark, landing, first)
    incremental_ingest(spark, landing, SCHEMA, ROLES, out, ckpt).awaitTermination()
    later = [_row("2", "ETANOL", "05/04/2021", 3.4), _row("1", "GASOLINA", "05/03/2021", 5.1), _row("3", "GNV", "06/03/2021", 4.0)]
    _land(spark, landing, later)
    incremental_ingest(spark, landing, SCHEMA, ROLES, out, ckpt).awaitTermination()
    read = lambda: sorted(tuple(x) for x in spark.read.parquet(out).select(*SCHEMA.fieldNames()).collect())
    assert read() == _expected(first + later)
    # the last batch again, as after a failure between write and commit
    layer = spark.read.parquet(out)
    incremental.merge_batch(layer, 1, out, f"{out}_rejects", f"{ckpt}/merge", ["CNPJ", "Produto"], ["Valor_Venda"])
    assert read() == _expected(first + later)


def test_moved_row_leaves_no_copy(spark):
    """A better row of a month that held the key alone empties that month."""
    landing, out, ckpt = (scratch_path(spark, n) for n in ("land", "out", "ckpt"))
    _land(spark, landing, [_row("1", "GASOLINA", "05/03/2021", 5.0)])
    incremental_ingest(spark, landing, SCHEMA, ROLES, out, ckpt).awaitTermination()
    _land(spark, landing, [_row("1", "GASOLINA", "05/06/2021", 4.0)])
    incremental_ingest(spark, landing, SCHEMA, ROLES, out, ckpt).awaitTermination()
    assert [tuple(x) for x in spark.read.parquet(out).select("Valor_Venda", "mes").collect()] == [(4.0, 6)]


def test_only_rows_of_the_batch_s_keys_are_put_in_order(spark, monkeypatch):
    """Rows of the layer that share no key with a batch, and digests, are not shuffled for it."""
    landing, out, ckpt = (scratch_path(spark, n) for n in ("land", "out", "ckpt"))
    first = [_row(str(k), "GASOLINA", "05/03/2021", 5.0) for k in range(200)]
    _land(spark, landing, first)
    incremental_ingest(spark, landing, SCHEMA, ROLES, out, ckpt).awaitTermination()
    seen, plain = [], incremental._first_by_key

    def ordered(df, *a):
        seen.append((df.count(), set(df.columns)))
        return plain(df, *a)

    monkeypatch.setattr(incremental, "_first_by_key", ordered)
    later = [_row("7", "GASOLINA", "05/03/2021", 4.0), _row("900", "GASOLINA", "06/03/2021", 4.0)]
    _land(spark, landing, later)
    incremental_ingest(spark, landing, SCHEMA, ROLES, out, ckpt).awaitTermination()
    assert sorted(tuple(x) for x in spark.read.parquet(out).select(*SCHEMA.fieldNames()).collect()) == _expected(first + later)
    n, columns = seen[-1]
    assert 3 <= n < 10 and not columns & {"bronze_record_id", "ano", "mes"}
    from pricelens.plans.pipeline import record_id
    wrong = spark.read.parquet(out).where(record_id(SCHEMA.fieldNames()) != F.col("bronze_record_id"))
    assert wrong.count() == 0


def test_a_layer_that_was_there_before_is_put_in_order_whole(spark):
    """Such a layer may repeat a key that no batch brings; its touched months lose the repeats, as ever."""
    schema = "k string, v double, ano int, mes int"
    out, staging = scratch_path(spark, "layer"), scratch_path(spark, "merge")
    files.write_layer(spark.createDataFrame([("a", 5.0, 2020, 1), ("a", 4.0, 2020, 1), ("b", 5.0, 2020, 1)], schema), out)
    for batch in (0, 1):
        incremental.merge_batch(spark.createDataFrame([(f"n{batch}", 1.0, 2020, 1)], schema), batch, out, f"{out}_rejects", staging, ["k"], ["v"])
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(out).collect()) == [("a", 4.0), ("b", 5.0), ("n0", 1.0), ("n1", 1.0)]
