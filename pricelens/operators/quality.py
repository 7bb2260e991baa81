"""Data-quality operators (Q1-Q18) as distributed aggregates.

Per-column metrics come out as long tables ``(metric, column_name, score)``;
each metric family is one aggregation pass over the data (per-column counts
side by side), never a per-column loop of jobs; the first generation's price, outlier
and null checks read one table of value counts. Column *names* are schema
metadata and are handled on the driver; row data never is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import round_he, safe_div
from ..functions.quantiles import quantiles_of_counts
from .clean import materialize


def qc(c: str):
    return F.col("`" + c.replace("`", "``") + "`")


def _long(row: DataFrame, metric: str, items) -> DataFrame:
    """Turn a one-row frame of per-column scores into (metric, column_name, score)."""
    arr = F.array(*[F.struct(F.lit(name).alias("column_name"), expr.cast("double").alias("score"))
                    for name, expr in items])
    return row.select(F.inline(arr)).select(F.lit(metric).alias("metric"), "column_name", "score")


def completeness(df: DataFrame) -> DataFrame:
    """Q1: non-null share per column (no rows for an empty frame)."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(qc(c)).alias(f"_c{i}") for i, c in enumerate(cols)])
    row = row.filter(F.col("_n") > 0)
    return _long(row, "completeness", [(c, F.col(f"_c{i}") / F.col("_n")) for i, c in enumerate(cols)])


def _rule_expr(df: DataFrame, c: str, rule: dict):
    if c not in df.columns:
        return None
    x = qc(c)
    if "min" in rule and "max" in rule:
        return (x >= rule["min"]) & (x <= rule["max"])
    if "values" in rule:
        return x.isin(*rule["values"])
    if "date_format" in rule:
        # K9 fixed: the declared format decides validity.
        if isinstance(df.schema[c].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return x.isNotNull()
        return F.try_to_timestamp(x.cast("string"), F.lit(rule["date_format"])).isNotNull()
    return F.lit(True)


def validity(df: DataFrame, rules: dict) -> DataFrame:
    """Q2: share of rows passing each column's rule; absent column -> 0.0; null is invalid."""
    items, aggs = [], [F.count(F.lit(1)).alias("_n")]
    for i, (c, rule) in enumerate(rules.items()):
        e = _rule_expr(df, c, rule)
        if e is None:
            items.append((c, F.lit(0.0)))
        else:
            aggs.append(F.count_if(F.coalesce(e, F.lit(False))).alias(f"_v{i}"))
            items.append((c, F.col(f"_v{i}") / F.col("_n")))
    row = df.agg(*aggs).filter(F.col("_n") > 0)
    return _long(row, "validity", items)


def uniqueness(df: DataFrame, keys) -> DataFrame:
    """Q3: distinct key combinations / rows (nulls compare equal, as drop_duplicates).

    A grouped count with map-side partial aggregation, then one global sum:
    hot keys collapse before the shuffle.
    """
    keys = list(keys or [])
    existing = [k for k in keys if k in df.columns]
    if not keys:
        return df.agg(F.lit(1.0).alias("uniqueness"))
    if not existing:
        return df.agg(F.lit(0.0).alias("uniqueness"))
    g = df.groupBy(*[qc(k) for k in existing]).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.coalesce(safe_div(F.count(F.lit(1)).cast("double"), F.sum("_c")),
                            F.lit(1.0)).alias("uniqueness"))


def consistency(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Q4: text column -> share of its modal value length; other -> 1 - null rate;
    all-null text column -> 1.0."""
    spark = spark or df.sparkSession
    strs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    others = [c for c in df.columns if c not in strs]
    parts = []
    if strs:
        lens = (df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                      F.length(qc(c)).alias("len")) for c in strs])))
                  .filter(F.col("len").isNotNull()))
        modal = (lens.groupBy("column_name", "len").agg(F.count(F.lit(1)).alias("_k"))
                     .groupBy("column_name").agg((F.max("_k") / F.sum("_k")).alias("score")))
        names = spark.createDataFrame([(c,) for c in strs], "column_name string")
        parts.append(names.join(modal, "column_name", "left")
                          .select(F.lit("consistency").alias("metric"), "column_name",
                                  F.coalesce("score", F.lit(1.0)).alias("score")))
    if others:
        row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(qc(c)).alias(f"_c{i}") for i, c in enumerate(others)])
        row = row.filter(F.col("_n") > 0)
        parts.append(_long(row, "consistency", [(c, F.col(f"_c{i}") / F.col("_n")) for i, c in enumerate(others)]))
    return reduce(DataFrame.unionByName, parts)


def column_profile(df: DataFrame, rules: dict | None = None) -> DataFrame:
    """One row for the whole frame: ``_n`` rows and a map ``_by`` from a column's number to its
    total, filled (non-null), modal (rows of the most frequent value length) and valid rows.

    Every row becomes (column, length, rule passed) cells; counted map-side they are a handful
    of rows, from which completeness, validity and consistency follow together.
    """
    cols, cells = df.columns, []
    strs = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    for i, c in enumerate(cols):
        size = F.length(qc(c)) if c in strs else F.when(qc(c).isNotNull(), F.lit(0))
        ok = _rule_expr(df, c, (rules or {})[c]) if c in (rules or {}) else F.lit(False)
        cells.append(F.struct(F.lit(i).alias("c"), size.cast("int").alias("len"), F.coalesce(ok, F.lit(False)).alias("ok")))
    counts = (df.select(F.inline(F.array(*cells))).groupBy("c", "len", "ok").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("c", "len").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("ok"), F.col("n"))).alias("ok")))
    filled = F.when(F.col("len").isNotNull(), F.col("n"))
    per = counts.groupBy("c").agg(F.sum("n").alias("total"), F.sum(filled).alias("filled"), F.max(filled).alias("modal"),
                                  F.sum("ok").alias("valid"))
    # one entry a column of the schema
    return per.agg(F.coalesce(F.max("total"), F.lit(0)).alias("_n"), F.map_from_entries(F.collect_list(F.struct(
        "c", F.struct("total", "filled", "modal", "valid")))).alias("_by"))


def quality_report(df: DataFrame, rules: dict | None = None, keys=None) -> DataFrame:
    """Q5: the long table of all metrics plus dataset size rows.

    Two passes: the column profile yields row count, completeness, validity and consistency;
    key uniqueness is a grouped count of its own.
    """
    cols = df.columns
    strs = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}

    def of(c, what):
        return F.coalesce(F.element_at("_by", F.lit(cols.index(c)))[what], F.lit(0))

    items = [("total_rows", None, F.col("_n").cast("double"), True),
             ("total_columns", None, F.lit(float(len(cols))), True)]
    items += [("completeness", c, safe_div(of(c, "filled"), F.col("_n")), False) for c in cols]
    # a text column without a value is consistent
    items += [("consistency", c, F.coalesce(safe_div(of(c, "modal"), F.when(of(c, "filled") > 0, of(c, "filled"))), F.lit(1.0)), True)
              if c in strs else ("consistency", c, safe_div(of(c, "filled"), F.col("_n")), False) for c in cols]
    items += [("validity", c, safe_div(of(c, "valid"), F.col("_n")) if c in cols else F.lit(0.0), False)
              for c in rules or {}]
    arr = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(c).cast("string").alias("column_name"),
                             e.cast("double").alias("score"), F.lit(always).alias("always")) for m, c, e, always in items])
    out = (column_profile(df, rules).select("_n", F.inline(arr)).filter((F.col("_n") > 0) | F.col("always"))
           .drop("_n", "always"))
    if keys:
        out = out.unionByName(uniqueness(df, keys).select(F.lit("uniqueness").alias("metric"),
                                                          F.lit(None).cast("string").alias("column_name"),
                                                          F.col("uniqueness").alias("score")))
    return out


SCORED = ["completeness", "validity", "consistency", "uniqueness"]


def overall_score(report: DataFrame) -> DataFrame:
    """Q6: mean of the per-metric means."""
    per = report.filter(F.col("metric").isin(*SCORED)).groupBy("metric").agg(F.avg("score").alias("m"))
    return per.agg(F.coalesce(F.avg("m"), F.lit(0.0)).alias("overall_score"))


def quality_issues(report: DataFrame) -> DataFrame:
    """Q7: rows below the issue thresholds, with a message."""
    pct = round_he(F.col("score") * 100.0, 1).cast("string")
    per_col = report.filter(
        ((F.col("metric") == "completeness") & (F.col("score") < C.ISSUE_MIN_COMPLETENESS))
        | ((F.col("metric") == "validity") & (F.col("score") < C.ISSUE_MIN_VALIDITY))
        | ((F.col("metric") == "uniqueness") & (F.col("score") < C.ISSUE_MIN_UNIQUENESS)))
    per_col = per_col.withColumn("issue", F.when(
        F.col("column_name").isNull(), F.concat(F.lit("low "), F.col("metric"), F.lit(": "), pct, F.lit("%")))
        .otherwise(F.concat(F.lit("column '"), F.col("column_name"), F.lit("' low "), F.col("metric"),
                            F.lit(": "), pct, F.lit("%"))))
    ov = (overall_score(report).filter(F.col("overall_score") < C.ISSUE_MIN_OVERALL)
          .select(F.lit("overall").alias("metric"), F.lit(None).cast("string").alias("column_name"),
                  F.col("overall_score").alias("score"),
                  F.concat(F.lit("overall quality below target: "),
                           round_he(F.col("overall_score") * 100.0, 1).cast("string"), F.lit("%")).alias("issue")))
    return per_col.select("metric", "column_name", "score", "issue").unionByName(ov)


# ---- first generation -------------------------------------------------------
#: Measures of the v1 count table beside the columns themselves.
RELATION, NULLS, CRITICAL = "relation", "null cells", "critical nulls"


def value_counts(df: DataFrame, columns, price: str | None = None, cost: str | None = None, required=()) -> DataFrame:
    """(measure, value, n): how often each value occurs, of the numeric ``columns``, of the
    relation price <= cost (1 or 0), of the number of null cells in a row and of the number of
    null ``required`` fields.

    Nulls, ranges, quartiles and fences of Q10, Q12, Q15 and Q16 follow from this one table.
    A value that many rows share is one row a task before the shuffle. Whoever reads the table
    more than once checkpoints it, so the rows behind it are read once.
    """
    cells = [(c, qc(c)) for c in columns]
    if price is not None:
        cells.append((RELATION, (qc(price) <= qc(cost)).cast("double")))
    cells.append((NULLS, sum([qc(c).isNull().cast("int") for c in df.columns], F.lit(0))))
    cells.append((CRITICAL, sum([qc(c).isNull().cast("int") for c in required if c in df.columns], F.lit(0))))
    arr = F.array(*[F.struct(F.lit(m).alias("measure"), x.cast("double").alias("value")) for m, x in cells])
    return df.select(F.inline(arr)).groupBy("measure", "value").agg(F.count(F.lit(1)).alias("n"))


def _sum_of(cond):
    return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))


def v1_checks(df: DataFrame, required, counts: DataFrame | None = None) -> DataFrame:
    """Q10 + Q11: cell completeness, critical-field flag, whole-row duplicates."""
    cols = df.columns
    n_cells = float(len(cols))
    counts = value_counts(df, [], required=required) if counts is None else counts
    nulls, critical = F.col("measure") == NULLS, (F.col("measure") == CRITICAL) & (F.col("value") > 0)
    row = counts.agg(_sum_of(nulls).alias("_n"), F.sum(F.when(nulls, F.col("value") * F.col("n"))).alias("_nulls"),
                     (_sum_of(critical) > 0).alias("_critical"))
    dup = (df.groupBy(*[qc(c) for c in cols]).agg(F.count(F.lit(1)).alias("_k"))
             .agg(F.sum("_k").alias("_t"), F.count(F.lit(1)).alias("_d")))
    out = _one_row_join(row, dup)
    comp = 1.0 - safe_div(F.col("_nulls"), F.col("_n") * n_cells)
    dup_count = F.coalesce(F.col("_t") - F.col("_d"), F.lit(0)).cast("long")
    dup_rate = F.coalesce(safe_div(dup_count, F.col("_n")), F.lit(0.0))
    return out.select(
        comp.alias("completeness"), (comp >= C.V1_MIN_COMPLETENESS).alias("completeness_passed"),
        F.col("_critical").alias("critical_fields_missing"),
        dup_count.alias("duplicate_count"), dup_rate.alias("duplicate_rate"),
        (dup_rate <= C.V1_MAX_DUPLICATE_RATE).alias("duplicates_passed"))


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    # Both sides are single-row aggregates: join on a constant key.
    return a.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one").drop("_one")


def price_validation(df: DataFrame, price: str, cost: str, price_range, cost_range,
                     counts: DataFrame | None = None) -> DataFrame:
    """Q12: invalid (out of range or null) counts and rates, actual min/max, price <= cost;
    all from one row of sums over the count table."""
    counts = value_counts(df, [price, cost], price, cost) if counts is None else counts
    v, aggs, items = F.col("value"), [], []
    for i, (c, rng) in enumerate(((price, price_range), (cost, cost_range), (RELATION, None))):
        mine = F.col("measure") == c
        bad = mine & ((v.isNull() | (v < rng[0]) | (v > rng[1])) if rng else v == 1.0)
        aggs += [_sum_of(mine).alias(f"_n{i}"), _sum_of(bad).alias(f"_bad{i}"),
                 F.min(F.when(mine, v)).alias(f"_min{i}"), F.max(F.when(mine, v)).alias(f"_max{i}")]
        edge = [F.lit(float(x)) if rng else F.lit(None).cast("double") for x in rng or (0, 0)]
        items.append(F.struct(F.lit(c).alias("measure"), F.col(f"_bad{i}").cast("long").alias("invalid_count"),
                              safe_div(f"_bad{i}", f"_n{i}").alias("invalid_rate"),
                              edge[0].alias("min_valid"), edge[1].alias("max_valid"),
                              *[(F.col(f"_{k}{i}") if rng else F.lit(None).cast("double")).alias(f"actual_{k}") for k in ("min", "max")]))
    return counts.agg(*aggs).select(F.inline(F.array(*items)))


def date_validation(df: DataFrame, date_col: str, date_range) -> DataFrame:
    """Q13: unparseable and out-of-range dates, observed range."""
    d = qc(date_col)
    if not isinstance(df.schema[date_col].dataType, T.DateType):
        d = F.to_date(F.try_to_timestamp(d.cast("string")))
    lo, hi = F.to_date(F.lit(date_range[0])), F.to_date(F.lit(date_range[1]))
    out = df.agg(F.count_if(d.isNull()).cast("long").alias("invalid_format_count"),
                 F.count_if((d < lo) | (d > hi)).cast("long").alias("out_of_range_count"),
                 F.min(d).alias("min_date"), F.max(d).alias("max_date"))
    return out.withColumn("passed", (F.col("invalid_format_count") + F.col("out_of_range_count")) == 0)


def geo_validation(df: DataFrame, checks: dict) -> DataFrame:
    """Q14: per level, every distinct value seen with its row count and
    whether it is in the valid set (null is invalid). A grouped count, so
    any number of distinct (dirty) values stays distributed; the invalid
    count of a level is the sum of ``n_rows`` where ``is_valid`` is false."""
    parts = []
    for level, (c, valid) in checks.items():
        x = qc(c)
        parts.append(df.groupBy(x.alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
                       .select(F.lit(level).alias("level"), F.col("value").cast("string").alias("value"),
                               "n_rows", F.coalesce(F.col("value").isin(*valid), F.lit(False)).alias("is_valid")))
    return reduce(DataFrame.unionByName, parts)


def iqr_outliers(df: DataFrame, columns, counts: DataFrame | None = None) -> DataFrame:
    """Q15: Tukey fences per column from exact quartiles (skew-safe quantiles),
    outlier count and rate among non-null values, and the mean rate; all columns at once,
    from the count table."""
    columns = list(columns)
    counts = materialize(value_counts(df, columns)) if counts is None else counts
    mine = counts.where(F.col("measure").isin(columns) & F.col("value").isNotNull())
    q = quantiles_of_counts(mine.select("measure", F.lit("value").alias("_m"), F.col("value").alias("_v"), F.col("n").alias("_c")),
                            ["measure"], {"q1": ("value", 0.25), "q3": ("value", 0.75), "median": ("value", 0.5)})
    q = (q.withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("lower_bound", F.col("q1") - 1.5 * F.col("iqr"))
          .withColumn("upper_bound", F.col("q3") + 1.5 * F.col("iqr")))
    # a row a column (proven size): the values are not shuffled again
    outside = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    cnt = mine.join(F.broadcast(q), "measure").groupBy("measure").agg(
        _sum_of(outside).cast("long").alias("count"), F.sum("n").alias("_n"),
        *[F.first(c).alias(c) for c in ("q1", "q3", "median", "iqr", "lower_bound", "upper_bound")])
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "measure string")
    out = (names.join(cnt, "measure", "left").withColumn("count", F.coalesce("count", F.lit(0).cast("long")))
           .withColumn("rate", safe_div("count", "_n")).drop("_n"))
    # a column's row beside the mean over all of them, which are as many as there are columns
    rows = out.agg(F.collect_list(F.struct(*out.columns)).alias("_rows"), F.avg("rate").alias("overall_rate"))
    return (rows.select(F.inline("_rows"), "overall_rate")
            .withColumn("passed", F.col("overall_rate") <= C.V1_MAX_OUTLIER_RATE))


def weighted_score(v1: DataFrame, schema_ok: bool, prices: DataFrame, outliers: DataFrame) -> DataFrame:
    """Q16 with K19 fixed: weighted components summed and renormalised to 0-100."""
    w = C.V1_SCORE_WEIGHTS
    pr = prices.filter(F.col("measure") != "relation").agg(F.avg(1.0 - F.col("invalid_rate")).alias("_p"))
    ol = outliers.agg(F.first("overall_rate").alias("_o"))
    base = _one_row_join(_one_row_join(v1.select("completeness", "duplicate_rate"), pr), ol)
    score = (F.col("completeness") * w["completeness"] + (1.0 - F.col("duplicate_rate")) * w["duplicates"]
             + F.lit(w["schema"] if schema_ok else 0.0) + F.col("_p") * w["prices"]
             + (1.0 - F.col("_o")) * w["outliers"]) / sum(w.values()) * 100.0
    return base.select(score.alias("quality_score"))


def status_band(scores: DataFrame, col: str = "quality_score") -> DataFrame:
    """Q18: >= 90 / >= 75 / >= 60 / else."""
    expr = None
    for lo, label in C.V1_STATUS_BANDS:
        cond = F.col(col) >= lo
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return scores.withColumn("status", expr.otherwise(F.lit(C.V1_STATUS_DEFAULT)))


def schema_check(df: DataFrame, expected) -> dict:
    """Missing and extra columns (schema metadata, no data read)."""
    actual = set(df.columns)
    return {"missing_columns": sorted(set(expected) - actual),
            "extra_columns": sorted(actual - set(expected)),
            "schema_valid": not (set(expected) - actual)}


def run_quality_checks_v1(df: DataFrame, required, price: str, cost: str, date_col: str,
                          price_range, cost_range, date_range, geo: dict) -> dict:
    """Q17: every first-generation check on one frame, as named DataFrames."""
    counts = materialize(value_counts(df, [price, cost], price, cost, required))
    checks = v1_checks(df, required, counts)
    prices = price_validation(df, price, cost, price_range, cost_range, counts)
    outliers = iqr_outliers(df, [price, cost], counts)
    ok = schema_check(df, required)["schema_valid"]
    score = status_band(weighted_score(checks, ok, prices, outliers))
    return {"checks": checks, "prices": prices, "dates": date_validation(df, date_col, date_range),
            "geography": geo_validation(df, geo), "outliers": outliers, "score": score}
