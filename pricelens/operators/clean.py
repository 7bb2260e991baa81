"""Cleaning operators (Silver stage 1): dedup, text, numbers, outliers, dates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..config import PanelRoles
from ..session import ensure_checkpoint_dir, scratch_path, writing


def _order(cols, descending=False):
    # Nulls first ascending / last descending, spelled out so the oracle can match.
    return [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in cols]


def dedup(df: DataFrame, keys, tiebreak, keep: str = "first") -> DataFrame:
    """Keep one row per key: the first (or last) by the tie-break columns.

    ``row_number() == 1`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so each map task forwards at most one row per key: a key
    holding a third of the table collapses before it moves. Rows are sorted by
    numbers and dates first, as most comparisons of texts then don't happen.
    """
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df
    tb = [c for c in tiebreak if c in df.columns and c not in keys]
    if not tb:
        raise ValueError("dedup needs a deterministic tie-break column")
    keys = sorted(keys, key=lambda k: isinstance(df.schema[k].dataType, T.StringType))
    w = Window.partitionBy(*keys).orderBy(*_order(tb, descending=(keep == "last")))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


#: Keys that occur more than once, up to which they are broadcast to the rows.
REPEATED_KEYS = 1_000_000
#: Bits, as powers of two, of the filter that stands for more of them, and of one of its pieces.
FILTER_BITS, PIECE_BITS = 28, 12


def _filter_bit(h: Column) -> Column:
    """The bit of the filter that a hash takes."""
    return h.bitwiseAND(F.lit((1 << FILTER_BITS) - 1))


def hash_filter(hashes: DataFrame) -> DataFrame:
    """_piece, _words: a bitmap of ``2**FILTER_BITS`` bits in which the bits of the hashes ``_kh`` are
    set, whatever their number (32 MB, in pieces of 512 bytes)."""
    per = PIECE_BITS - 6
    mine = hashes.select(F.shiftright(_filter_bit(F.col("_kh")), 6).alias("_word"),
                         F.expr("shiftleft(1L, CAST(_kh & 63 AS INT))").alias("_bits"))
    none = hashes.sparkSession.range(1 << (FILTER_BITS - 6)).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_bits"))
    word = mine.unionByName(none).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    piece = word.groupBy(F.shiftright("_word", per).alias("_piece")).agg(
        F.sort_array(F.collect_list(F.struct("_word", "_bits"))).alias("_set"))
    return piece.select("_piece", F.col("_set._bits").alias("_words"))


def marked(hashed: DataFrame, pieces: DataFrame) -> DataFrame:
    """``hashed`` (with ``_kh``) with ``_maybe``: false where no hash of the filter is that of the row."""
    bit = _filter_bit(F.col("_kh"))
    at = (F.shiftright(bit, 6).bitwiseAND(F.lit((1 << (PIECE_BITS - 6)) - 1)) + 1).cast("int")
    joined = hashed.withColumn("_piece", F.shiftright(bit, PIECE_BITS)).join(F.broadcast(pieces), "_piece", "left")
    inside = F.getbit(F.element_at("_words", at), bit.bitwiseAND(F.lit(63)).cast("int")) == 1
    return joined.withColumn("_maybe", F.coalesce(inside, F.lit(False))).drop("_piece", "_words")


def dedup_written(df: DataFrame, keys, tiebreak, keep: str = "first", clustered_by=()) -> DataFrame:
    """``dedup`` of rows that are read from files: hashes of keys alone are shuffled to find those
    that occur more than once, and only the rows of these are put in order. More than
    ``REPEATED_KEYS`` of them are told by a filter of bounded size, which lets some rows of other
    keys pass to be put in order too. What was put in order is written once, clustered
    by ``clustered_by``; the other rows stay where they are."""
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df
    hashed = df.withColumn("_kh", F.xxhash64(*keys))
    repeated = write_rows(hashed.groupBy("_kh").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_kh"))
    n = repeated.count()
    if n == 0:
        return df
    if n > REPEATED_KEYS:
        told = marked(hashed, write_rows(hash_filter(repeated)))
        some, others = (told.where(c).drop("_kh", "_maybe") for c in ("_maybe", "NOT _maybe"))
    else:
        of = F.broadcast(repeated)
        some, others = (hashed.join(of, "_kh", how).drop("_kh") for how in ("left_semi", "left_anti"))
    ordered = write_rows(clustered(dedup(some, keys, tiebreak, keep), clustered_by))
    return others.unionByName(ordered)


def clustered(df: DataFrame, by) -> DataFrame:
    """``df`` with equal values of the expressions ``by`` in few tasks of bounded size."""
    names = [f"_by{i}" for i in range(len(by))]
    return df.withColumns(dict(zip(names, by, strict=True))).hint("rebalance", *names).drop(*names) if names else df


def dedup_keep_first(df: DataFrame, roles: PanelRoles) -> DataFrame:
    return dedup(df, roles.key, roles.tiebreak, "first")


def dedup_keep_last(df: DataFrame, roles: PanelRoles, keys=None) -> DataFrame:
    return dedup(df, keys or roles.key, roles.tiebreak, "last")


def clean_text(df: DataFrame, exclude=()) -> DataFrame:
    """trim + upper on every string column except ``exclude``; null stays null."""
    cols = {f.name: F.upper(F.trim(F.col(f.name))) for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude}
    return df.withColumns(cols) if cols else df


def clean_text_nullify(df: DataFrame, columns, tokens=C.NULL_TEXT_TOKENS) -> DataFrame:
    """v1 text clean: trim + upper, and 'NAN'/'NONE'/'NULL'/'' become null."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df
    # in two steps, so that a text is trimmed once and not again for its comparison
    df = df.withColumns({c: F.upper(F.trim(F.col(c).cast("string"))) for c in cols})
    return df.withColumns({c: F.when(F.col(c).isin(*tokens), F.lit(None).cast("string")).otherwise(F.col(c)) for c in cols})


def lenient_double(df: DataFrame, columns) -> DataFrame:
    """pd.to_numeric(errors='coerce'): unparseable text becomes null."""
    out = {c: F.col(c).try_cast("double") for c in columns if c in df.columns}
    return df.withColumns(out) if out else df


def positive(df: DataFrame, columns) -> DataFrame:
    """Keep rows whose columns are all > 0 (null drops, as NaN > 0 is False)."""
    for c in columns:
        if c in df.columns:
            df = df.filter(F.col(c) > 0)
    return df


def positive_prices(df: DataFrame, roles: PanelRoles) -> DataFrame:
    return positive(df, [roles.price, roles.cost])


def sigma_cut(df: DataFrame, column: str, k: float = 3.0, by=None) -> DataFrame:
    """Keep rows with column <= mean + k * sample std.

    Global form: the threshold is a scalar subquery (one row, computed by a
    partial/final aggregate), so no window without partition and no join.
    ``by=``: per-group thresholds from a grouped aggregate joined back on
    the group key (AQE broadcasts it when its measured size is small).
    """
    thr = F.avg(column) + F.lit(k) * F.stddev_samp(column)
    if not by:
        return df.filter(F.col(column) <= df.agg(thr.alias("_thr")).scalar())
    by = [by] if isinstance(by, str) else list(by)
    t = df.groupBy(*by).agg(thr.alias("_thr"))
    return df.join(t, by, "inner").filter(F.col(column) <= F.col("_thr")).drop("_thr")


def sigma_outlier_filter(df: DataFrame, roles: PanelRoles, k: float = 3.0, by=None) -> DataFrame:
    """Sequential upper cut: price first, then cost on the survivors (K7)."""
    for c in (roles.price, roles.cost):
        if c in df.columns:
            df = sigma_cut(df, c, k, by)
    return df


def parse_date(c, fmt: str = C.DATE_FORMAT):
    """Lenient dd/MM/yyyy parse: unparseable text gives null (ANSI-safe)."""
    return F.to_date(F.try_to_timestamp(F.col(c), F.lit(fmt)))


def valid_dates(df: DataFrame, date_col: str, source_col: str | None = None,
                fmt: str = C.DATE_FORMAT) -> DataFrame:
    """Parse ``source_col`` (if given) into ``date_col`` and drop null dates."""
    if source_col is not None and source_col in df.columns:
        df = df.withColumn(date_col, parse_date(source_col, fmt))
    return df.filter(F.col(date_col).isNotNull())


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop(how="all")


def drop_missing_required(df: DataFrame, required) -> DataFrame:
    return df.na.drop(subset=[c for c in required if c in df.columns])


def nullify_out_of_range(df: DataFrame, column: str, lo, hi) -> DataFrame:
    """Out-of-range values become null (v1); nulls stay null."""
    c = F.col(column)
    if isinstance(lo, str):
        lo, hi = F.to_date(F.lit(lo)), F.to_date(F.lit(hi))
    return df.withColumn(column, F.when(c.between(lo, hi), c))


def clean_digits_code(df: DataFrame, column: str, length: int) -> DataFrame:
    """Keep digits only; codes whose digit count is not ``length`` become null."""
    df = df.withColumn(column, F.regexp_replace(F.col(column).cast("string"), r"[^0-9]", ""))
    return df.withColumn(column, F.when(F.length(column) == length, F.col(column)))


def standardize_columns(df: DataFrame, rename=C.FUEL_V1_RENAME,
                        doubles=("valor_venda", "valor_compra"),
                        dates=("data_coleta",)) -> DataFrame:
    """v1: raw names to snake_case, then lenient casts."""
    df = df.withColumnsRenamed({k: v for k, v in rename.items() if k in df.columns})
    df = lenient_double(df, doubles)
    out = {}
    for c in dates:
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType):
            out[c] = F.to_date(F.try_to_timestamp(F.col(c)))
    return df.withColumns(out) if out else df


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir``.

    Cuts the lineage (a lost executor re-reads the checkpoint instead of
    re-running the join and shuffle) and lets several passes over the same
    rows read them once materialised.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_rows(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written once as Parquet, below the shared ``spark.checkpoint.dir`` or to ``path``: what
    ``materialize`` is for few rows.

    Cuts the lineage (a lost executor re-reads the files instead of re-running the join and
    shuffle) and lets several passes over the same rows read the columns they need. Columns
    are compressed, so that this takes a fraction of what a checkpoint of the rows takes. Who
    gives a ``path`` may delete it when the rows are no longer read.
    """
    spark, path = df.sparkSession, path or scratch_path(df.sparkSession, "rows")
    with writing(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def silver_clean(df: DataFrame, roles: PanelRoles, exclude_text=(), k: float = 3.0,
                 date_source: str | None = None, checkpoint: bool | str = False,
                 written: bool = False, derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Dedup -> text -> (positive, sigma) per value column -> valid dates.

    The sigma cuts need two global passes (the cost threshold is computed on
    the rows left by the price cut). With ``checkpoint`` the rows that the dedup leaves are
    written, so neither pass re-runs the upstream joins: to that path, if it is one, clustered
    by month, so that a layer by month needs no further shuffle, else as they come.
    ``written`` rows are read from files clustered by month already. Columns that follow
    from a row's others are added by ``derive`` after the dedup, and after the rows are written.
    """
    by = [f(roles.date) for f in (F.year, F.month)] if roles.date in df.columns else []
    if written:
        df = dedup_written(df, roles.key, roles.tiebreak, "first", by)
    else:
        df = dedup_keep_first(df, roles)
        if checkpoint:
            path = checkpoint if isinstance(checkpoint, str) else None
            df = write_rows(clustered(df, by if path else []), path)
    df = derive(df) if derive else df
    df = clean_text(df, exclude=tuple(exclude_text))
    for c in (roles.price, roles.cost):
        if c in df.columns:
            df = df.withColumn(c, F.col(c).try_cast("double")) \
                if not isinstance(df.schema[c].dataType, T.DoubleType) else df
            df = positive(df, [c])
            df = sigma_cut(df, c, k)
    return valid_dates(df, roles.date, date_source)
