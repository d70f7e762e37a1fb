"""Scans, inline rows, stage chains and catalog rows."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.session import cut_lineage


def read_table(
    spark: SparkSession, base: str, name: str, cols: Sequence[str] | None = None
) -> DataFrame:
    """One Parquet table; only ``cols`` are read from the files."""
    df = spark.read.parquet(f"{base}/{name}.parquet")
    return df.select(*cols) if cols else df


def stream_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One Parquet table as a stream.

    The path is a pattern, because a stream takes a plain path for a folder only
    and a table may be a single file.
    """
    schema = read_table(spark, base, name).schema
    return spark.readStream.schema(schema).parquet(f"{base}/{name}.parque[t]")


def rows(spark: SparkSession, data: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """Literal rows with named, typed columns."""
    return spark.createDataFrame(list(data), schema)


Stage = Callable[[Mapping[str, DataFrame]], DataFrame]


def run_stages(
    stages: Mapping[str, Stage], views_prefix: str | None = None, store: Collection[str] = ()
) -> dict[str, DataFrame]:
    """Build named stages in order; each sees the stages before it.

    With ``views_prefix`` every stage is also a temp view of that prefix. Stages
    in ``store`` are written to the shared folder once, so the stages and
    compares that read them do not compute them again.
    """
    built: dict[str, DataFrame] = {}
    for name, stage in stages.items():
        built[name] = cut_lineage(stage(built)) if name in store else stage(built)
        if views_prefix is not None:
            built[name].createOrReplaceTempView(f"{views_prefix}{name}")
    return built


SKETCH_LOG = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LOG / 2)  # standard error of sketched distinct counts

CATALOG_SCHEMA = (
    "table_name string, column_name string, data_type string, ordinal int, "
    "nullable boolean, is_primary_key boolean"
)


def catalog_columns(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per column from the schemas alone; no table is read."""
    keys = keys or {}
    data = [
        (name, f.name, f.dataType.simpleString(), i, f.nullable, f.name in keys.get(name, ()))
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return rows(spark, data, CATALOG_SCHEMA)


def value_key(field: T.StructField) -> Column:
    """The value itself where it is short, else a text that is equal where values are.

    Long texts are replaced by a marked digest, which no short text can equal.
    """
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(F.struct(col))
    elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
        text = col.cast("string")
    else:
        return col
    digest = F.concat(F.lit("#"), F.md5(text.cast("binary")))
    return F.when(F.length(text) <= 32, text).when(col.isNotNull(), digest)


def distinct_counts(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """(column_name, distinct_count): each column read, combined and shuffled by itself."""
    return reduce(
        DataFrame.unionByName,
        [
            df.select(value_key(f).alias("v"))
            .filter(F.col("v").isNotNull())
            .distinct()
            .agg(F.count(F.lit(1)).alias("distinct_count"))
            .select(F.lit(f.name).alias("column_name"), "distinct_count")
            for f in fields
        ],
    )


def _null_counts(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """(column_name, row_count, null_count) from one plain aggregate."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)],
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"), F.col("rows").alias("row_count"),
                (F.col("rows") - F.col(f"c{i}")).alias("null_count"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counted.select(F.explode(cells).alias("x")).select("x.*")


def profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Exact row, null and distinct counts of every column of every table.

    Rows and NULLs of a table are counted in one pass. The values of a column are
    counted in a pass that reads this column only; equal values are combined before
    the shuffle, so a value held by a third of all rows travels once per task.
    """
    parts = []
    for name, df in tables.items():
        fields = df.schema.fields
        counts = _null_counts(df, fields).join(distinct_counts(df, fields), "column_name")
        parts.append(counts.select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


#: A table before its lookups, and how many values each looked-up column can take.
Core = tuple[DataFrame, Mapping[str, int]]

#: The tables that a core joins, each with the columns it gives, and one row with the number of joined rows.
Join = tuple[Sequence[DataFrame], DataFrame]


def joined_rows(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """One row with the number of rows (``rows``) that the inner join on a key has.

    Rows are counted per key before the shuffle, so a key travels once per task and side,
    without the columns of its rows.
    """
    n = left.groupBy(F.col(left_key).alias("_l")).agg(F.count(F.lit(1)).alias("_n"))
    m = right.groupBy(F.col(right_key).alias("_r")).agg(F.count(F.lit(1)).alias("_m"))
    total = F.sum(F.col("_n") * F.col("_m"))
    return n.join(m, F.col("_l") == F.col("_r")).agg(F.coalesce(total, F.lit(0)).alias("rows"))


def _cell(name: str, nulls: Column, spread: Column, about: Column) -> Column:
    return F.struct(
        F.lit(name).alias("name"), nulls.cast("long").alias("nulls"),
        spread.cast("double").alias("spread"), about.cast("long").alias("about"),
    )


def _value_cells(df: DataFrame, nulls: bool = True) -> list[Column]:
    """Per column: its NULLs, how many whole numbers its range has, about how many values."""
    cells = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        whole = isinstance(f.dataType, T.IntegralType)
        cells.append(
            _cell(
                f.name,
                F.count(F.lit(1)) - F.count(col) if nulls else F.lit(0),
                F.max(col).cast("decimal(38,0)") - F.min(col) + 1 if whole else F.lit(None),
                F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(value_key(f)), SKETCH_LOG)),
            )
        )
    return cells


def unique_columns(
    tables: Mapping[str, DataFrame], derived: Collection[str] = (), cores: Mapping[str, Core] | None = None,
    joins: Mapping[str, Join] | None = None,
) -> dict[str, set[str]]:
    """Columns without NULL whose values never repeat, by table.

    One plain aggregate over a table rules out columns with a NULL, of whole numbers from a
    range smaller than the number of rows, or with far fewer values than rows by a sketch;
    only the values of the others are counted. The aggregates of all tables run as one
    job, and so do the counts. One row per table and per such column reaches the driver.

    Tables named in ``derived`` are not stored: the first pass computes them whole, and
    without a possible column that is all. One that is left is counted from the plan of
    the table; several are stored, without the other columns, and counted from there.

    ``cores`` are tables before their lookups. A lookup keeps every row at least once, so a
    column that repeats in the core repeats in the table, and so does a looked-up column
    that can take fewer values than the core has rows. All columns are searched in the core
    like that, and the table itself is computed only for those that are left.

    ``joins`` name what a core joins. A column takes no value in the join that it has not in
    its own table, so one with fewer values there than the join has rows repeats in the core;
    the core itself is computed only for those that are left. NULLs of rows that may meet
    none rule out nothing.
    """
    cores, joins = cores or {}, joins or {}
    looked_up = {name: core[1] for name, core in cores.items()}
    searched = {name: cores[name][0] if name in cores else df for name, df in tables.items()}
    summaries = []
    for name, df in searched.items():
        cells = [
            _cell(c, F.lit(0), F.lit(values), F.lit(values)) for c, values in looked_up.get(name, {}).items()
        ]
        if name in joins:
            sources, size = joins[name]
            found = [f"_cells_{i}" for i in range(len(sources))]
            for out, source in zip(found, sources, strict=True):
                size = size.join(source.agg(F.array(*_value_cells(source, nulls=False)).alias(out)))  # one row each
            looked = [F.array(*cells)] if cells else []
            one = size.select("rows", F.concat(*looked, *found).alias("cells"))
        else:
            one = df.agg(F.count(F.lit(1)).alias("rows"), F.array(*cells, *_value_cells(df)).alias("cells"))
        summaries.append(one.select(F.lit(name).alias("table_name"), "rows", "cells"))
    summed = reduce(DataFrame.unionByName, summaries).select("table_name", "rows", F.explode("cells").alias("c"))
    possible = summed.where(
        (F.col("rows") > 0) & (F.col("c.nulls") == 0)
        & (F.col("c.spread").isNull() | (F.col("c.spread") >= F.col("rows")))
        # four standard errors below the number of rows
        & (F.col("c.about") * (1 + 4 * SKETCH_ERROR) >= F.col("rows"))
    )
    sizes, left, parts = {}, {}, []
    found: dict[str, set[str]] = {name: set() for name in tables}
    for row in possible.select("table_name", "rows", "c.name").collect():
        name = row["table_name"]
        sizes[name] = row["rows"]
        if row["name"] in looked_up.get(name, ()):
            found[name].add(row["name"])
        else:
            left.setdefault(name, []).append(row["name"])
    for name, columns in left.items():
        df = searched[name].select(*[f"`{c}`" for c in columns])
        if name in derived and len(columns) > 1:
            df = cut_lineage(df, name)
        parts.append(distinct_counts(df, df.schema.fields).select(F.lit(name).alias("table_name"), "*"))
    for r in reduce(DataFrame.unionByName, parts).take(sum(map(len, left.values()))) if parts else []:
        if r["distinct_count"] == sizes[r["table_name"]]:
            found[r["table_name"]].add(r["column_name"])
    undecided = {
        name: tables[name].select(*[f"`{c}`" for c in tables[name].columns if c in found[name]])
        for name in cores
        if found.get(name)
    }
    if undecided:
        found |= unique_columns(undecided, derived)
    return found


def catalog(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]] | None = None,
    measured: bool | Sequence[str] = True,
    counts: bool = True,
    derived: Collection[str] = (),
    cores: Mapping[str, Core] | None = None,
    joins: Mapping[str, Join] | None = None,
) -> DataFrame:
    """Catalog rows, with the measured profile of all or of the named tables.

    A measured table without a declared key takes its first unique column as key.
    Without ``counts`` only these keys are searched, and only tables that need one; of
    ``derived`` tables nothing but possible keys is stored for that, of those in ``cores``
    the lookups are computed only where the core leaves a column, and of cores in ``joins``
    the join only where the tables it joins leave one.
    """
    base = catalog_columns(spark, tables, keys)
    chosen = tables if measured is True else {t: tables[t] for t in measured or ()}
    if not chosen:
        return base
    if not counts:
        unique = unique_columns({t: df for t, df in chosen.items() if not (keys or {}).get(t)}, derived, cores, joins)
        first = dict(keys or {})
        for t, names in unique.items():
            first[t] = [c for c in tables[t].columns if c in names][:1]
        return catalog_columns(spark, tables, first)
    joined = base.join(profile(chosen), ["table_name", "column_name"], "left")
    joined = (
        joined.withColumn("row_count", F.coalesce("row_count", F.lit(0)).cast("long"))
        .withColumn("null_count", F.coalesce("null_count", F.lit(0)).cast("long"))
        .withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0)).cast("long"))
        .withColumn(
            "is_unique",
            (F.col("null_count") == 0)
            & (F.col("row_count") > 0)
            & (F.col("distinct_count") == F.col("row_count")),
        )
    )
    per_table = joined.groupBy("table_name").agg(
        F.max("is_primary_key").alias("_declared"),
        F.min(F.when(F.col("is_unique"), F.col("ordinal"))).alias("_first_unique"),
    )
    return (
        joined.join(per_table, "table_name")
        .withColumn(
            "is_primary_key",
            F.when(F.col("_declared"), F.col("is_primary_key")).otherwise(
                F.coalesce(F.col("ordinal") == F.col("_first_unique"), F.lit(False))
            ),
        )
        .drop("_declared", "_first_unique")
    )
