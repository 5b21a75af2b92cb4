"""Table sinks: typed overwrite, append, create and refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def as_schema(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Columns in schema order and type; required columns must hold values."""
    typed = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    missing = [f.name for f in typed.fields if f.name not in df.columns and not f.nullable]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")

    def column(f: T.StructField):
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        c = c.cast(f.dataType)
        if not f.nullable:
            c = F.when(c.isNotNull(), c).otherwise(F.raise_error(F.lit(f"{f.name} is required")).cast(f.dataType))
        return c.alias(f.name)

    return df.select(*[column(f) for f in typed.fields])


def overwrite_table(df: DataFrame, name: str, schema: T.StructType | str | None = None, path: str | None = None) -> None:
    out = df if schema is None else as_schema(df, schema)
    writer = out.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Append by column name."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.mode("append").insertInto(name)


def materialize(df: DataFrame, name: str, path: str | None = None, partition_by: tuple[str, ...] = ()) -> None:
    """Create or replace a table from a query; date partitions keep later scans small."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType | str, path: str | None = None) -> None:
    typed = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in typed.fields
    )
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}")


def refresh_table(df: DataFrame, name: str) -> None:
    """Replace all rows, keeping the table."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.mode("overwrite").insertInto(name)
