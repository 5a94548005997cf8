"""Catalog-level sources: databases, external Parquet tables, named reads.

The raw layer is a set of external tables: declared columns over a folder of
Parquet files (schema on read).  Dropping such a table keeps its files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMPRESSIONS = ("gzip", "snappy")
_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    parts = name.split(".")
    for p in parts:
        if not _NAME.match(p):
            raise ValueError(f"bad identifier {name!r}")
    return ".".join(f"`{p}`" for p in parts)


def create_database(spark: SparkSession, name: str, location: str | None = None,
                    comment: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS, optionally at an explicit location."""
    sql = f"CREATE DATABASE IF NOT EXISTS {_ident(name)}"
    if comment:
        sql += " COMMENT '" + comment.replace("'", "''") + "'"
    if location:
        sql += " LOCATION '" + location.replace("'", "''") + "'"
    spark.sql(sql)


def ddl(columns: list[tuple[str, str]]) -> str:
    """[(name, type), ...] -> 'name type, ...' (types in Spark SQL spelling)."""
    return ", ".join(f"`{n}` {t}" for n, t in columns)


def external_parquet_table(spark: SparkSession, name: str, database: str, location: str,
                           columns: list[tuple[str, str]], compression: str = "snappy") -> DataFrame:
    """Register declared columns over a Parquet folder and return the table.

    ``compression`` documents the files' codec (readers detect it per file);
    it must be gzip or snappy.  Re-registering an existing name at its location is a
    no-op; at another location it is an error (drop the table first: its files stay).
    """
    if compression not in COMPRESSIONS:
        raise ValueError(f"compression must be one of {COMPRESSIONS}, got {compression!r}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_ident(database)}.{_ident(name)} ({ddl(columns)}) "
        f"USING PARQUET LOCATION '{location}' "
        f"TBLPROPERTIES ('classification'='parquet', 'compressionType'='{compression}')")
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {_ident(database)}.{_ident(name)}").filter("col_name = 'Location'").first()
    there, asked = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(x).toUri().getPath().rstrip("/") for x in (row["data_type"], location))
    if there != asked:
        raise ValueError(f"{database}.{name} is registered at {row['data_type']}, not at {location}")
    return read_table(spark, database, name)


def read_table(spark: SparkSession, database: str, name: str, catalog: str | None = None) -> DataFrame:
    """Named table from a database (optionally a named catalog)."""
    full = f"{database}.{name}" if catalog is None else f"{catalog}.{database}.{name}"
    return spark.read.table(full)


def drop_create_table(spark: SparkSession, name: str, columns: list[tuple[str, str]],
                      location: str | None = None) -> None:
    """DROP TABLE IF EXISTS + CREATE TABLE (Parquet).

    ``varchar(n)`` columns are Spark's own: an insert of a longer value fails.  NOT NULL is
    checked by ``load_table``, keys by the quality checks."""
    spark.sql(f"DROP TABLE IF EXISTS {_ident(name)}")
    sql = f"CREATE TABLE {_ident(name)} ({ddl(columns)}) USING PARQUET"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def load_table(df: DataFrame, name: str, not_null: tuple[str, ...] = ()) -> DataFrame:
    """INSERT INTO ``name`` by column name; a NULL in a ``not_null`` column, like a value too long
    for its varchar(n), fails the load and leaves the table as it was."""
    spark = df.sparkSession
    columns = spark.table(name).columns

    def checked(c: str):
        fail = F.raise_error(F.lit(f"NULL in column {c} of {name}")).cast(df.schema[c].dataType)
        return (F.when(F.col(c).isNull(), fail).otherwise(F.col(c)) if c in not_null else F.col(c)).alias(c)

    df.select(*map(checked, columns)).write.insertInto(name)
    return spark.table(name)


def list_tables_like(spark: SparkSession, database: str, pattern: str = "%") -> list[str]:
    """Table names of ``database`` matching a SQL LIKE pattern ('%' any run, '_' one char).

    Catalog metadata only (one name per table), never table data.
    """
    parts = re.findall(r"\\.|.", pattern, re.S)          # a backslash escapes the next character
    like = re.compile("".join(".*" if p == "%" else "." if p == "_" else re.escape(p[-1]) for p in parts), re.S)
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    return sorted(n for n in names if like.fullmatch(n))


def rows_to_df(spark: SparkSession, rows: list[dict], schema: StructType | str | None = None) -> DataFrame:
    """A small literal batch (e.g. hand-written updates) with an explicit schema."""
    if schema is None:
        return spark.createDataFrame([Row(**r) for r in rows])
    return spark.createDataFrame([Row(**r) for r in rows], schema=schema)


def temp_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a DataFrame to SQL under ``name`` for this session."""
    df.createOrReplaceTempView(name)
    return df


def register_raw_layer(spark: SparkSession, database: str, raw_root: str, schema: str = "public",
                       compression: str = "gzip", db_location: str | None = None,
                       columns: dict[str, list[tuple[str, str]]] | None = None,
                       require_existing: bool = True) -> dict[str, DataFrame]:
    """Create ``database`` and register every declared raw table as an external
    Parquet table over ``raw_root/schema/<table>`` (the landing layout).

    A missing landing folder is an error (rather than an empty table that would
    publish empty features), unless ``require_existing`` is False.
    """
    from cartlake.session import hadoop_path
    from cartlake.sources.schema import RAW_COLUMNS
    root = raw_root.rstrip("/")
    if require_existing:
        missing = []
        for name in (columns or RAW_COLUMNS):
            p, fs = hadoop_path(spark, f"{root}/{schema}/{name}")
            if not fs.exists(p):
                missing.append(name)
        if missing:
            raise FileNotFoundError(f"no landing folder under {root}/{schema} for {missing}")
    create_database(spark, database, location=db_location)
    return {name: external_parquet_table(spark, name, database, f"{root}/{schema}/{name}", cols, compression)
            for name, cols in (columns or RAW_COLUMNS).items()}
