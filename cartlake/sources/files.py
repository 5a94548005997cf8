"""Typed CSV loads (plain and gzip-compressed), as the source database's COPY did.

``COPY t(cols) FROM file DELIMITER ',' CSV HEADER`` -> a typed DataFrame:
header skipped, declared column types, malformed rows fail the load
(FAILFAST).  BOOLEAN columns are read as text and parsed with the COPY
spellings (Spark's CSV boolean parser only knows true/false, so '1' / '0' would
silently become NULL).

Gzip files are not splittable: each ``.csv.gz`` file is one task.  Land many
files rather than one big one, or pass ``partitions`` to spread the rows after
the read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from cartlake.functions import parse_pg_boolean


#: a spelling of NULL that no file has, so that only an unquoted gap is one
_NO_NULL = "\uffff"


def csv_typed_load(spark: SparkSession, path: str, schema: StructType | str,
                   delimiter: str = ",", header: bool = True,
                   partitions: int | None = None, multiline: bool = False) -> DataFrame:
    """Typed CSV load in the dialect of COPY (header line skipped, malformed rows fail the load).

    A quote inside a quoted field is doubled; a backslash is an ordinary character; ``""`` is an
    empty string and nothing between two delimiters is NULL.
    ``multiline`` allows line breaks inside quoted fields; each file is then one task.

    ``schema`` is a StructType or DDL text ('order_id INT, reordered BOOLEAN').
    BOOLEAN columns are read as text and parsed with the COPY spellings.
    ``partitions`` spreads the rows after the read (gzip files are one task each).
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    read_schema = StructType([
        StructField(f.name, StringType() if isinstance(f.dataType, BooleanType) else f.dataType, f.nullable)
        for f in schema.fields])
    df = (spark.read.option("header", header).option("sep", delimiter)
          .option("quote", '"').option("escape", '"').option("nullValue", _NO_NULL).option("emptyValue", "")
          .option("multiLine", multiline).option("mode", "FAILFAST").schema(read_schema).csv(path))
    out = [parse_pg_boolean(f.name).alias(f.name) if isinstance(f.dataType, BooleanType) else F.col(f.name)
           for f in schema.fields]
    df = df.select(out)
    if partitions:
        df = df.repartition(partitions)
    return df


def csv_gzip_load(spark: SparkSession, path: str, schema: StructType | str, **kw) -> DataFrame:
    """Same as ``csv_typed_load``; the codec is taken from the .gz file extension."""
    return csv_typed_load(spark, path, schema, **kw)


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> str:
    """CSV with a header line (the form the loads above read)."""
    w = (df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
         .option("emptyValue", '""').option("nullValue", None))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path
