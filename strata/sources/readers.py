"""Sources: file scans, catalog tables, nested JSON payloads, inline rows.

Give a schema wherever one is known: inference costs an extra pass over
the data (CSV, JSON) and can change from file to file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The test tables shipped with the build (one parquet file each).
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_files(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet",
               schema: StructType | str | None = None,
               options: Mapping[str, str] | None = None) -> DataFrame:
    """Any file format by name; parquet carries its own schema."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path if isinstance(path, str) else list(path))


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             infer: bool = False, header: bool = True) -> DataFrame:
    """CSV with a header. With a schema: typed; ``infer=True``: types guessed
    (an extra pass); neither: every column is text."""
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str,
                    names: Sequence[str] = TABLES) -> None:
    """Temp views over the test tables (plans inline them; nothing is cached)."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there (or any that a pattern matches), in any store that Spark reads."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop_path)
    return found is not None and len(found) > 0


def read_optional(spark: SparkSession, path: str, fmt: str = "csv",
                  schema: StructType | str | None = None,
                  options: Mapping[str, str] | None = None) -> DataFrame | None:
    """The frame at ``path`` (which may be a pattern), or None when nothing is there. Only a
    missing path is swallowed; any other error still raises."""
    if not path_exists(spark, path):
        return None
    try:
        df = read_files(spark, path, fmt, schema, options)
        df.schema  # resolve now so a missing path shows here
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e.getCondition() or "") or "Path does not exist" in str(e):
            return None
        raise


def nan_as_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN -> null in fractional columns (all double/float ones by default).

    Spark orders NaN above every number (``NaN > 500`` is true) while
    frame-style tools treat it as missing; converting at the source gives the
    missing-value meaning everywhere downstream."""
    types = dict(df.dtypes)
    cols = [c for c in (columns or df.columns) if types.get(c) in ("double", "float")]
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None).cast(types[c]))
                           .otherwise(F.col(c)) for c in cols}) if cols else df


def arrays_to_rows(df: DataFrame, struct_col: str, fields: Mapping[str, str]) -> DataFrame:
    """Struct of parallel arrays -> one row per index.

    ``fields`` maps array field -> output column, e.g. the daily block of a
    forecast payload ``{"time": "date", "temperature_2m_max": "temp_max_c"}``.
    ``arrays_zip`` pairs the i-th elements; ``inline`` explodes them in the
    task that read the record.
    """
    zipped = F.arrays_zip(*[F.col(f"{struct_col}.{f}").alias(o) for f, o in fields.items()])
    return df.select(F.inline(zipped))


def read_json_payload(spark: SparkSession, path: str, schema: StructType | str,
                      multiline: bool = True) -> DataFrame:
    """JSON documents with a declared schema (a document may span lines)."""
    return spark.read.schema(schema).option("multiLine", str(multiline).lower()).json(path)


def inline_rows(spark: SparkSession, rows: Sequence, schema: StructType | str) -> DataFrame:
    """Small literal rows (audit records, lookups); never for data."""
    return spark.createDataFrame(list(rows), schema)
