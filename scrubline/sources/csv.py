"""CSV scan (bronze strings -> typed columns) and table sinks.

Columns are bound by header name, never by position: the names come from the
header line (one line is read, no data pass), every column is read as STRING (no
numeric inference that would turn a phone column into doubles), and files whose
header differs from the first one's are refused.  Missing-value tokens become
nulls and typed columns are derived with ``try_cast``, so a bad cell becomes null
instead of failing the job under ANSI mode.  The raw string is kept for
type-drift profiling when ``keep_bronze`` is set.

Quoting follows RFC 4180 in and out: quotes inside a quoted value are doubled,
and values may hold delimiters, quotes, outer blanks and (with ``multiline``,
which makes a file one split) line breaks.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.patterns import NA_TOKENS
from ..operators.rowid import BLOCK, FILE, PLACE, with_places
from .tables import CUSTOMER_DDL


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hpath)
    return found is not None and len(found) > 0


RFC4180 = {"header": True, "sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def header_names(spark: SparkSession, path: str, multiline: bool = False) -> list[str]:
    """Column names of a CSV file or folder, from its first header line."""
    return spark.read.options(**RFC4180).option("multiLine", multiline).option("ignoreLeadingWhiteSpace", True).csv(path).columns


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType = CUSTOMER_DDL,
    na_tokens=NA_TOKENS,
    keep_bronze: bool = False,
    multiline: bool = False,
    corrupt_column: str | None = None,
    required: tuple | None = None,
    keep_extra: bool = False,
    places: bool = False,
) -> DataFrame:
    """Header CSV -> typed DataFrame.

    ``schema`` names the typed columns; each is taken from the file's column of that
    name, wherever it stands.  Columns of ``schema`` that the file lacks are left out,
    unless ``required`` names them: then ``ValueError`` is raised before any job on the
    data.  Other columns of the file are ignored, or appended as strings with
    ``keep_extra``.  Leading blanks after a delimiter are skipped, except inside quotes.
    ``places`` adds where each row stands (see ``operators.rowid``).  Raises
    ``FileNotFoundError`` (S2) when the path does not exist.
    """
    typed = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if not _path_exists(spark, path):
        raise FileNotFoundError(f"File not found: {path}")
    try:
        names = header_names(spark, path, multiline)
    except AnalysisException as e:  # pragma: no cover - raced deletion
        raise FileNotFoundError(str(e)) from e
    lacking = [c for c in required or () if c not in names]
    if lacking:
        raise ValueError(f"columns missing in {path}: {lacking}")
    fields = [T.StructField(n, T.StringType(), True) for n in names]
    if corrupt_column:
        fields.append(T.StructField(corrupt_column, T.StringType(), True))
    reader = (
        spark.read.schema(T.StructType(fields))
        .options(**RFC4180)
        .option("enforceSchema", False)  # every file's header must be the first one's
        .option("ignoreLeadingWhiteSpace", True)
        .option("multiLine", multiline)
    )
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    scan = reader.csv(path)
    return _typed(with_places(scan) if places else scan, names, typed, na_tokens, keep_bronze, corrupt_column, keep_extra,
                  (FILE, BLOCK, PLACE) if places else ())


def stream_csv(spark: SparkSession, directory: str, schema: str | T.StructType = CUSTOMER_DDL, na_tokens=NA_TOKENS,
               file_glob: str = "*.csv", max_files_per_trigger: int | None = None, multiline: bool = False) -> DataFrame:
    """The same scan as a stream of files: names from the files that are there, later files
    must have the same header."""
    typed = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = header_names(spark, f"{directory}/{file_glob}", multiline)
    reader = (spark.readStream.schema(T.StructType([T.StructField(n, T.StringType(), True) for n in names]))
              .options(**RFC4180).option("enforceSchema", False).option("ignoreLeadingWhiteSpace", True)
              .option("multiLine", multiline).option("pathGlobFilter", file_glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _typed(reader.csv(directory), names, typed, na_tokens)


def _typed(raw: DataFrame, names: list[str], typed: T.StructType, na_tokens, keep_bronze: bool = False,
           corrupt_column: str | None = None, keep_extra: bool = False, also: tuple = ()) -> DataFrame:
    """String columns ``names`` -> the typed columns among them, by name."""
    tokens = list(na_tokens)

    def text(name: str):
        s = F.col(f"`{name}`")
        return F.when(s.isin(tokens), F.lit(None).cast("string")).otherwise(s)

    cols = []
    wanted = [f for f in typed.fields if f.name in names]
    for f in wanted:
        s = text(f.name)
        if isinstance(f.dataType, T.StringType):
            cols.append(s.alias(f.name))
        else:
            v = s.try_cast(f.dataType)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                v = F.when(F.isnan(v), F.lit(None).cast(f.dataType)).otherwise(v)
            cols.append(v.alias(f.name))
            if keep_bronze:
                cols.append(s.alias(f"{f.name}__raw"))
    if keep_extra:
        used = {f.name for f in wanted}
        cols += [text(n).alias(n) for n in names if n not in used]
    if corrupt_column:
        cols.append(F.col(corrupt_column))
    return raw.select(*cols, *also)


def row_counts(df: DataFrame) -> DataFrame:
    """S3: row and column counts as one row."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(len(df.columns)).cast("bigint").alias("column_count")
    )


# values are written and read back as they are: no trimming, doubled quotes, nulls as
# nothing between delimiters and empty text as ""
EXPORT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
          "nullValue": "", "emptyValue": '""'}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                header: bool = True) -> str:
    """S4/S5/S7 sink.  CSV keeps a header row; Parquet is the default."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.options(**EXPORT).option("header", header)
    w.format(fmt).save(path)
    return path


def read_export(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A table written by ``write_table(..., "csv")``, value for value (line breaks included)."""
    # the reader marks nothing between delimiters with nullValue, which must differ from empty text
    return (spark.read.schema(schema).options(**EXPORT).option("emptyValue", "").option("nullValue", "\x00null")
            .option("header", True).option("enforceSchema", False).option("multiLine", True).csv(path))
