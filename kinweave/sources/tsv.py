"""Tab-separated sources and sinks: all columns are text, empty text marks what is missing."""
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

RAW = ("entity_id", "business_name", "business_address", "country")


def require_columns(df: DataFrame, names, label: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{label} lacks columns: {', '.join(missing)}")


#: What a reader that decodes missing values takes for one.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_tsv(spark: SparkSession, path: str, columns=RAW, multiline: bool = False, decode_missing: bool = False, label: str = "file") -> DataFrame:
    """Rows of a TSV with a header, without type inference; NA and None stay text, or are null where missing values are decoded."""
    if not exists(spark, path):
        raise FileNotFoundError(f"{label} does not exist: {path}")
    if decode_missing:
        raw = read_tsv(spark, path, columns, multiline, label=label)
        return raw.select(*[F.when(~F.col(c).isin(*MISSING), F.col(c)).alias(c) for c in raw.columns])
    with_all = spark.read.csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=multiline)  # reads the header only
    require_columns(with_all, columns, label)
    if with_all.columns != list(columns):
        return with_all.select(*columns).na.fill("")
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.read.csv(path, schema=schema, sep="\t", header=True, enforceSchema=False, quote='"', escape='"', multiLine=multiline).na.fill("")


def write_tsv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Write with a header; `files` bounds the part files."""
    out = df if files is None else df.coalesce(files)
    out.write.mode("overwrite").csv(path, sep="\t", header=True, quote='"', escape='"', emptyValue="")


def read_tree(spark: SparkSession, root: str, names, columns=RAW) -> dict[str, DataFrame]:
    """Named TSVs of a folder; others, such as the ground truth, are left alone."""
    return {n: read_tsv(spark, f"{root.rstrip('/')}/{n}.tsv", columns, label=n) for n in sorted(names)}


def write_reports(tables: dict[str, DataFrame], folder: str) -> None:
    """Small tables, a file each."""
    for name, df in tables.items():
        write_tsv(df, f"{folder.rstrip('/')}/{name}.tsv", 1)


def write_summary(spark: SparkSession, summary: dict, path: str) -> None:
    """A dictionary as one line of JSON."""
    spark.createDataFrame([(json.dumps(summary, default=str, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def encode_lists(df: DataFrame) -> DataFrame:
    return df.withColumns({n: F.to_json(n) for n, t in df.dtypes if t.startswith("array")})


def decode_list(col):
    """A JSON list as array without nulls; empty or null text is an empty array, other JSON fails."""
    c = F.coalesce(col, F.lit(""))
    got = F.from_json(c, "array<string>", {"mode": "FAILFAST"})
    return F.when(F.trim(c) == "", F.array().cast("array<string>")).otherwise(F.filter(got, lambda x: x.isNotNull()))


def split_ids(col):
    """All ids of a comma-separated list, trimmed, blanks and repeats kept; an empty list has none."""
    c = F.trim(F.coalesce(col, F.lit("")))
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(c, ","), lambda x: F.trim(x)))


def listed_ids(col):
    """Ids of a comma-separated list, trimmed, without blanks, repeats kept."""
    return F.filter(split_ids(col), lambda x: x != "")


def parse_ids(col):
    """Ids of a comma-separated list, trimmed, without blanks and repeats."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(col, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != ""))
