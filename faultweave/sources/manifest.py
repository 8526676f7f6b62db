"""What files there are, whether their headers are right, and how many rows they hold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultweave.config import BASELINE_ROOT, DEFAULTS, ROOTS
from faultweave.schemas import SOURCE_COLUMNS
from faultweave.sources import listing

KINDS = ("trace", "metric", "log")

# Fixed value: pods' own metric files, told from the summaries beside them.
METRIC_SUFFIX = "_metric.csv"


def below(path: Column, base: str) -> Column:
    """Part of a file path below `base`: both are cut to what follows any URI scheme.

    Spark gives paths with escapes; a plus sign in them is one.
    """
    path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    tail = base.rstrip("/").split("://")[-1].split(":", 1)[-1].lstrip("/")
    return F.substring_index(path, f"/{tail}/", -1) if tail else path


def _part(relative: Column, index: int, deeper_than: int) -> Column:
    parts = F.split(relative, "/")
    return F.when(F.size(parts) > deeper_than, F.get(parts, F.lit(index))).otherwise("unknown")


def _with_parts(files: DataFrame) -> DataFrame:
    relative = F.col("relative_path")
    return files.withColumns(
        {
            "root": F.get(F.split(relative, "/"), F.lit(0)),
            "capture_date": _part(relative, 1, 2),
            "kind": _part(relative, 2, 3),
        }
    )


def _wanted(kinds: Sequence[str], roots: Sequence[str], metric_suffix: str) -> Column:
    """CSV files of the asked roots and kinds; of the metric files, only the pods' own."""
    name = F.col("relative_path")
    return (
        F.col("root").isin(list(roots))
        & F.col("kind").isin(list(kinds))
        & name.endswith(".csv")
        & ((F.col("kind") != "metric") | name.endswith(metric_suffix))
    )


def file_manifest(
    spark: SparkSession,
    path: str,
    kinds: Sequence[str] = KINDS,
    roots: Sequence[str] = ROOTS,
    metric_suffix: str = METRIC_SUFFIX,
) -> DataFrame:
    """Wanted files with size, root, kind and capture date."""
    files = _listed(spark, path, kinds, roots, metric_suffix)
    return files.select("relative_path", "root", "capture_date", "kind", "size_bytes")


def _listed(
    spark: SparkSession, path: str, kinds: Sequence[str], roots: Sequence[str], metric_suffix: str
) -> DataFrame:
    """Wanted files with size, parts of the path, first line and second line.

    Listed in tasks wherever they can open the path; elsewhere by Spark's own index.
    """
    if listing.can_list(path):
        files = listing.capture_files(spark, path, roots)
        return files.filter(_wanted(kinds, roots, metric_suffix))
    return _indexed(spark, path, kinds, roots, metric_suffix)


def _indexed(
    spark: SparkSession, path: str, kinds: Sequence[str], roots: Sequence[str], metric_suffix: str
) -> DataFrame:
    """The same for a file system that only Spark reads.

    A scan skips empty files, so the names come from the file index Spark keeps on
    the driver anyway, and the sizes and lines from scans.
    """
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    names = spark.createDataFrame([(name,) for name in scan.inputFiles()], "file_path string")
    names = names.select(below(F.col("file_path"), path).alias("relative_path"))
    sizes = scan.select(
        below(F.col("_metadata.file_path"), path).alias("relative_path"),
        F.col("_metadata.file_size").alias("_size"),
    )
    opening = _lines(spark, path).filter("block = 0")
    head = opening.groupBy("relative_path").agg(
        F.min("position").alias("_first"), F.min_by("value", "position").alias("header")
    )
    # The line after the header: the smallest position but one.
    second = (
        opening.join(head.select("relative_path", "_first"), "relative_path")
        .filter("position > _first")
        .groupBy("relative_path")
        .agg(F.min_by("value", "position").alias("first_row"))
    )
    return (
        _with_parts(names)
        .filter(_wanted(kinds, roots, metric_suffix))
        .join(sizes, "relative_path", "left")
        .join(head.drop("_first"), "relative_path", "left")
        .join(second, "relative_path", "left")
        .select(
            "relative_path", "root", "capture_date", "kind",
            F.coalesce(F.col("_size"), F.lit(0)).alias("size_bytes"), "header", "first_row",
        )
    )


def dataset_is_present(spark: SparkSession, path: str, root: str = BASELINE_ROOT) -> bool:
    """Whether any trace file of the fault-free capture is there."""
    if listing.can_list(path):
        files = listing.capture_files(spark, path, [root])
        return not files.filter((F.col("kind") == "trace") & F.col("relative_path").endswith(".csv")).isEmpty()
    files = spark.read.format("binaryFile")
    try:
        return bool(files.load(f"{path.rstrip('/')}/{root}/*/trace/*.csv").inputFiles())
    except AnalysisException:
        return False


def manifest_totals(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("root", "kind").agg(
        F.count("*").alias("files"), F.sum("size_bytes").alias("size_bytes")
    )


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    return text.text(path).select(
        "value",
        below(F.col("_metadata.file_path"), path).alias("relative_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
    )


def columns_of(header: Column) -> Column:
    """Column names of a CSV header line, without quotes, blanks and byte-order mark."""
    return F.transform(
        F.split(F.regexp_replace(header, r"^\uFEFF", ""), ","),
        lambda c: F.regexp_replace(F.trim(c), '^"|"$', ""),
    )


def _expected_columns(kind: Column, expected: Mapping[str, Sequence[str]]) -> Column:
    table = F.create_map(
        *[x for k, v in expected.items() for x in (F.lit(k), F.array(*[F.lit(c) for c in v]))]
    )
    return F.coalesce(F.try_element_at(table, kind), F.array().cast("array<string>"))


def validate_columns(
    spark: SparkSession,
    path: str,
    expected: Mapping[str, Sequence[str]] = SOURCE_COLUMNS,
    kinds: Sequence[str] = KINDS,
    roots: Sequence[str] = ROOTS,
    metric_suffix: str = METRIC_SUFFIX,
) -> DataFrame:
    """Per file: missing and extra columns, row count, a sample row, and validity.

    A file is valid when no expected column is missing. Header and sample come with the
    listing; the text is scanned once, for the rows, which are the physical lines after the
    header. Large files stay split.
    """
    counts = _lines(spark, path).groupBy("relative_path").agg((F.count("*") - 1).alias("row_count"))
    checked = (
        _listed(spark, path, kinds, roots, metric_suffix)
        .join(counts, "relative_path", "left")
        .withColumn("_columns", columns_of(F.col("header")))
        .withColumn("_expected", _expected_columns(F.col("kind"), expected))
    )
    empty = F.col("header").isNull()
    missing = F.array_except("_expected", "_columns")
    extra = F.array_except("_columns", "_expected")
    return checked.select(
        "relative_path", "root", "capture_date", "kind",
        F.coalesce(F.col("row_count"), F.lit(0)).alias("row_count"),
        missing.alias("missing_columns"),
        extra.alias("extra_columns"),
        F.col("first_row").alias("sample_row"),
        (~empty & (F.size(missing) == 0)).alias("valid"),
        F.when(empty, "Empty file (no header row)").alias("error"),
    )


def row_counts(
    spark: SparkSession,
    path: str,
    kinds: Sequence[str] = KINDS,
    roots: Sequence[str] = ROOTS,
    metric_suffix: str = METRIC_SUFFIX,
) -> DataFrame:
    """Data rows per root and kind; a file's header does not count."""
    per_file = _lines(spark, path).groupBy("relative_path").agg(F.count("*").alias("_lines"))
    return (
        _with_parts(per_file)
        .filter(_wanted(kinds, roots, metric_suffix))
        .groupBy(F.concat_ws("/", "root", "kind").alias("root_kind"))
        .agg(F.sum(F.col("_lines") - 1).alias("rows"))
    )


def validate_dataset(
    spark: SparkSession,
    path: str,
    kinds: Sequence[str] = ("trace", "metric"),
    root: str = BASELINE_ROOT,
    metric_suffix: str = METRIC_SUFFIX,
) -> DataFrame:
    """Per kind: files, rows and problems; a kind without files is itself a problem."""
    files = validate_columns(
        spark, path, kinds=kinds, roots=[root], metric_suffix=metric_suffix
    )
    asked = spark.createDataFrame([(k,) for k in kinds], "kind string")
    found = files.groupBy("kind").agg(
        F.count("*").alias("files"),
        F.sum("row_count").alias("rows"),
        F.count_if(~F.col("valid")).alias("problems"),
    )
    none = F.col("files").isNull()
    return asked.join(found, "kind", "left").select(
        "kind",
        F.coalesce(F.col("files"), F.lit(0)).alias("files"),
        F.coalesce(F.col("rows"), F.lit(0)).alias("rows"),
        F.when(none, 1).otherwise(F.col("problems")).cast("bigint").alias("problems"),
    )


def require_valid(report: DataFrame, min_rows: int = DEFAULTS.min_rows) -> int:
    """Total rows of a validated dataset; raises on any problem or too few rows. Runs a job."""
    total = report.agg(
        F.sum("rows").alias("rows"), F.sum("problems").alias("problems")
    ).first()
    if total["problems"]:
        raise ValueError(f"{total['problems']} problem(s) in the source dataset")
    if total["rows"] < min_rows:
        raise ValueError(f"{total['rows']} rows, below the {min_rows} required")
    return total["rows"]
