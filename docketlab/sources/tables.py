"""Reading and writing of record streams, tables, nested bundles and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.extract import export_agency

#: Raw case bundles.
BUNDLE = (
    "case_name string, provisional_case_name string, case_files array<struct<file_name:string,sha1:string,summary:string,page_range:struct<gdrive_id:string>,"
    "ocr_doc_text_per_page:struct<page_texts:array<struct<page_number:int,text:string>>>>>"
)


def read_records(spark: SparkSession, path: str, schema: str | None = None, strict: bool = False) -> DataFrame:
    """One JSON object a line; blank lines are skipped, broken ones are null rows, or errors if ``strict``."""
    reader = spark.read.option("mode", "FAILFAST" if strict else "PERMISSIVE")
    return (reader.schema(schema) if schema else reader).json(path)


def write_records(df: DataFrame, path: str, append: bool = False) -> DataFrame:
    """Write one JSON object a line; returns the written rows' count as a one-row table, read back from the files."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)
    return df.sparkSession.read.schema(df.schema).json(path).agg(F.count("*").alias("n"))


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A table by its suffix: Parquet, JSON lines, or else CSV with a header (quotes doubled, values over lines)."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    if path.rstrip("/").endswith((".jsonl", ".json")):
        return read_records(spark, path, schema)
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_bundles(spark: SparkSession, glob: str) -> DataFrame:
    """Case bundles with ``file``, the name of the file each is from; unreadable ones have null fields."""
    return spark.read.schema(BUNDLE).option("multiLine", True).option("mode", "PERMISSIVE").json(glob).withColumn("file", F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1))


def bundle_pages(bundles: DataFrame) -> DataFrame:
    """One row for each page of each file with text, and where it is from."""
    files = bundles.select(F.coalesce("provisional_case_name", "case_name", "file").alias("provisional_case_name"), F.explode("case_files").alias("f"))
    pages = files.select("provisional_case_name", F.col("f.file_name").alias("file_name"), F.col("f.sha1").alias("sha1"), F.col("f.page_range.gdrive_id").alias("gdrive_id"), F.col("f.summary").alias("summary"), F.explode("f.ocr_doc_text_per_page.page_texts").alias("p"))
    return pages.select("provisional_case_name", "file_name", "sha1", "gdrive_id", F.col("p.page_number").alias("page_number"), F.col("p.text").alias("text")).where(F.trim(F.coalesce("text", F.lit(""))) != "")


def bundles_of(bundles: DataFrame, truth: DataFrame | None) -> DataFrame:
    return bundles if truth is None else bundles.join(truth.select("provisional_case_name").distinct(), "provisional_case_name", "left_semi")


def read_exports(spark: SparkSession, glob: str, columns: list[str] | None = None) -> DataFrame:
    """Union of exports, with the agency that each file's name has; only the columns asked for are read."""
    rows = read_table(spark, glob).withColumn("agency", export_agency(F.input_file_name()))
    return rows.select(*columns, "agency") if columns else rows


def read_mentions(spark: SparkSession, path: str, default_state: str, sample: int | None = None, seed: int = 0) -> DataFrame:
    """Officer mentions: latest year of the dates, names in capitals, a default state, rows without a year dropped."""
    from ..functions.dates import latest_year
    from ..functions.text import _text

    rows = read_table(spark, path)
    year = F.coalesce(F.col("incident_year").try_cast("int"), latest_year("incident_date") if "incident_date" in rows.columns else F.lit(None).cast("int"))
    rows = rows.withColumn("incident_year", year).where(F.col("incident_year").isNotNull())
    upper = {c: F.upper(F.trim(_text(c))) for c in ("first_name", "middle_name", "last_name", "suffix") if c in rows.columns}
    rows = rows.withColumns(upper).withColumn("state", F.coalesce(F.col("state"), F.lit(default_state)) if "state" in rows.columns else F.lit(default_state))
    return rows if sample is None else rows.orderBy(F.xxhash64(*rows.columns, F.lit(seed))).limit(sample)


def read_names(spark: SparkSession, path: str, drop_mentioned: bool = True) -> DataFrame:
    """Officer names; roles with "mentioned" are left out unless asked for."""
    rows = read_table(spark, path)
    mentioned = F.coalesce(F.contains(F.lower("roles"), F.lit("mentioned")), F.lit(False)) if "roles" in rows.columns else F.lit(False)
    return rows.where(~mentioned) if drop_mentioned else rows


def write_buckets(results: DataFrame, path: str, bucket) -> None:
    """Results by bucket as JSON lines, in a folder for each."""
    results.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").json(path)


def resume(df: DataFrame, path: str, key: str) -> DataFrame:
    """Rows whose key is not among the results already written to ``path`` (Parquet); all, if there are none yet."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return df
    return df.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti")


def merged_features(df: DataFrame, earlier: DataFrame, key: str) -> DataFrame:
    """Earlier values of columns in common where this run has none."""
    both = [c for c in df.columns if c in earlier.columns and c != key]
    old = earlier.select(key, *[F.col(c).alias(f"__{c}") for c in both])
    out = df.join(old, key, "left").withColumns({c: F.coalesce(F.col(c), F.col(f"__{c}")) for c in both})
    return out.drop(*[f"__{c}" for c in both])
