"""Record files: strict and tolerant JSON lines, snapshots of several formats, Markdown, and the sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexquarry.functions.text import first_present
from lexquarry.operators.ranking import numbered
from lexquarry.sources.published import Table, Version, publish


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of a schema; a malformed row fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_tolerant(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the rejected lines with their files."""
    lines = spark.read.text(path, recursiveFileLookup=True).where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("file"))
    marked = lines.select("*", F.from_json("value", StructType([*schema.fields]).add("_bad", "string"), {"columnNameOfCorruptRecord": "_bad"}).alias("row"))
    bad = F.col("row").isNull() | F.col("row._bad").isNotNull()
    return marked.where(~bad).select(*(F.col(f"row.{f.name}") for f in schema.fields)), marked.where(bad).select("file", "value")


def line_report(spark: SparkSession, folder: str, key: str = "id") -> DataFrame:
    """Per JSON-lines file under ``folder``: rows, rows with an id, invalid rows."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").text(folder).where(F.trim("value") != "")
    got = lines.select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("v"), F.get_json_object("value", f"$.{key}").alias("id"))
    return got.groupBy("file").agg(F.count("*").alias("rows"), F.count("id").alias("with_id"), F.count_if(F.col("v").isNull()).alias("invalid"))


def read_snapshot(spark: SparkSession, path: str, aliases: dict[str, list[str]]) -> DataFrame:
    """A snapshot (CSV with header, JSON lines, or JSON) under canonical names, each the first present of its aliases."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        rows = spark.read.option("header", True).csv(path)
    else:
        rows = spark.read.option("multiLine", suffix == "json").json(path)
        nested = [c for c in ("records", "results", "items", "data") if c in rows.columns]
        if nested:
            rows = rows.select(F.explode(nested[0]).alias("r")).select("r.*")
    have = set(rows.columns)
    return rows.select(*(first_present(*[F.col(f"`{a}`").cast("string") for a in names if a in have]).alias(c) if have & set(names) else F.lit(None).cast("string").alias(c) for c, names in aliases.items()))


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """Per file: frontmatter as a map, first heading, body and digest."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("content"))
    head = F.regexp_extract("content", r"(?s)\A---\n(.*?)\n---", 1)
    pairs = F.transform(F.filter(F.split(head, "\n"), lambda x: x.contains(":")), lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("k"), F.trim(F.regexp_replace(x, r"^[^:]*:", ""), F.lit(" \"'")).alias("v")))
    return files.select(
        "file",
        F.map_from_entries(pairs).alias("frontmatter"),
        F.regexp_extract("content", r"(?m)^#{1,6}[ \t]+(.+?)[ \t]*$", 1).alias("heading"),
        F.regexp_replace("content", r"(?s)\A---\n.*?\n---\n?", "").alias("body"),
        F.sha2("content", 256).alias("sha256"),
    )


def upsert(target: DataFrame, rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """``target`` with rows of the same keys replaced and new ones added.

    Of repeated keys in ``rows`` the one with the greatest ``order`` counts (any one without an order); null equals null.
    """
    rest = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)) if order else F.first(F.struct(*rest))
    fresh = rows.groupBy(*keys).agg(last.alias("_row")).select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest))
    named = fresh.select(*(F.col(k).alias(f"_{k}") for k in keys))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return target.join(named, same, "left_anti").unionByName(fresh)


def read_jsonl_optional(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """As :func:`read_jsonl`, but a path that is not there gives no rows, and blank lines are skipped."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], schema)
    rows = spark.read.text(path).where(F.trim("value") != "")
    return rows.select(F.from_json("value", spark.createDataFrame([], schema).schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_manifest(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """``file, line, row, error`` of JSON lines: the line's number (blank lines count) and what is wrong with it, if anything."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("_at"))
    lines = numbered(raw, "file", F.col("_at")).where(F.trim("value") != "")
    marked = lines.select("file", F.col("rank").alias("line"), F.from_json("value", StructType([*schema.fields]).add("_bad", "string"), {"columnNameOfCorruptRecord": "_bad"}).alias("r"), "value")
    bad = F.col("r").isNull() | F.col("r._bad").isNotNull()
    return marked.select("file", "line", F.when(~bad, F.struct(*(F.col(f"r.{f.name}") for f in schema.fields))).alias("row"), F.when(bad, F.concat(F.lit("malformed: "), F.substring("value", 1, 80))).alias("error"))


def read_layers(spark: SparkSession, manifest: dict[str, str], schema: StructType | str) -> DataFrame:
    """The index files of all layers of a manifest (name to path) with the layer's name."""
    parts = [read_jsonl_optional(spark, path, schema).withColumn("layer", F.lit(name)) for name, path in sorted(manifest.items())]
    return reduce(DataFrame.unionByName, parts)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and quoted text; lists, maps and structs go as JSON."""
    nested = [f.name for f in df.schema if f.dataType.typeName() in ("array", "map", "struct")]
    plain = df.withColumns({c: F.to_json(F.col(f"`{c}`")) for c in nested})
    plain.write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True).csv(path)


def write_snapshot(df: DataFrame, folder: str, version: str) -> str:
    """JSON lines in a folder of their own for each version, so that the version before stays as it was; returns the path."""
    path = f"{folder.rstrip('/')}/version={version}"
    df.write.mode("overwrite").json(path)
    return path


def append_jsonl(df: DataFrame, path: str, schema: StructType | str) -> None:
    """Append rows of the schema to JSON lines whose own rows still fit it (checked first, as a malformed file must not grow)."""
    read_jsonl_optional(df.sparkSession, path, schema).write.format("noop").mode("overwrite").save()
    df.write.mode("append").json(path)


def write_object(df: DataFrame, path: str) -> None:
    """A summary of one row as one indented JSON object in a file of that name's folder; more rows are an error, none writes no object."""
    if len(df.limit(2).collect()) > 1:
        raise ValueError("an object is written of one row")
    whole = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"pretty": "true"})
    df.select(whole.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def replace_index(tables: dict[str, tuple[DataFrame, list[str]]], folder: str) -> Version:
    """Replace all tables of an index in one step, one row for each key; returns the new version (see :mod:`lexquarry.sources.published`)."""
    spark = next(iter(tables.values()))[0].sparkSession
    return publish(spark, folder, {name: Table(df, tuple(keys)) for name, (df, keys) in tables.items()}, carry=False)


def write_by_quarter(df: DataFrame, path: str, date: str) -> None:
    """JSON lines in a folder for each year and quarter."""
    df.withColumn("year", F.year(date)).withColumn("quarter", F.quarter(date)).write.partitionBy("year", "quarter").mode("overwrite").json(path)
