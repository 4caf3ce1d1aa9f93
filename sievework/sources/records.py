"""JSONL sources: lines with their file and order, byte-order marks, parse errors, and dynamic field access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PARSE = {"maxStringLen": "500000000"}


def read_lines(spark: SparkSession, paths: list[str] | str, glob: str = "*.jsonl", skip: tuple[str, ...] = (), bare_cr: bool = False) -> DataFrame:
    """(file, pos, line) of JSONL files and folders; pos ascends within a file.

    \\n ends a line, and a \\r before it goes. With bare_cr a \\r alone ends a line too, as the record programs read; the
    deduplication reads without. Files that are named themselves are read whatever their names.
    """
    reader = spark.read.option("pathGlobFilter", glob)
    lines = (reader if bare_cr else reader.option("lineSep", "\n")).text(paths)
    rows = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("_name"), F.monotonically_increasing_id().alias("pos"), F.rtrim("value", F.lit("\r")).alias("line"))
    return rows.filter(~F.col("_name").isin(*skip)).drop("_name") if skip else rows.drop("_name")


def line_counts(lines: DataFrame) -> DataFrame:
    """(file, lines), blank lines among them."""
    return lines.groupBy("file").agg(F.count("*").alias("lines"))


def numbered(lines: DataFrame) -> DataFrame:
    """lines with line_no, from 1 in each file: a split's first pos and the counts of the splits before it, so no file meets in one task."""
    split = F.shiftright("pos", 33)
    splits = lines.groupBy("file", split.alias("_split")).agg(F.min("pos").alias("_first"), F.count("*").alias("_n"))
    upto = Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    bases = splits.select("file", "_split", (F.coalesce(F.sum("_n").over(upto), F.lit(0)) - F.col("_first") + 1).alias("_base"))
    return lines.withColumn("_split", split).join(bases, ["file", "_split"]).withColumn("line_no", F.col("pos") + F.col("_base")).drop("_split", "_base")


def bom_files(spark: SparkSession, paths: list[str] | str, glob: str = "*.jsonl") -> DataFrame:
    """(file, bom) of every file with a line: whether it begins with a byte-order mark.

    Text readers drop the mark silently, so what is missing from a file's size tells: its lines and line ends are three bytes short, or two
    where the last line has no end. All tasks count alike; no file is opened by the driver. Files must not be compressed.
    """
    lines = spark.read.option("pathGlobFilter", glob).option("lineSep", "\n").text(paths)
    sized = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), (F.octet_length("value") + 1).alias("bytes"))
    return sized.groupBy("file").agg((F.max("size") - F.sum("bytes") >= 2).alias("bom"))


def file_findings(read: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """(file, line_no, rid, level, item, detail): lines that are no JSON or no UTF-8, and files that begin with a byte-order mark; read: parsed()."""
    found = lambda df, item, detail: df.select("file", F.col("line_no").cast("long").alias("line_no"), F.lit("?").alias("rid"), F.lit("ERROR").alias("level"), item.alias("item"), detail.alias("detail"))
    item = F.when(F.col("status") == "bad", "json_parse").otherwise("not_utf8")
    bad = found(numbered(read).filter("status in ('bad', 'not_utf8')"), item, F.left(F.make_valid_utf8("line"), F.lit(60)))
    if marks is None:
        return bad
    return bad.unionByName(found(marks.filter("bom").withColumn("line_no", F.lit(1)), F.lit("byte_order_mark"), F.lit("UTF-8")))


def require_utf8(read: DataFrame) -> None:
    """Raises where a line isn't UTF-8, naming files and the number of such lines; deduplication takes no part of such a corpus."""
    broken = read.filter("status = 'not_utf8'").groupBy("file").agg(F.count("*").alias("n")).orderBy("file").limit(10).collect()
    if broken:
        raise ValueError("not UTF-8: " + ", ".join(f"{r.file} ({r.n} lines)" for r in broken))


def parsed(lines: DataFrame) -> DataFrame:
    """lines with v (variant, NULL if the line is no JSON), keys (top-level) and status: ok, blank, bad, not_object or not_utf8.

    A line keeps its bytes up to here and is validated before anything decodes it.
    """
    valid = F.is_valid_utf8("line")
    v = F.when(valid, F.from_json("line", "variant", PARSE))  # try_parse_json gives NULL for very long strings
    blank = F.trim("line") == ""
    keys = F.when(valid, F.array_sort(F.json_object_keys("line")))
    status = F.when(~valid, "not_utf8").when(blank, "blank").when(F.col("v").isNull(), "bad").when(F.col("keys").isNull(), "not_object").otherwise("ok")
    return lines.withColumn("v", v).withColumn("keys", keys).withColumn("status", status)


def text_at(path: str, v: str = "v") -> Column:
    return F.try_variant_get(v, path, "string")


def type_at(path: str, v: str = "v") -> Column:
    """VOID for JSON null and for an absent key, else the type."""
    return F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")), F.lit("VOID"))


def absent(path: str, v: str = "v") -> Column:
    return F.try_variant_get(v, path, "variant").isNull()


def missing(path: str, v: str = "v") -> Column:
    """Absent, null or the empty string; false, 0 and empty arrays aren't missing."""
    return (type_at(path, v) == "VOID") | ((type_at(path, v) == "STRING") & (text_at(path, v) == ""))


def strings_at(path: str, v: str = "v") -> Column:
    """A field that is a string or an array of strings, as an array."""
    kind = type_at(path, v)
    one = F.array(text_at(path, v))
    return F.when(kind == "STRING", one).when(F.startswith(kind, F.lit("ARRAY")), F.try_variant_get(v, path, "array<string>")).otherwise(F.array().cast("array<string>"))


def missing_of(prefix: str, names: tuple[str, ...], test=missing) -> Column:
    """Those names below a prefix that are missing."""
    return F.filter(F.array(*[F.when(test(f"{prefix}.{n}"), F.lit(n)) for n in names]), lambda x: x.isNotNull())
