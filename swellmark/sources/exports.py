"""Raw daily exports: many small CSV texts whose headers differ."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swellmark import fixed
from swellmark.functions.scalars import stripped
from swellmark.operators.cleaning import clean_header, union_exports

RAW = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in ("raw_date", "raw_url", "raw_tone", "file_path")]
)


def _header_names(header: str) -> list[str]:
    return [clean_header(h) for h in header.split(",")]


def data_files(spark: SparkSession, paths: str | Sequence[str], strict_sniff: bool = False) -> DataFrame:
    """One row per file: file_path, header, n_lines, is_data.

    A file is data when its header has a column for the date. `strict_sniff`
    asks for one of two marks anywhere in the text instead. The header is the
    first line that is not blank: the lowest row id in the file's first block.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file_path"),
        (F.col("_metadata.file_block_start") == 0).alias("_opening"),
        F.monotonically_increasing_id().alias("_at"),
        F.col("value"),
    ).where(F.trim("value") != "")
    files = lines.groupBy("file_path").agg(
        F.min_by("value", F.when(F.col("_opening"), F.col("_at"))).alias("header"),
        F.count("*").alias("n_lines"),
        F.max(_has_any("value", fixed.SNIFF_MARKS)).alias("_marked"),
    )
    names = F.transform(
        F.split(F.regexp_replace("header", "^\\uFEFF+", ""), ","),
        lambda h: stripped(F.regexp_replace(stripped(h), '^"+|"+$', "")),
    )
    dated = F.arrays_overlap(names, F.array(*[F.lit(a) for a in fixed.DATE_ALIASES]))
    return files.select(
        "file_path", "header", "n_lines", (F.col("_marked") if strict_sniff else dated).alias("is_data")
    )


def _has_any(c: str, marks: Sequence[str]) -> Column:
    found = F.lit(False)
    for mark in marks:
        found = found | F.col(c).contains(mark)
    return found


def _local_form(file_path: str) -> str:
    """The path as the reader takes it: metadata paths are URL-encoded."""
    parts = urlparse(file_path)
    return file_path if not parts.scheme else unquote(file_path)


def read_raw_exports(
    spark: SparkSession, paths: str | Sequence[str], strict_sniff: bool = False
) -> DataFrame:
    """All data files as raw_date, raw_url, raw_tone, file_path (all text).

    Files are grouped by header, and each group is one CSV scan by position, so
    columns cannot swap between spellings. Only file names and headers come to
    the driver, which lists the files anyway to plan the scan.
    """
    files = data_files(spark, paths, strict_sniff).where("is_data").select("header", "file_path")
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in files.collect():
        groups.setdefault(tuple(_header_names(row.header)), []).append(_local_form(row.file_path))
    if not groups:
        return spark.createDataFrame([], RAW)
    return union_exports([_read_group(spark, names, sorted(files)) for names, files in sorted(groups.items())])


def _read_group(spark: SparkSession, names: Sequence[str], files: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(f"c{i}", T.StringType(), True) for i in range(len(names))])
    # A repeated header means its last column.
    place = {name: f"c{i}" for i, name in enumerate(names)}
    raw = spark.read.schema(schema).csv(files, header=True, quote='"', escape='"', enforceSchema=True)

    def picked(aliases: Sequence[str]) -> Column:
        found = [F.nullif(F.col(place[a]), F.lit("")) for a in aliases if a in place]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    return raw.select(
        picked(fixed.DATE_ALIASES).alias("raw_date"),
        picked(fixed.URL_ALIASES).alias("raw_url"),
        picked(fixed.TONE_ALIASES).alias("raw_tone"),
        F.col("_metadata.file_path").alias("file_path"),
    )


#: A field of a CSV line, quoted or not, with the comma behind it or the end of the line.
FIELD = r'("[^"]*(?:""[^"]*)*"|[^,]*)(?:,|$)'


def export_lines(lines: DataFrame, path: str = "file_path", opening: str = "opening") -> DataFrame:
    """Lines of text files with their file's header: `file_path`, `value`, `names`, `is_header`, `marked`.

    `lines` has `value`, the file's path, and whether the line is of the file's first
    block; rows are in file order, as a scan gives them. Blank lines are left out. A file
    whose first block has only blank lines has no header, and no rows here.
    """
    kept = lines.where(F.trim("value") != "").withColumn("_at", F.monotonically_increasing_id())
    place = F.when(F.col(opening), F.col("_at"))
    # A row per file, whatever its size; lines of a hot file are counted where they are read.
    files = kept.groupBy(F.col(path).alias("_file")).agg(
        F.min_by("value", place).alias("_header"),
        F.min(place).alias("_first"),
        F.max(_has_any("value", fixed.SNIFF_MARKS)).alias("marked"),
    )
    names = F.transform(
        F.split(F.regexp_replace("_header", "^\\uFEFF+", ""), ","),
        lambda h: stripped(F.regexp_replace(stripped(h), '^"+|"+$', "")),
    )
    files = files.where("_header is not null").withColumn("names", names)
    joined = kept.join(files, kept[path] == files["_file"])
    return joined.select(
        F.col(path).alias("file_path"), "value", "names", (F.col("_at") == F.col("_first")).alias("is_header"), "marked"
    )


def csv_fields(line: Column | str) -> Column:
    """The fields of a CSV line, quotes undone; an empty one may follow the last."""
    fields = F.regexp_extract_all(line, F.lit(FIELD), F.lit(1))
    bare = lambda f: F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))
    return F.transform(fields, lambda f: F.when(f.startswith('"') & (F.length(f) > 1) & f.endswith('"'), bare(f)).otherwise(f))


def parsed_exports(lines: DataFrame, strict_sniff: bool = False) -> DataFrame:
    """raw_date, raw_url, raw_tone, file_path of the data lines among `export_lines`, by their own file's header.

    A repeated header means its last column, fields beyond the header are ignored, missing ones null.
    """
    dated = F.arrays_overlap("names", F.array(*[F.lit(a) for a in fixed.DATE_ALIASES]))
    kept = lines.where(~F.col("is_header") & (F.col("marked") if strict_sniff else dated))
    cells = kept.select("file_path", F.arrays_zip(F.col("names").alias("name"), csv_fields("value").alias("field")).alias("cells"))

    def last_of(alias: str) -> Column:
        return F.try_element_at(F.filter("cells", lambda c: c["name"] == alias), F.lit(-1))["field"]

    def picked(aliases: Sequence[str]) -> Column:
        return F.coalesce(*[F.nullif(last_of(alias), F.lit("")) for alias in aliases])

    return cells.select(
        picked(fixed.DATE_ALIASES).alias("raw_date"),
        picked(fixed.URL_ALIASES).alias("raw_url"),
        picked(fixed.TONE_ALIASES).alias("raw_tone"),
        "file_path",
    )


def read_exports_by_line(spark: SparkSession, paths: str | Sequence[str], strict_sniff: bool = False) -> DataFrame:
    """As `read_raw_exports`, as one plan: no file name comes to the driver, and headers may be as many as files.

    Lines meet their file's header in a join. Quoted fields may hold commas and doubled quotes but, as there, no line breaks.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        (F.col("_metadata.file_block_start") == 0).alias("opening"),
    )
    return parsed_exports(export_lines(lines), strict_sniff)
