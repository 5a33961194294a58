"""Control and policy sheets.

CSV sheets are read in splits, so a sheet may be of any size. A workbook is read whole by one task; many spread over many
tasks.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshift.operators.control import normalize_header
from lakeshift.sources.scratch import stored

# Columns of the five sheets.
COPY_COLUMNS = ["database", "table", "dest_database", "bucket", "endpoint", "partition_filter"]
CONVERSION_COLUMNS = ["database", "table", "inplace_migration", "destination_iceberg_database"]
FOLDER_COLUMNS = ["source_path", "target_bucket", "dest_folder", "endpoint"]
METADATA_COLUMNS = [
    "database", "table", "dest_database", "dest_bucket", "source_s3_prefix", "dest_s3_prefix", "source_table_path",
]
POLICY_COLUMNS = [
    "role", "database", "tables", "columns", "url", "permissions", "groups", "users", "rowfilter", "policy_label", "item_type",
]


def xlsx_available() -> bool:
    try:
        import openpyxl  # noqa: F401
    except ImportError:
        return False
    return True


def read_control_sheet(
    spark: SparkSession, path: str, columns: Sequence[str], fmt: str = "csv", underscore: bool = True
) -> DataFrame:
    """Sheet rows as (sheet_id, row_index, *columns); columns the sheet lacks are null.

    ``fmt`` is csv, xlsx (needs openpyxl), json or parquet; the last two must carry ``row_index``.
    """
    wanted = list(columns)
    if fmt in ("json", "parquet"):
        df = normalize_header(spark.read.format(fmt).load(path), underscore)
        have = set(df.columns)
        return df.select(
            F.col("sheet_id").cast("string") if "sheet_id" in have else F.lit(path).alias("sheet_id"),
            F.col("row_index").cast("bigint"),
            *[F.col(c).cast("string") if c in have else F.lit(None).cast("string").alias(c) for c in wanted],
        )
    if fmt == "csv":
        return _read_csv(spark, path, wanted, underscore)
    if fmt != "xlsx":
        raise ValueError(f"unknown sheet format: {fmt}")
    if not xlsx_available():
        raise RuntimeError("reading xlsx sheets needs openpyxl")
    schema = ", ".join(["sheet_id string", "row_index bigint", *[f"`{c}` string" for c in wanted]])

    # nested, so it reaches the workers by value; a workbook is a zip file, which cannot be read in parts
    def rows(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            for source, content in zip(batch["path"], batch["content"]):
                sheet = pd.read_excel(io.BytesIO(content), dtype=str, engine="openpyxl")
                names = [str(c).strip().lower() for c in sheet.columns]
                sheet.columns = [n.replace(" ", "_") if underscore else n for n in names]
                out = sheet.reindex(columns=wanted).astype(object)
                out = out.where(out.notna(), None)
                out.insert(0, "row_index", range(len(out)))
                out.insert(0, "sheet_id", source)
                yield out

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(rows, schema)


# A cell of a record that has a comma put in front: quoted, with doubled quotes inside, or plain.
CELL = r',("(?:[^"]|"")*"[^,]*|[^,]*)'


def _cells(record: Column) -> Column:
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(CELL), F.lit(1))
    inner = r'^"((?:[^"]|"")*)"(.*)$'
    return F.transform(
        raw,
        lambda c: F.when(
            c.startswith('"'), F.concat(F.replace(F.regexp_extract(c, "(?s)" + inner, 1), F.lit('""'), F.lit('"')), F.regexp_extract(c, "(?s)" + inner, 2))
        ).otherwise(c),
    )


def _read_csv(spark: SparkSession, path: str, wanted: list[str], underscore: bool) -> DataFrame:
    """Comma-separated sheets of any size, read in splits, with rows numbered as they stand in their file.

    A line begins a record when the quotes before it in its file are even in number. Lines and quotes are counted per split
    first; running sums of these counts over the splits of a file, in order of their offsets, tell for each split whether
    it begins within a quoted cell and how many records come before it. Lines end in LF or CR LF; blank lines between
    records do not count. Cells that a row lacks count as empty.
    """
    place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    lines = spark.read.option("lineSep", "\n").text(path).select(*place, F.monotonically_increasing_id().alias("at"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    inside = Window.partitionBy("file", "start").orderBy("at")  # the lines of one split
    lines = lines.withColumn("quotes", F.sum(quotes).over(inside) - quotes)
    blank = F.trim(F.translate("value", "\t\r", "")) == ""
    # records that begin in a split, if it begins outside of quotes or within
    opens = [F.count_if((F.pmod("quotes", F.lit(2)) == p) & ~blank) for p in (0, 1)]
    splits = lines.groupBy("file", "start").agg(F.sum(quotes).alias("in_split"), opens[0].alias("even"), opens[1].alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    splits = splits.withColumn("parity", F.pmod(F.coalesce(F.sum("in_split").over(before), F.lit(0)), F.lit(2)))
    begun = F.when(F.col("parity") == 0, F.col("even")).otherwise(F.col("odd"))
    splits = splits.withColumn("begun", F.coalesce(F.sum(begun).over(before), F.lit(0)))
    # each split knows its file's header, so that no join brings a whole file together
    placed = lines.join(splits.select("file", "start", "parity", "begun"), ["file", "start"])
    first = (F.pmod(F.col("quotes") + F.col("parity"), F.lit(2)) == 0) & ~blank
    placed = placed.withColumn("opens", first).withColumn("record", F.col("begun") + F.sum(first.cast("long")).over(inside) - 1)
    inner = (F.pmod(F.col("quotes") + F.col("parity"), F.lit(2)) == 1)
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "at", "value"))), lambda x: x["value"]), "\n")
    records = placed.where(F.col("opens") | inner).groupBy("file", "record").agg(F.rtrim(text, F.lit("\r")).alias("text"))
    records = stored(records.select("file", "record", _cells(F.col("text")).alias("cells")), "sheet")
    name = lambda c: F.lower(F.btrim(F.replace(c, F.lit("\ufeff"), F.lit(""))))
    named = F.transform("cells", (lambda c: F.replace(name(c), F.lit(" "), F.lit("_"))) if underscore else name)
    headers = {r.file: r.names for r in records.where("record = 0").select("file", named.alias("names")).toLocalIterator()}  # one row per sheet
    source = F.regexp_replace("file", "^file:///", "file:/")
    shapes = sorted({tuple(n) for n in headers.values()})
    if not shapes:
        return spark.createDataFrame([], ", ".join(["sheet_id string", "row_index bigint", *[f"`{c}` string" for c in wanted]]))
    parts = []
    for shape in shapes:
        mine = records if len(shapes) == 1 else records.where(F.col("file").isin([f for f, n in headers.items() if tuple(n) == shape]))
        at = {c: shape.index(c) for c in wanted if c in shape}
        cells = [(F.coalesce(F.get("cells", F.lit(at[c])), F.lit("")) if c in at else F.lit(None).cast("string")).alias(c) for c in wanted]
        parts.append(mine.where("record > 0").select(source.alias("sheet_id"), (F.col("record") - 1).alias("row_index"), *cells))
    return reduce(DataFrame.unionByName, parts)
