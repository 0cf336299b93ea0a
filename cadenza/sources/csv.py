"""CSV source for the raw track table.

The source file has a header row and an unnamed first column (the row
index).  The schema is fixed, never inferred.  Text that the pandas reader
treats as missing (``NA``, ``None``, ``null``, ...) becomes null in the
string columns, so a title spelled ``None`` is dropped by the null filter as
in the reference.

A file is read in byte ranges though quoted fields may hold line breaks.  Each
task reads the physical lines of its range; a line break ends a record where an
even number of quotes stands before it in the file.  Ranges are counted first,
and a running count over the ranges of a file (a few numbers each) tells every
range whether it begins inside quotes and which record it goes on with.  The
lines of one record are then joined and parsed by ``from_csv``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza import schema as S

_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_record"}
#: what a task knows of a physical line: its text, its file, where its byte range starts, its order inside the range
LINE = ["line", "file", "start", "nr"]


def lines(text: DataFrame) -> DataFrame:
    """Physical lines (``LINE``) of a text source, batch or stream, with its ``_metadata``."""
    return text.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("start"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return number_lines(lines(spark.read.option("lineSep", "\n").text(path)))


def number_lines(found: DataFrame) -> DataFrame:
    """The order of lines inside their byte range: a task reads a range from front to back."""
    return found.withColumn("nr", F.monotonically_increasing_id())


def records(found: DataFrame) -> DataFrame:
    """``(file, record, first)`` from numbered lines: the text of each record;
    ``first`` marks the one that a file begins with.

    Empty lines between records are skipped.  A file whose quotes do not pair
    up is refused, since its records cannot be told apart.  Lines of a byte range
    without parts of records stay where they were read in; only those of the other
    ranges are numbered and joined by key.
    """
    quotes = (F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))).cast("long")
    found = found.withColumn("quotes", quotes)
    # one row a byte range: whether its lines have to be placed in records.  A range without an odd line that begins
    # outside quotes holds whole records alone, and leaves the count of quotes before every other range even or odd as it is
    of_file = Window.partitionBy("f").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    plain = (found.groupBy(F.col("file").alias("f"), F.col("start").alias("s"))
             .agg(F.count_if(F.col("quotes") % 2 != 0).alias("odd"), F.min("nr").alias("first_nr")))
    plain = plain.select("f", "s", "first_nr", ((F.col("odd") == 0) & (F.coalesce(F.sum("odd").over(of_file), F.lit(0)) % 2 == 0)).alias("plain"))
    # bounded: a row a byte range.  Lines stay in the task that read them
    dealt = found.join(F.broadcast(plain), (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")))
    whole = dealt.where("plain").select("file", F.col("line").alias("record"), ((F.col("start") == 0) & (F.col("nr") == F.col("first_nr"))).alias("first"))
    every = whole.unionByName(_placed(dealt.where("NOT plain").select(*LINE, "quotes")))
    return every.select("file", _bare("record").alias("record"), "first").where("first OR record != ''")


def _placed(found: DataFrame) -> DataFrame:
    """:func:`records` of byte ranges that hold parts of records."""
    in_range = Window.partitionBy("file", "start").orderBy("nr")
    so_far = in_range.rowsBetween(Window.unboundedPreceding, -1)
    # places inside a range do not depend on how ranges are dealt to tasks, as a task's own numbers do
    found = found.select(
        "line", "file", "start", F.row_number().over(in_range).alias("nr"), "quotes",
        F.coalesce(F.sum("quotes").over(so_far), F.lit(0)).alias("inside"))
    found = found.withColumn("first", (F.col("start") == 0) & (F.col("nr") == 1))
    # one row a byte range: its quotes, and the last line that begins a record if the range begins outside or inside quotes
    even = F.col("inside") % 2 == 0
    ranges = found.groupBy("file", "start").agg(F.sum("quotes").alias("n"), F.max(F.when(even, F.col("nr"))).alias("last_outside"),
                                                F.max(F.when(~even, F.col("nr"))).alias("last_inside"))
    of_file = Window.partitionBy("f").orderBy("s")
    earlier = of_file.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("file").alias("f"), F.col("start").alias("s"), "n", "last_outside", "last_inside")
    ranges = ranges.select("f", "s", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                           F.sum("n").over(Window.partitionBy("f")).alias("all"), "last_outside", "last_inside")
    last = F.when(F.col("before") % 2 == 0, F.col("last_outside")).otherwise(F.col("last_inside"))
    goes_on = F.last(F.when(last.isNotNull(), F.struct(F.col("s"), last.alias("nr"))), ignorenulls=True).over(earlier)
    ranges = ranges.select("f", "s", "before", "all", goes_on.alias("goes_on"))

    placed = found.join(ranges, (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")))
    told = F.raise_error(F.concat(F.lit("quotes do not pair up in "), "file")).cast("boolean")
    begins = F.when(F.col("all") % 2 != 0, told).otherwise((F.col("before") + F.col("inside")) % 2 == 0)
    placed = placed.select(*LINE, "first", "quotes", "goes_on", begins.alias("begins"))
    alone = F.col("begins") & (F.col("quotes") % 2 == 0)
    single = placed.where(alone).select("file", F.col("line").alias("record"), "first")
    # the line at which a longer record begins: in its range, else the last one of an earlier range
    here = F.last(F.when(F.col("begins"), F.col("nr")), ignorenulls=True).over(in_range.rowsBetween(Window.unboundedPreceding, 0))
    parts = placed.withColumn("at", here).where(~alone).select(
        "file", F.when(F.col("at").isNull(), F.col("goes_on.s")).otherwise(F.col("start")).alias("of_start"),
        F.coalesce("at", "goes_on.nr").alias("of"), "start", "nr", "line", "first")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "nr", "line"))), lambda x: x["line"]), "\n")
    longer = parts.groupBy("file", "of_start", "of").agg(text.alias("record"), F.max("first").alias("first"))
    return single.unionByName(longer.select("file", "record", "first"))


def _bare(c: str) -> Column:
    """A record without the carriage return of its line end."""
    return F.when(F.col(c).endswith("\r"), F.expr(f"left({c}, length({c}) - 1)")).otherwise(F.col(c))


def _columns(header: str) -> list[str]:
    """The column names of a header record; the unnamed first one is the row number."""
    import csv
    import io
    names = next(csv.reader(io.StringIO(header.removeprefix("\ufeff"), newline="")), [])
    index = S.RAW_SCHEMA.fields[0].name
    names = [index if k == 0 and c == "" else c for k, c in enumerate(names)]
    if missing := {f.name for f in S.RAW_SCHEMA.fields} - set(names):
        raise ValueError(f"columns missing from the header: {sorted(missing)}")
    return names


def parse_records(found: DataFrame, header: str, pandas_missing: bool = True, on_bad: str = "fail") -> DataFrame:
    """The raw table from records of files that all begin with ``header``."""
    if on_bad not in ("fail", "report"):
        raise ValueError("on_bad is 'fail' or 'report'")
    names = _columns(header)
    fields = ", ".join(f"`{c}` string" for c in names)
    body = found.where(F.when(F.col("first") & (F.col("record") != F.lit(header)), F.raise_error(F.concat(
        F.lit("another header in "), "file"))).otherwise(~F.col("first")))
    # as a generator the record is parsed once and whole: taken field by field it would be parsed for each, without the others
    parsed = body.select(F.inline(F.array(F.from_csv("record", F.lit(f"{fields}, `_record` string"), _OPTIONS))))
    cols, bad = _typed(F.col("_record").isNotNull(), pandas_missing)
    if on_bad == "report":
        return parsed.select(*cols, bad.alias("_bad"))
    told = F.concat(F.lit("malformed CSV record: "), F.coalesce("_record", F.col(f"`{S.RAW_SCHEMA.fields[0].name}`"), F.lit("")))
    # as a filter the check stays, whichever columns a reader takes
    return parsed.where(F.when(bad, F.raise_error(told)).otherwise(F.lit(True))).select(*cols)


def _typed(bad: Column, pandas_missing: bool) -> tuple[list[Column], Column]:
    """The raw columns from text, and whether a record does not fit."""
    cols = []
    for f in S.RAW_SCHEMA.fields:
        text = F.col(f"`{f.name}`")
        if f.name not in S.STRING_COLS or pandas_missing:
            text = F.when(~text.isin(*S.MISSING_MARKERS), text)
        value = text if f.name in S.STRING_COLS else text.try_cast(f.dataType)
        if f.name not in S.STRING_COLS:
            bad = bad | (text.isNotNull() & value.isNull())
        cols.append(value.alias(f.name))
    return cols, bad


def first_header(found: DataFrame) -> str | None:
    """The header of the first file by path (None: no records)."""
    row = found.where("first").orderBy("file").select("record").first()
    return row and row["record"]


def _header_of(spark: SparkSession, path: str) -> str:
    """The header record of the first file by path: its first lines, as many as pair up their quotes."""
    files = spark.read.text(path).inputFiles()
    if not files:
        raise ValueError(f"no file in {path}")
    head, n = None, 1
    while head is None or head.count('"') % 2:
        taken = [r["value"] for r in spark.read.option("lineSep", "\n").text(_escaped(min(files))).limit(n).collect()]
        head = "\n".join(taken)
        if len(taken) < n:
            break
        n *= 2
    return head.removesuffix("\r")


def _escaped(file_path: str) -> str:
    """A file's own path as a pattern that matches it alone."""
    from urllib.parse import unquote
    return "".join(f"\\{c}" if c in "[]{}*?\\" else c for c in unquote(file_path))


def read_tracks_csv(spark: SparkSession, path: str, multi_line: bool = True, pandas_missing: bool = True,
                    on_bad: str = "fail") -> DataFrame:
    """Read one or many CSV files into the raw schema.

    Columns are taken by header name, whatever their order; a missing one is
    refused, as is a file with another header than the first.  The unnamed
    first column is the row number.  A record that does not fit (wrong number of
    fields, text in a number's place) fails the read, or with
    ``on_bad="report"`` stays with nulls and ``_bad`` true, so that it can be
    counted.  Files are read in byte ranges; quoted fields may hold line breaks,
    which ``multi_line=False`` spares the work for (each line is a record).
    """
    if on_bad not in ("fail", "report"):
        raise ValueError("on_bad is 'fail' or 'report'")
    header = _header_of(spark, path)
    if multi_line:
        return parse_records(records(read_lines(spark, path)), header, pandas_missing, on_bad)
    found = lines(spark.read.option("lineSep", "\n").text(path)).select("file", _bare("line").alias("record"))
    # every line that reads like the header is one
    return parse_records(found.where("record != ''").withColumn("first", F.col("record") == F.lit(header)), header, pandas_missing, on_bad)


def write_tracks_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a raw table in the source layout (header, index column first)."""
    (df.select(*[f.name for f in S.RAW_SCHEMA.fields])
       .write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
       .csv(path))
