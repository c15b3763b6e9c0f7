"""Readers for landed input files.

The original scripts download archives and workbooks; here the files are landed
first (unzipped, one delimited file per sheet) and read with declared schemas, so
nothing is inferred over the full input and every read splits across tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelspark.functions.labels import safe_double, safe_int
from panelspark.operators.frames import checked_broadcast, fits_broadcast
from panelspark.session import ensure_checkpoint_dir
from panelspark.sources.lines import numbered_lines, split_lines

CORRUPT = "_corrupt_record"


def string_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


MAX_HEADERS = 100          # different headers among the files of one read


def file_headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, line, id): the first line of every file, with its number among the lines as ``text_lines`` has them."""
    first = text_lines(spark, paths).where("start = 0").groupBy("file").agg(F.min_by("value", "id").alias("line"), F.min("id").alias("id"))
    return first.withColumn("line", F.rtrim("line", F.lit("\r")))


def text_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of text files: file, start (of the line's split), id (ascending in a file's split), value."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"), "value")


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: StructType | Sequence[str] | None = None,
                   sep: str = "|", header: bool = True, keep_corrupt: bool = True) -> DataFrame:
    """Delimited text with a header and possibly ragged rows.

    ``schema`` is either a ``StructType`` matching the file's columns in order, or
    a list of the column names wanted: then every file's header is read first (one
    line; at most ``MAX_HEADERS`` different ones, more raise), and every row is read as text by its own file's
    header, so files with more columns, or in another order, read correctly; a
    wanted column that a file lacks raises.  ``None`` keeps the columns of all
    headers, as text (NULL where a file lacks one).  With a ``StructType`` a file whose
    header differs fails the read.  Short rows are
    padded with NULL, long rows truncated; with ``keep_corrupt`` both are flagged
    in ``_corrupt_record`` (Spark parses only the columns a query reads, so a
    row is flagged relative to those; read all columns to audit every row).
    The separator always separates.  A text field that stands whole in double quotes loses
    them; any other quote, and ``#``, is data.  Identifiers stay text so leading zeros survive.
    """
    paths = path if isinstance(path, str) else list(path)
    if not isinstance(schema, StructType):
        return _read_by_header(spark, paths, schema, sep, header, keep_corrupt)
    full = StructType(list(schema.fields) + ([StructField(CORRUPT, StringType(), True)] if keep_corrupt else []))
    reader = (spark.read.schema(full).option("sep", sep).option("header", header)
              .option("mode", "PERMISSIVE").option("enforceSchema", False).option("quote", ""))
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return unquoted(reader.csv(paths))


def unquoted(df: DataFrame) -> DataFrame:
    """Text fields without the double quotes around them (the line kept as corrupt stays as it is)."""
    bare = {f.name: F.regexp_replace(F.col(f"`{f.name}`"), '^"(.*)"$', "$1")
            for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name != CORRUPT}
    return df.withColumns(bare)


def _read_by_header(spark: SparkSession, paths: str | list[str], wanted: Sequence[str] | None, sep: str,
                    header: bool, keep_corrupt: bool) -> DataFrame:
    """Every file by its own header.  Files meet their headers in the executors; only the different headers reach the driver."""
    ensure_checkpoint_dir(spark)
    heads = file_headers(spark, paths).checkpoint()
    lines = sorted(r["line"] for r in heads.select("line").distinct().limit(MAX_HEADERS + 1).collect())
    if len(lines) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers in {paths}")
    if len(lines) <= 1:
        names = spark.read.option("sep", sep).option("header", True).option("quote", "").csv(paths).columns
        _check_wanted(wanted, names)
        df = read_delimited(spark, paths, string_schema(names), sep, header, keep_corrupt)
        return df.select(*(wanted if wanted is not None else names), *([CORRUPT] if keep_corrupt else []))
    named = {line: line.split(sep) for line in lines}
    for names in named.values():
        _check_wanted(wanted, names)
        if len(set(names)) < len(names):
            raise ValueError(f"a header names a column twice: {names}")
    body = text_lines(spark, paths).join(checked_broadcast(heads.select("file", "line", F.col("id").alias("_head"))), "file")
    body = body.where((F.col("id") != F.col("_head")) & (F.trim("value") != ""))
    cells: dict[str, Column] = {}
    for line, names in named.items():
        schema = ", ".join(f"`{n}` string" for n in [*names, CORRUPT])
        row = F.from_csv("value", schema, {"sep": sep, "mode": "PERMISSIVE", "quote": "", "columnNameOfCorruptRecord": CORRUPT})
        for n in [*names, CORRUPT]:
            cells[n] = (cells[n] if n in cells else F).when(F.col("line") == line, row[n])
    kept = [*(wanted if wanted is not None else [n for n in cells if n != CORRUPT]), *([CORRUPT] if keep_corrupt else [])]
    return unquoted(body.select(*[cells[n].alias(n) for n in kept]))


def _check_wanted(wanted: Sequence[str] | None, names: Sequence[str]) -> None:
    missing = [c for c in wanted or [] if c not in names]
    if missing:
        raise KeyError(f"columns not in the header: {missing}")


def parse_delimited(df: DataFrame, col: str, names: Sequence[str], sep: str = "|") -> DataFrame:
    """Text lines of one column to text columns, by the rules of ``read_delimited``.

    The line's own columns are replaced; a line with another number of fields keeps its text in ``_corrupt_record``.
    """
    schema = string_schema(names).add(CORRUPT, StringType())
    options = {"sep": sep, "mode": "PERMISSIVE", "quote": "", "columnNameOfCorruptRecord": CORRUPT}
    return df.select(F.from_csv(F.col(col), schema.simpleString()[len("struct<"):-1].replace(":", " "), options).alias("_r")).select("_r.*").transform(unquoted)


def corrupt_rows(df: DataFrame) -> int:
    """Number of rows flagged in ``_corrupt_record``, with every column parsed."""
    whole = df.select(F.col(CORRUPT).isNotNull().cast("long").alias("bad"), F.hash(*df.columns).alias("_all"))
    return whole.agg(F.sum("bad"), F.max("_all")).first()[0] or 0


def read_lookup(spark: SparkSession, path: str, schema: StructType | None = None, key: str | None = None) -> DataFrame:
    """Comma-separated lookup table with a header (small; joined by broadcast after a size check).

    Without a schema every header column is read as text (keys keep leading zeros).
    With ``key`` a repeated key raises: it would multiply the rows of every join.
    """
    reader = spark.read.option("header", True)
    df = (reader.schema(schema) if schema is not None else reader).csv(path)
    if key is not None:
        twice = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col(key).isNotNull() & (F.col("n") > 1)).take(3)
        if twice:
            raise ValueError(f"repeated key {key!r} in the lookup {path}: {[r[0] for r in twice]}")
    return df


SERIES_SCHEMA = StructType.fromJson({"type": "struct", "fields": [
    {"name": "geoset_id", "type": "string", "nullable": True, "metadata": {}},
    {"name": "geography", "type": "string", "nullable": True, "metadata": {}},
    {"name": "description", "type": "string", "nullable": True, "metadata": {}},
    {"name": "units", "type": "string", "nullable": True, "metadata": {}},
    {"name": "data", "type": {"type": "array", "elementType": {"type": "array", "elementType": "string",
                                                                "containsNull": True},
                              "containsNull": True}, "nullable": True, "metadata": {}},
]})


def parse_series(df: DataFrame, col: str, schema: StructType = SERIES_SCHEMA) -> DataFrame:
    """JSON series records of one text column to columns."""
    return df.select(F.from_json(F.col(col), schema).alias("_r")).select("_r.*")


def read_series_ndjson(spark: SparkSession, path: str, schema: StructType = SERIES_SCHEMA) -> DataFrame:
    """One JSON series record per line; ``data`` is a list of [year, value] pairs (as text)."""
    return spark.read.schema(schema).json(path)


SHEET_COLUMNS = ("year", "month", "state", "typeofproducer", "energysource", "generation")


def read_sheet_set(spark: SparkSession, folder: str | Sequence[str], exclude: Sequence[str] = ("EnergySource_Notes",),
                   names: Sequence[str] = SHEET_COLUMNS, title_rows: int | Mapping[str, int] | None = None,
                   sheet: Column | None = None) -> DataFrame:
    """All sheets of a workbook, landed as one delimited file per sheet, in one read.

    ``title_rows`` says how many rows stand above a sheet's header row (one number, or one per sheet; a sheet that
    is not listed has none): exactly those and the header go, by the rows' numbers in their file.  Without it,
    a sheet's data begin at its first row whose year and value (the last column) are both numbers.  Every later row stays,
    damaged or not (a cell that is no number is NULL; ``damaged_sheet_rows`` counts such rows); blank rows are
    no rows.  Columns are named by position.  ``sheet`` (default: the file name without its ending; an expression over
    ``file``, the path, and ``source``, the name) names the sheet; excluded sheets are filtered on it.
    """
    cells = F.from_csv("value", ", ".join(f"`{n}` string" for n in names),
                       {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE"})
    both = cells[names[0]].try_cast("int").isNotNull() & cells[names[-1]].try_cast("double").isNotNull()
    lines, splits = numbered_lines(spark, folder, per_split={"data": F.min(F.when(both, F.col("id")))})
    name = F.regexp_replace("source", r"\.[^.]*$", "") if sheet is None else sheet
    rows = lines.withColumn("sheet", name)
    if exclude:
        rows = rows.where(~F.col("sheet").isin(*exclude))
    if title_rows is None:
        begin = splits.groupBy("file").agg(F.min(F.col("data") - F.col("first") + F.col("before")).alias("_begin"))
        rows = rows.join(checked_broadcast(begin), "file").where("at >= _begin")
    elif isinstance(title_rows, int):
        rows = rows.where(F.col("at") > title_rows)
    else:
        above = F.lit(0)
        for s, n in title_rows.items():
            above = F.when(F.col("sheet") == s, n).otherwise(above)
        rows = rows.where(F.col("at") > above)
    parsed = rows.where(F.trim("value") != "").select(cells.alias("_c"), "sheet").select("_c.*", "sheet")
    return parsed.withColumns({names[0]: safe_int(names[0]), names[1]: safe_int(names[1]), names[-1]: safe_double(names[-1])})


def damaged_sheet_rows(sheets: DataFrame, names: Sequence[str] = SHEET_COLUMNS) -> DataFrame:
    """(sheet, rows, damaged) of a sheet set: a row is damaged if its year, its month or its value is no number."""
    bad = F.col(names[0]).isNull() | F.col(names[1]).isNull() | F.col(names[-1]).isNull()
    return sheets.groupBy("sheet").agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("damaged"))


def sheet_rows(raw: DataFrame, names: Sequence[str] = SHEET_COLUMNS) -> DataFrame:
    """The data rows of positional text rows, title and header rows dropped, typed."""
    return (raw.where(safe_int(names[0]).isNotNull() | safe_double(names[-1]).isNotNull())
            .withColumns({names[0]: safe_int(names[0]), names[1]: safe_int(names[1]),
                          names[-1]: safe_double(names[-1])}))


BLANKS = " \t\n\v\f\r"


def read_json_matrix(spark: SparkSession, path: str | Sequence[str], keys: Sequence[str] | None = None) -> DataFrame:
    """Files each holding one JSON array of arrays of plain values, whose first row is the header.

    With ``keys`` returns one row per value row with ``source`` (file name) and one
    text column per key: each key's position is looked up once per file in the
    header (the first of a repeated name wins; a name missing from a file gives
    NULL), so a row costs one lookup per key however wide the header is.
    Without ``keys`` returns ``source`` and ``cells``, a map from each distinct
    header name (first occurrence) to the row's value.  A header-only file gives no
    rows; a row that is no JSON gives NULLs.

    A file is read in splits, cut at every ``]``, so a large one is many tasks' work.  A piece between two cuts is a
    row, unless a text in it holds a ``]``: pieces with an odd number of quotes open or close such a text.  Their counts by split
    (numbers only, one row per split) tell whether a split begins within a text, so every split puts its own rows together in one pass,
    in the order they are read; only the rows that reach over the end of a split are gathered.  A text that is never
    closed tears nothing.
    """
    ensure_checkpoint_dir(spark)
    pieces = split_lines(spark, path, sep="]")
    splits = _matrix_splits(pieces.withColumn("torn", _odd_quotes("value"))).checkpoint()
    small = fits_broadcast(splits)
    placed = pieces.join(F.broadcast(splits) if small else splits, ["file", "start"])
    lone = F.col("id").eqNullSafe(F.col("lone")).alias("lone")
    top = (F.col("start") == 0) & (F.col("id") == F.col("first"))
    left = F.col("inside") & (F.col("first_torn").isNull() | (F.col("id") <= F.col("first_torn")))
    right = F.col("ends_inside") & (F.col("id") >= F.col("last_torn"))
    row = F.when(left, F.col("before") - 1).when(right, F.col("before") + F.col("n_torn") - 1)     # the torn piece that opens it
    edges = placed.where(top | left | right).select("file_no", "source", "start", "id", "value", (_odd_quotes("value") & ~lone).alias("torn"), top.alias("top"), row.alias("row")).checkpoint()
    first = edges.where("top").select("file_no", "source", "value", "torn")
    heads = first.where("NOT torn").select("file_no", "value")
    rows = placed.select("file_no", top.alias("top"), "value")
    if splits.agg(F.sum("n_torn")).first()[0]:
        mended = (edges.where("row IS NOT NULL").groupBy("file_no", "row")
                  .agg(F.max("top").alias("top"), F.sort_array(F.collect_list(F.struct("start", "id", "value"))).alias("p"))
                  .select("file_no", "top", F.array_join("p.value", "]").alias("value")))
        ordered = placed if small else placed.repartition("file", "start").sortWithinPartitions("file", "start", "id")
        own = ordered.select("first", "file_no", "inside", lone, "value")
        rows = own.mapInArrow(_whole_rows, "file_no long, top boolean, value string").union(mended)
        if first.where("torn").limit(1).count():
            begun = own.where("first = file_no").mapInArrow(_whole_rows, "file_no long, top boolean, value string").union(mended).where("top").select("file_no", "value")
            heads = heads.union(begun.join(checked_broadcast(first.where("torn").select("file_no")), "file_no"))
    bare = F.ltrim("value", F.lit(BLANKS + ",\ufeff"))
    cells = F.from_json(F.concat(F.lit("["), F.ltrim(bare, F.lit(BLANKS + "[")), F.lit("]")), "array<string>")
    body = rows.where(~F.col("top") & bare.startswith("[")).select("file_no", cells.alias("row"))
    header = heads.select("file_no", cells.alias("header")).join(first.select("file_no", "source"), "file_no")
    if keys:
        places = [F.array_position("header", k).cast("int").alias(f"_p{i}") for i, k in enumerate(keys)]
        found = body.join(checked_broadcast(header.select("file_no", "source", *places).checkpoint()), "file_no")
        return found.select("source", *[F.when(F.col(f"_p{i}") > 0, F.try_element_at("row", F.col(f"_p{i}"))).alias(k) for i, k in enumerate(keys)])
    return body.join(checked_broadcast(header.checkpoint()), "file_no").select("source", _cells().alias("cells"))


def _odd_quotes(col: str) -> Column:
    """Whether a text holds an odd number of quotes that no backslash escapes."""
    bare = F.replace(col, F.lit("\\\\"))                            # without escaped backslashes
    escaped = F.shiftright(F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit('\\"'))), 1)
    return (F.octet_length(col) - F.octet_length(F.replace(col, F.lit('"'))) + F.when(F.contains(col, F.lit("\\")), escaped).otherwise(0)) % 2 == 1


def _matrix_splits(pieces: DataFrame) -> DataFrame:
    """One row per split of matrix files, from its pieces (file, start, id, torn).

    first (its first piece), file_no (that of the file), before and n_torn (torn pieces of the file before the split, and in it),
    first_torn, last_torn, inside and ends_inside (whether it begins and ends within a row), lone (the file's last torn piece, if none closes it: counted nowhere).
    """
    torn_id = F.when(F.col("torn"), F.col("id"))
    counted = pieces.groupBy("file", "start").agg(F.min("id").alias("first"), F.count_if("torn").alias("n_torn"),
                                                  F.min(torn_id).alias("first_torn"), F.max(torn_id).alias("last_torn"))
    whole = Window.partitionBy("file")
    ahead = whole.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before, every = F.coalesce(F.sum("n_torn").over(ahead), F.lit(0)), F.sum("n_torn").over(whole)
    paired = every - every % 2
    lone = F.when((F.col("n_torn") > 0) & (F.col("before") + F.col("n_torn") > F.col("paired")), F.col("last_torn"))
    n_torn = F.col("n_torn") - F.col("lone").isNotNull().cast("long")
    return (counted.withColumns({"before": F.least(before, paired), "paired": paired, "file_no": F.min_by("first", "start").over(whole)})
            .withColumn("lone", lone)
            .select("file", "start", "first", "file_no", "before", n_torn.alias("n_torn"), F.nullif("first_torn", "lone").alias("first_torn"), "last_torn",
                    (F.col("before") % 2 == 1).alias("inside"), ((F.col("before") + n_torn) % 2 == 1).alias("ends_inside"), "lone"))


def _whole_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces, in the order of their splits, to the rows that lie whole in a split: file_no, top (a file's first), value."""
    split, held, inside, top = None, [], False, False        # held: the pieces so far of a row that goes on
    for batch in batches:
        first, file_no, within, lone = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("first", "file_no", "inside", "lone"))
        marks = pc.replace_substring(pc.replace_substring(batch.column("value"), "\\\\", ""), '\\"', "")       # without escaped backslashes, then escaped quotes
        torn = (pc.count_substring(marks, '"').to_numpy(zero_copy_only=False) % 2 == 1) & ~lone
        bounds = [0, *(np.flatnonzero(first[1:] != first[:-1]) + 1), len(first)] if len(first) else []
        for a, b in zip(bounds, bounds[1:]):
            if first[a] != split:
                split, held, inside, top = first[a], [], within[a], first[a] == file_no[a]
            values = batch.column("value").slice(a, b - a)
            ends = np.flatnonzero((np.cumsum(torn[a:b]) + bool(held or inside)) % 2 == 0) + 1
            if not len(ends):
                if not inside:                               # what began in an earlier split is gathered elsewhere
                    held.append(values)
                continue
            offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
            rows = pc.binary_join(pa.ListArray.from_arrays(offsets, values), pa.scalar("]", values.type))
            if held:
                begun = "]".join([x for h in held for x in h.to_pylist()] + [rows[0].as_py()])
                rows = pa.concat_arrays([pa.array([begun], rows.type), rows.slice(1)])
            rows = rows.slice(int(inside))
            tops = np.zeros(len(rows), bool)
            tops[:1] = top
            held, inside, top = [values.slice(ends[-1])] if ends[-1] < b - a else [], False, False
            if len(rows):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), file_no[a])), pa.array(tops), rows], ["file_no", "top", "value"])


def _cells() -> Column:
    """Map of a row's values by the names in ``header``, the first of a repeated name."""
    return F.map_from_entries(F.transform(
        F.array_distinct("header"),
        lambda h: F.struct(h.alias("key"), F.try_element_at(F.col("row"), F.array_position("header", h).cast("int")).alias("value"))))


def matrix_rows(files: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """``read_json_matrix`` for whole matrices in a text column: (source, value)."""
    files = files.select("source", F.from_json("value", "array<array<string>>").alias("m"))
    body = F.explode(F.slice("m", 2, F.greatest(F.size("m") - 1, F.lit(0)))).alias("row")
    if keys:
        header = F.col("m")[0]
        positions = [F.array_position(header, k).cast("int").alias(f"_p{i}") for i, k in enumerate(keys)]
        rows = files.select("source", *positions, body)
        row = F.col("row")
        return rows.select("source", *[F.when(F.col(f"_p{i}") > 0, F.try_element_at(row, F.col(f"_p{i}")))
                                       .alias(k) for i, k in enumerate(keys)])
    rows = files.select("source", F.col("m")[0].alias("header"), body)
    return rows.select("source", _cells().alias("cells"))


def landed_years(spark: SparkSession, path: str, pattern: str = "[0-9]{4}") -> DataFrame:
    """Column ``year``: the years in the names of the files at ``path``, whatever the files hold.

    Spark lists the files; their content is not read.
    """
    name = F.element_at(F.split("path", "/"), -1)
    return (spark.read.format("binaryFile").load(path)
            .select(F.regexp_extract(name, f"({pattern})", 1).alias("_y")).where("_y != ''")
            .select(F.col("_y").cast("int").alias("year")).distinct())


def contiguous_year_prefix(df: DataFrame, year_col: str, start: int, years: DataFrame | None = None) -> DataFrame:
    """Rows whose year belongs to the unbroken run start, start+1, ... of the years landed.

    ``years`` (its first column) names the years that landed, e.g. ``landed_years``: a file without
    rows still counts.  Without it, the years are those of the rows.
    A later year after a gap is excluded (2010, 2011, 2013 keeps 2010 and 2011).
    Every different year marks itself as present and its successor (and ``start``)
    as a candidate; the first missing year is the smallest candidate never
    marked present.  That is one aggregation over the different years, evaluated once as a
    scalar subquery, and no row is moved to a single task.
    """
    y = F.col(year_col)
    ytype = df.schema[year_col].dataType
    landed = (years.select(F.col(years.columns[0]).cast(ytype).alias(year_col)) if years is not None
              else df.select(year_col)).distinct()
    pair = F.array(F.struct(y.alias("v"), F.lit(1).alias("present")),
                   F.struct((y + 1).cast(ytype).alias("v"), F.lit(0).alias("present")))
    marks = landed.where(y >= start).select(F.explode(pair).alias("m")).select("m.*")
    first = df.sparkSession.range(1).select(F.lit(start).cast(ytype).alias("v"), F.lit(0).alias("present"))
    marks = marks.unionByName(first)
    first_gap = (marks.groupBy("v").agg(F.max("present").alias("p")).where(F.col("p") == 0)
                 .agg(F.min("v")).scalar())
    return df.where((y >= start) & (y < first_gap))


def tag_source(df: DataFrame, name: str = "source") -> DataFrame:
    """Add the source file name of each row (stacking many files with an id)."""
    return df.withColumn(name, F.col("_metadata.file_name"))
