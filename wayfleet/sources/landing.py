"""Readers for the landing area.

Three ways to read JSON, by the shape of the files:

* ``json_lines``      one record per line, large files, splittable: use it for bulk;
* ``json_documents``  one object or one array per file, Spark's multi-line reader;
* ``landing_text`` + ``parse_landing``  documents or lines, as the source declares, keeping the
  raw text so that rejected input can be quarantined as it came.

Files starting with ``_`` or ``.`` are skipped by Spark itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wayfleet.operators.upsert import by_name

# Extension -> reader. Anything else in the folder is ignored.
EXTENSIONS = ("json", "parquet", "csv")


def json_documents(spark: SparkSession, path: str | list[str], schema: T.StructType, glob: str = "*.json") -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", glob).json(path)


def json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType, glob: str = "*.json") -> DataFrame:
    return spark.read.schema(schema).option("pathGlobFilter", glob).json(path)


def parse_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, glob: str = "*.csv") -> DataFrame:
    """Flat rows with a header line -> typed columns, plus ``raw``, ``file_path`` and ``reject_reason``.

    Columns are found by the names in the header, without regard to case, whatever their order; one that is
    absent is NULL. A row with too many or too few fields, or a value that does not have its column's type,
    is marked and keeps its text. All files of a path share one header; reading fails if one differs. Values may hold line ends, which
    ``parse_csv_lines`` cannot read; that one takes every file by its own header.
    """
    reader = spark.read.option("header", True).option("pathGlobFilter", glob)
    header = reader.csv(path).columns
    texts = T.StructType([T.StructField(c, T.StringType()) for c in (*header, "_raw")])
    rows = reader.schema(texts).options(enforceSchema=False, columnNameOfCorruptRecord="_raw", mode="PERMISSIVE").csv(path)
    by_lower = {c.lower(): c for c in header}
    bad = F.lit(False)
    columns = []
    for f in schema.fields:
        found = by_lower.get(f.name.lower())
        value = F.lit(None).cast(f.dataType) if found is None else F.col(f"`{found}`").try_cast(f.dataType)
        columns.append(value.alias(f.name))
        if found is not None:
            bad = bad | (F.col(f"`{found}`").isNotNull() & value.isNull())
    reason = F.when(F.col("_raw").isNotNull(), "malformed_row").when(bad, "bad_value")
    text = F.coalesce("_raw", F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in header]))
    return rows.select(*columns, text.alias("raw"), F.col("_metadata.file_path").alias("file_path"), reason.alias("reject_reason"))


def csv_rows(spark: SparkSession, path: str | list[str], schema: T.StructType, glob: str = "*.csv") -> DataFrame:
    """The usable rows of ``parse_csv_lines``: every file under its own header. What it refuses is ``rejected`` of the same call."""
    lines = landing_text(spark, path, glob, shape=LINES)
    return accepted(parse_csv_lines(lines, schema)).drop("file_path", "file_size", "file_time")


def parquet_rows(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
                 merge_schema: bool = False, glob: str = "*.parquet") -> DataFrame:
    """``merge_schema`` adds columns that only newer files have; none is ever dropped."""
    reader = spark.read.option("mergeSchema", merge_schema).option("pathGlobFilter", glob)
    return (reader.schema(schema) if schema else reader).parquet(path)


def by_extension(spark: SparkSession, path: str, schema: T.StructType,
                 extensions: Sequence[str] = EXTENSIONS) -> DataFrame:
    """Everything readable in one folder, the reader chosen by file extension. CSV cannot hold a nested schema: then it must not be asked for."""
    unknown = set(extensions) - set(EXTENSIONS)
    if unknown:
        raise ValueError(f"unsupported file type: {sorted(unknown)}; supported: {list(EXTENSIONS)}")
    readers = {"json": json_documents, "csv": csv_rows, "parquet": parquet_rows}
    nested = [f.name for f in schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    if nested and "csv" in extensions:
        raise ValueError(f"CSV cannot hold {nested}; leave the extension out")
    return by_name(*(readers[e](spark, path, schema) for e in extensions))


def decoded_path(path: Column) -> Column:
    """A file URI with its %xx escapes (and ``+``) undone."""
    return F.coalesce(F.try_url_decode(path), path)


def bucket_of(path: Column) -> Column:
    """The authority part of ``scheme://bucket/key``; NULL for local files."""
    return F.nullif(F.regexp_extract(path, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/]+)/", 1), F.lit(""))


# How the text of a landing folder is cut into records; a source declares it, nothing is guessed from a file's beginning.
DOCUMENTS, LINES = "documents", "lines"


def landing_text(spark: SparkSession, path: str, glob: str = "*.json", streaming: bool = False, shape: str = DOCUMENTS,
                 **options) -> DataFrame:
    """Raw text plus where it came from: one row per file of ``DOCUMENTS`` (an object or an array each, event-sized),
    or one row per line that is not blank of ``LINES``, which are read in splits however large a file is."""
    if shape not in (DOCUMENTS, LINES):
        raise ValueError(f"unknown shape: {shape}")
    reader = spark.readStream if streaming else spark.read
    frame = (
        reader.format("text").option("wholetext", shape == DOCUMENTS).option("pathGlobFilter", glob).options(**options).load(path)
    )
    if shape == LINES:
        frame = frame.filter(F.trim("value") != "")
    return frame.select(
        F.col("value").alias("raw"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_block_start").alias("file_begin"),
    )


def is_one_value(raw: Column) -> Column:
    """Whether a text is exactly one JSON value; parsers stop after the first and would ignore what follows.

    Something that closes one bracket too early cannot fit both an array and an object put around it.
    """
    in_array = F.from_json(F.concat(F.lit("["), raw, F.lit("]")), T.ArrayType(T.StringType()))
    in_object = F.try_parse_json(F.concat(F.lit('{"x":'), raw, F.lit("}")))
    return F.coalesce((F.size(in_array) == 1) & in_object.isNotNull(), F.lit(False))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _closer_look(text: Column, whole: Column, schema: T.StructType, piece) -> Column:
    """The pieces of a text that is not plainly one record: elements of an array, lines, or the text as it is."""
    def parsed(t: Column, one: Column) -> Column:
        return piece(t, one, F.from_json(F.when(one, t), schema))

    lines = F.filter(F.split(text, r"\r?\n"), lambda line: F.trim(line) != "")
    # The only line of a text that is not one value is no record.
    some_record = F.contains(text, F.lit("\n")) & F.exists(lines, lambda line: F.ltrim(line).startswith("{") & is_one_value(line))
    elements = F.from_json(text, T.ArrayType(T.StringType()))
    return (
        F.when(whole & F.ltrim(text).startswith("["), F.transform(elements, lambda t: parsed(t, F.lit(True))))
        .when(~whole & some_record, F.transform(lines, lambda t: _let(is_one_value(t), lambda one: parsed(t, one))))
        .otherwise(F.array(parsed(text, whole)))
    )


def parse_landing(raw: DataFrame, schema: T.StructType, required: Sequence[str] = ("event_id", "carChassis")) -> DataFrame:
    """Raw texts -> records, with ``reject_reason`` set on what cannot be used.

    A text is one object, one array of records, or lines of them. What is exactly one JSON value is read as such. Any
    other text is cut into its lines if one of them at least is a record by itself, and each line
    stands for itself; else it is kept whole. Text that is no JSON, JSON with more text after it, and records that
    lack a required key (a foreign layout, say) are marked; none disturbs the other records or files of the
    batch, and every piece of text ends up on one side.

    A text that is plainly one record is parsed once: as the only element of an array put around it. Only what is not is looked at more closely.
    """
    text = F.col("raw")
    piece = lambda t, whole, record: F.struct(t.alias("raw"), whole.alias("_one"), record.alias("_record"))
    # Without a closing bracket of its own a text cannot end the array early, so one element means one value.
    around = F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(schema))
    closer = _let(is_one_value(text), lambda whole: _closer_look(text, whole, schema, piece))
    records = _let(around, lambda found: F.when(
        (F.size(found) == 1) & F.get(found, F.lit(0)).isNotNull() & ~F.contains(text, F.lit("]")), F.array(piece(text, F.lit(True), F.get(found, F.lit(0))))).otherwise(closer))
    # Parsed before the explode: a filter on the result then stays above it, instead of
    # being pushed down with a copy of the parser for every column it mentions.
    parsed = raw.select(F.inline_outer(records), "file_path", "file_size", "file_time")

    names = [f.name for f in schema.fields]
    by_lower = {n.lower(): n for n in names}
    no_fields = F.lit(True)
    for name in names:
        no_fields = no_fields & F.col(f"_record.`{name}`").isNull()
    is_json = F.try_parse_json("raw").isNotNull()
    reason = (
        F.when(F.col("raw").isNull(), F.lit("no_records"))
        .when(no_fields & ~is_json, F.lit("not_json"))
        .when(~F.col("_one"), F.lit("trailing_content"))
        .when(no_fields, F.lit("foreign_layout"))
    )
    for name in (by_lower[r.lower()] for r in required):
        reason = reason.when(F.col(f"_record.`{name}`").isNull(), F.lit(f"missing_{name}"))
    return parsed.withColumn("reject_reason", reason).select(
        "_record.*", "raw", "file_path", "file_size", "file_time", "reject_reason")


# A cell of a CSV line with its quotes, after a comma; one is put before the line.
_CELL = r',("[^"]*+(?:""[^"]*+)*+"|[^,]*+)'


def _cells(line: Column) -> Column:
    return F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), 1)


def _unquoted(cell: Column) -> Column:
    """The value of a cell: nothing at all is NULL, quotes around nothing an empty text."""
    inner = F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
    return F.when(cell == "", None).when(cell.startswith('"'), inner).otherwise(cell)


def parse_csv_lines(lines: DataFrame, schema: T.StructType, required: Sequence[str] = ()) -> DataFrame:
    """Lines of CSV files -> typed columns, ``raw`` and ``reject_reason``, in the shape of ``parse_landing``.

    ``lines`` is a batch of ``landing_text`` in the shape LINES with ``file_begin``. Each file has its own header, its first line,
    and columns are found by their names in it, in whatever order and case; one that is absent is NULL. A line of
    another width, with a stray quote, or with a value of another type is marked and keeps its text. A file whose header lacks a required
    column is of a foreign layout, line by line. A value cannot contain a line end.
    """
    numbered = lines.withColumn("_line", F.monotonically_increasing_id())
    # Lines of a file's first split come in order, so the least number there is the header's.
    first = numbered.filter("file_begin = 0").groupBy("file_path").agg(F.min(F.struct("_line", "raw")).alias("_first"))
    names = F.transform(_cells(F.ltrim(F.translate("_first.raw", "\ufeff\r", ""))), lambda c: F.lower(F.trim(_unquoted(c))))
    headers = first.select(F.col("file_path").alias("_file"), F.col("_first._line").alias("_header"), names.alias("_names"))
    rows = numbered.join(headers, F.col("file_path") == F.col("_file"), "left").filter("_line <> _header OR _header IS NULL")
    line = F.rtrim(F.col("raw"), F.lit("\r"))
    # Taken apart by a generator: a filter on what follows stays above it, instead of being pushed down with a copy of the
    # pattern for every place that mentions a cell.
    rows = rows.select("*", F.explode(F.array(_cells(line))).alias("_cells"))
    at = {f.name: F.array_position("_names", f.name.lower()).cast("int") for f in schema.fields}
    text = {n: F.when(at[n] > 0, _unquoted(F.get("_cells", at[n] - 1))) for n in at}
    columns = {f.name: text[f.name].try_cast(f.dataType) for f in schema.fields}
    stray = F.exists("_cells", lambda c: c.startswith('"') & ~((F.length(c) > 1) & c.endswith('"')))
    whole = F.aggregate("_cells", F.size("_cells") - 1, lambda n, c: n + F.length(c)) == F.length(line)
    bad, foreign = F.lit(False), F.col("_names").isNull()
    for name, value in columns.items():
        bad = bad | (text[name].isNotNull() & value.isNull())
    for name in required:
        foreign = foreign | ~F.array_contains("_names", name.lower())
    reason = (
        F.when(F.coalesce(foreign, F.lit(True)), "foreign_layout").when(stray | ~whole, "malformed_row")
        .when(F.size("_cells") != F.size("_names"), "wrong_width").when(bad, "bad_value")
    )
    for name in required:
        reason = reason.when(columns[name].isNull(), f"missing_{name}")
    return rows.select(*[c.alias(n) for n, c in columns.items()], "raw", "file_path", "file_size", "file_time", reason.alias("reject_reason"))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter("reject_reason IS NULL").drop("reject_reason", "raw")


def rejected(parsed: DataFrame) -> DataFrame:
    """Quarantine rows: the reason, the file and the untouched text of the record."""
    return parsed.filter("reject_reason IS NOT NULL").select(
        "reject_reason", decoded_path(F.col("file_path")).alias("source_file"), "raw"
    )
