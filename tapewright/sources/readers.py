"""Readers of delimited, fixed-width, JSON and XML files into text columns, one scan each."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tapewright.functions.fields import Field, apply_fields


def load_dataset(spark: SparkSession, path: str, schema: T.StructType | str | None = None, columns: Sequence[str] | None = None, where: Column | None = None) -> DataFrame:
    """A parquet dataset; columns and filter reach the scan."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


FILES_BROADCAST = 100_000  # a row a file is broadcast up to so many files


def _numbered(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Lines with their file, the place of their block in it and an order inside the block (``value``, ``file``, ``block``, ``at``)."""
    reader = spark.read if encoding.lower().replace("_", "-") in ("utf-8", "utf8") else spark.read.option("encoding", encoding)
    meta = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return reader.text(path).select("value", *meta, F.monotonically_increasing_id().alias("at"))


def _by_file(rows: DataFrame, of_files: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with what is known of their file: a row a file, broadcast while the files are few enough."""
    few = len(rows.inputFiles()) <= FILES_BROADCAST
    return rows.join(F.broadcast(of_files) if few else of_files, "file", how)


def _with_start(lines: DataFrame) -> DataFrame:
    """Adds ``first``, the order of the file's first line: the least one of the block that starts the file."""
    starts = lines.where("block = 0").groupBy("file").agg(F.min("at").alias("first"))
    return _by_file(lines, starts)


def _after_first(lines: DataFrame, skip: int, skip_if_startswith: str | None = None) -> DataFrame:
    """Without the first lines of each file, and without the next one if it starts so."""
    if not skip and not skip_if_startswith:
        return lines
    place = F.col("at") - F.col("first")
    gone = place.between(0, skip - 1)
    if skip_if_startswith:
        gone = gone | ((place == skip) & F.col("value").startswith(skip_if_startswith))
    return _with_start(lines).where(~gone).drop("first")


HEADERS = 10_000  # different header lines that a folder may have


def read_csv(
    spark: SparkSession,
    path: str,
    separator: str = ",",
    skip: int = 0,
    skip_if_startswith: str | None = None,
    names: Sequence[str] | None = None,
    encoding: str = "utf-8",
) -> DataFrame:
    """Text columns of delimited files; without ``names`` every file's first line has its own.

    ``skip`` lines of each file go; ``skip_if_startswith`` drops the next one if it starts so. Files may differ in the order and
    choice of their columns: rows follow their own file's header, and a column that a file lacks is null in its rows. The
    columns come in the order of the headers, the most frequent one first. Files without a line have no rows.
    """
    options = {"sep": separator, "encoding": encoding, "mode": "PERMISSIVE"}
    if names:
        schema = ", ".join(f"{_quoted(n)} string" for n in names)
        if not skip and not skip_if_startswith:
            return spark.read.options(**options, header="false").schema(schema).csv(path)
        lines = _after_first(_numbered(spark, path, encoding), skip, skip_if_startswith)
        return lines.select(F.from_csv("value", schema, {"sep": separator}).alias("row")).select("row.*")
    lines = _numbered(spark, path, encoding)
    heads = _headers(lines, skip, skip_if_startswith)
    found = heads.groupBy("header").count().orderBy(F.desc("count"), "header").limit(HEADERS + 1).collect()
    if len(found) > HEADERS:
        raise ValueError(f"more than {HEADERS} different headers; give names")
    if not found:
        return spark.createDataFrame([], "value string").select()
    if len(found) == 1 and not skip and not skip_if_startswith:
        return spark.read.options(**options, header="true").csv(path)  # one layout: columns are pruned in the scan
    of_header = {r["header"]: _header_names(r["header"], separator) for r in found}
    columns = list(dict.fromkeys(c for own in of_header.values() for c in own))
    places = [(header, [own.index(c) if c in own else None for c in columns]) for header, own in of_header.items()]
    layouts = spark.createDataFrame(places, "header string, places array<int>")
    widest = max(map(len, of_header.values()))
    cells = ", ".join(f"c{k} string" for k in range(widest))
    heads = heads.join(F.broadcast(layouts), "header").select("file", "place", "places")
    body = _by_file(_with_start(lines), heads)
    body = body.where(~(F.col("at") - F.col("first")).between(F.lit(0), F.col("place")) & (F.trim("value") != ""))
    row = F.from_csv("value", cells, {"sep": separator})
    read = body.select("places", row.alias("row")).select("places", F.array(*[F.col(f"row.c{k}") for k in range(widest)]).alias("cells"))
    return read.select(*[F.get("cells", F.get("places", k)).alias(c) for k, c in enumerate(columns)])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _headers(lines: DataFrame, skip: int, skip_if_startswith: str | None) -> DataFrame:
    """(file, header, place): each file's header line and how many lines are before it."""
    near = _with_start(lines.where("block = 0")).withColumn("place", F.col("at") - F.col("first"))
    near = near.where(F.col("place").between(skip, skip + 1)).select("file", "place", "value")
    if skip_if_startswith:
        near = near.where((F.col("place") > skip) | ~F.col("value").startswith(skip_if_startswith))
    first = near.groupBy("file").agg(F.min(F.struct("place", "value")).alias("line"))
    return first.select("file", F.regexp_replace("line.value", "^\ufeff", "").alias("header"), "line.place")


def _header_names(header: str, separator: str) -> list[str]:
    """The names in a header line; empty ones by their place, repeated ones with their place behind them."""
    cells = [c.strip() for c in next(csv.reader([header], delimiter=separator), [])]
    return [f"_c{k}" if not c else f"{c}{k}" if cells.count(c) > 1 else c for k, c in enumerate(cells)]


def _sliced(fields: Sequence[Field], text: str = "value") -> list[Column]:
    at, columns = 1, []
    for f in fields:
        columns.append(F.trim(F.substring(text, at, f.width)).alias(f.name))
        at += f.width
    return columns


def read_fwf(spark: SparkSession, path: str, fields: Sequence[Field], skip: int = 0, encoding: str = "utf-8") -> DataFrame:
    lines = _after_first(_numbered(spark, path, encoding), skip)
    return apply_fields(lines.select(*_sliced(fields)), fields)


def parse_fwf(df: DataFrame, column: str, fields: Sequence[Field]) -> DataFrame:
    """Fixed-width text that is already a column."""
    return apply_fields(df.select(*_sliced(fields, column)), fields)


def read_fwf_multi(
    spark: SparkSession,
    path: str,
    datasets: Mapping[str, Sequence[Field]],
    header_code: str = "00",
    refdate_start: int = 31,
    refdate_width: int = 8,
    encoding: str = "latin1",
    coded: bool = False,
) -> dict[str, DataFrame]:
    """A file of several record types: two letters name the dataset (``datasets``: code -> fields after the code, or with
    ``coded`` from the code on).

    Each file's header record dates all of its rows. ``fwf_multi_rows`` has the rows of all datasets in one scan.
    """
    met = _dated(spark, path, header_code, refdate_start, refdate_width, encoding)
    out = {}
    for code, fields in datasets.items():
        rows = met.where(F.col("value").startswith(code)).withColumn("value", F.substring("value", 1 if coded else 3, 1 << 20))
        out[code] = apply_fields(rows.select("refdate", *_sliced(fields)), fields)
    return out


def _dated(spark: SparkSession, path: str, header_code: str, refdate_start: int, refdate_width: int, encoding: str) -> DataFrame:
    lines = _numbered(spark, path, encoding)
    heads = lines.where(F.col("value").startswith(header_code))
    date = F.try_to_timestamp(F.substring("value", refdate_start, refdate_width), F.lit("yyyyMMdd")).cast("date")
    return _by_file(lines, heads.groupBy("file").agg(F.min(date).alias("refdate")), "left")


def fwf_multi_rows(
    spark: SparkSession,
    path: str,
    datasets: Mapping[str, Sequence[Field]],
    header_code: str = "00",
    refdate_start: int = 31,
    refdate_width: int = 8,
    encoding: str = "latin1",
    coded: bool = False,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """As ``read_fwf_multi``, the rows of all record types from one scan of the lines, for ``sinks.write_outputs``; ``names`` by code."""
    met = _dated(spark, path, header_code, refdate_start, refdate_width, encoding)
    code = F.substring("value", 1, 2)
    output = F.coalesce(*[F.when(code == c, F.lit((names or {}).get(c, c))) for c in datasets])
    outputs = {}
    for c, fields in datasets.items():
        cells, at = {"refdate": F.col("refdate")}, 1 if coded else 3
        for f in fields:
            cells[f.name] = f.typed(F.substring("value", at, f.width))
            at += f.width
        outputs[(names or {}).get(c, c)] = cells
    return tagged(met, output, outputs)


def at_path(column: Column, path: str) -> Column:
    """A value inside structs and arrays: names and list places, with dots between."""
    for step in path.split("."):
        column = F.get(column, int(step)) if step.isdigit() else column[step]
    return column


def read_json(
    spark: SparkSession, path: str, json_path: str | None = None, constants: Mapping[str, str] | None = None, schema: Any = None
) -> DataFrame:
    """Whole-file JSON: one row per element of the array at ``json_path``; constants come from the same file."""
    reader = spark.read.option("multiLine", True)
    df = (reader.schema(schema) if schema is not None else reader).json(path)
    if not json_path:
        return df
    whole = df.select(F.struct("*").alias("d"))
    known = [at_path(F.col("d"), p).alias(name) for name, p in (constants or {}).items()]
    return whole.select(*known, F.inline(at_path(F.col("d"), json_path)))


def read_json_tables(
    spark: SparkSession, path: str | DataFrame, root: str, layouts: Mapping[str, Sequence[Field]], arrays: Mapping[str, str], keys: Mapping[str, Column] | None = None
) -> dict[str, DataFrame]:
    """Whole-file JSON of a row (table ``root``) that holds arrays of rows (table -> name of the array), each typed by its layout.

    The schema is that of the layouts. ``keys`` (name -> column over ``file``, the path) go before the columns of every table. An
    array that a document lacks gives no rows. Where a folder would have very many small files, they come packed: a frame of
    ``file``, the path, and ``value``, the whole text.
    """
    schema = T.StructType([T.StructField(f.name, T.StringType()) for f in layouts[root]])
    for table, array in arrays.items():
        schema.add(array, T.ArrayType(T.StructType([T.StructField(f.name, T.StringType()) for f in layouts[table]])))
    if isinstance(path, DataFrame):
        docs = path.select("file", F.inline(F.from_json("value", T.ArrayType(schema))))  # a single document is an array of one
    else:
        docs = spark.read.option("multiLine", True).schema(schema).json(path).select("*", F.col("_metadata.file_path").alias("file"))
    known = [c.alias(n) for n, c in (keys or {}).items()]
    out = {root: apply_fields(docs.select(*known, *[f.name for f in layouts[root]]), layouts[root])}
    for table, array in arrays.items():
        out[table] = apply_fields(docs.select(*known, F.inline(array)), layouts[table])
    return out


def json_nested_split(df: DataFrame, root_fields: Sequence[str], nested: Sequence[str], keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The root table without its arrays and one table per array, its rows with the root's keys."""
    out = {"root": df.select(*root_fields)}
    for name in nested:
        out[name] = df.select(*keys, F.inline(name))
    return out


def json_explode_codes(df: DataFrame, column: str) -> DataFrame:
    """A row per element of an array of structs; one with nulls where there is none."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.inline_outer(column))


def read_xml(spark: SparkSession, path: str, row_tag: str, fields: Sequence[Field], schema: Any = None) -> DataFrame:
    """Rows of one element; each field by its path of child elements (``tag``), trimmed."""
    df = xml_rows(spark, path, row_tag, schema)
    return apply_fields(df.select(*[_xml_value(df, f).alias(f.name) for f in fields]), fields)


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema: Any = None, with_file: bool = False) -> DataFrame:
    """One row per element of that name; ``with_file`` adds the file it is in."""
    reader = spark.read.format("xml").option("rowTag", row_tag).option("inferSchema", "false").option("ignoreNamespace", "true")
    reader = reader.option("mode", "DROPMALFORMED")
    found = (reader.schema(schema) if schema is not None else reader).load(path)
    return found.select("*", F.col("_metadata.file_path").alias("file")) if with_file else found


def _message_values(spark: SparkSession, path: str, tag: str, child: str, name: str) -> DataFrame:
    """(file, value) of a child of the element that each message has once."""
    rows = xml_rows(spark, path, tag, f"`{child}` string", with_file=True)
    return rows.groupBy("file").agg(F.max(F.trim(child)).alias(name))


def read_xml_indexes(
    spark: SparkSession,
    path: str,
    datasets: Mapping[str, Sequence[Field]],
    schemas: Mapping[str, Any] | None = None,
    date_tag: str = "TradDt",
    date_child: str = "Dt",
) -> dict[str, DataFrame]:
    """Tables of index messages by their element (``datasets``: element -> fields); every row has its own message's date
    as refdate. A message without a date is an error when its rows are read."""
    dates = _message_values(spark, path, date_tag, date_child, "__date")
    out = {}
    for tag, fields in datasets.items():
        df = xml_rows(spark, path, tag, (schemas or {}).get(tag, xml_schema([fields])), with_file=True)
        met = _by_file(df, dates, "left")
        missing = F.raise_error(F.concat(F.lit(f"{date_tag} not found in "), "file"))
        date = F.coalesce(F.to_date("__date"), missing.cast("date"))
        out[tag] = apply_fields(met.select(date.alias("refdate"), *[_xml_value(df, f).alias(f.name) for f in fields]), fields)
    return out


def _xml_value(df: DataFrame, f: Field) -> Column:
    kind, column = df.schema, None
    for step in (f.tag or f.name).split("/"):
        if not isinstance(kind, T.StructType) or step not in kind.names:
            return F.lit(None).cast("string")
        kind = kind[step].dataType
        column = F.col(f"`{step}`") if column is None else column[step]
    if isinstance(kind, T.StructType):  # an element with attributes keeps its text here
        column = column["_VALUE"] if "_VALUE" in kind.names else F.to_json(column)
    return F.trim(column.cast("string"))


def xml_schema(layouts: Sequence[Sequence[Field]]) -> T.StructType:
    """One nested schema of text that has every element path (``tag``) of the layouts: their prefix tree."""
    tree: dict[str, Any] = {}
    for fields in layouts:
        for f in fields:
            node = tree
            for step in (f.tag or f.name).split("/"):
                node = node.setdefault(step, {})

    def struct(node: dict[str, Any]) -> T.StructType:
        return T.StructType([T.StructField(name, struct(below) if below else T.StringType()) for name, below in node.items()])

    return struct(tree)


def _instruments(
    spark: SparkSession, path: str, datasets: Mapping[str, Sequence[Field]], row_tag: str, info: str, schema: Any, header_tag: str | None, created: str
) -> tuple[DataFrame, list[str]]:
    df = xml_rows(spark, path, row_tag, schema if schema is not None else xml_schema(list(datasets.values())), with_file=header_tag is not None)
    if not header_tag:
        return df, []
    return _by_file(df, _message_values(spark, path, header_tag, created, "creation_date"), "left"), ["creation_date"]


def read_xml_instruments(
    spark: SparkSession, path: str, datasets: Mapping[str, Sequence[Field]], row_tag: str = "Instrm", info: str = "InstrmInf",
    schema: Any = None, header_tag: str | None = None, created: str = "CreDtAndTm",
) -> dict[str, DataFrame]:
    """Frames by the child of ``info``: an instrument belongs to the dataset of the child that it has.

    The schema is that of the layouts' element paths, so that nothing is inferred. With ``header_tag`` (the element of a
    message that holds its creation time) every row has that as creation_date. ``xml_instrument_rows`` has all of them in one scan.
    """
    df, more = _instruments(spark, path, datasets, row_tag, info, schema, header_tag, created)
    known = df.schema[info].dataType.names if info in df.columns else []
    out = {}
    for tag, fields in datasets.items():
        rows = df.where(F.col(info)[tag].isNotNull()) if tag in known else df.limit(0)
        out[tag] = apply_fields(rows.select(*more, *[_xml_value(df, f).alias(f.name) for f in fields]), fields)
    return out


def xml_instrument_rows(
    spark: SparkSession, path: str, datasets: Mapping[str, Sequence[Field]], row_tag: str = "Instrm", info: str = "InstrmInf",
    schema: Any = None, header_tag: str | None = None, created: str = "CreDtAndTm", names: Mapping[str, str] | None = None,
) -> DataFrame:
    """The rows of all datasets from one scan, for ``sinks.write_outputs``: ``output`` names a row's dataset.

    ``names`` gives the outputs' names by their elements.
    """
    df, more = _instruments(spark, path, datasets, row_tag, info, schema, header_tag, created)
    known = df.schema[info].dataType.names if info in df.columns else []
    kind = F.coalesce(*[F.when(F.col(info)[tag].isNotNull(), F.lit((names or {}).get(tag, tag))) for tag in datasets if tag in known], F.lit(None).cast("string"))
    outputs = {
        (names or {}).get(tag, tag): {**{c: F.col(c) for c in more}, **{f.name: f.typed(_xml_value(df, f)) for f in fields}}
        for tag, fields in datasets.items()
    }
    return tagged(df, kind, outputs)


def tagged(df: DataFrame, output: Column, outputs: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """Rows of several datasets side by side: ``output`` and every dataset's columns, null where a row's dataset has no such column.

    Rows whose output is none of ``outputs`` are left out. Datasets that share a column's name share the column; if their
    types differ, each has its own, named ``column@output``. A row's dataset is asked for once a dataset, not once a column: each
    dataset's cells are made together.
    """
    kinds = {o: dict(df.select(*[c.alias(n) for n, c in columns.items()]).dtypes) for o, columns in outputs.items()}
    met = df.withColumn("__output", output).where(F.col("__output").isin(*outputs))
    whole = [F.when(F.col("__output") == o, F.struct(*[c.alias(n) for n, c in columns.items()])) for o, columns in outputs.items()]
    met = met.select("__output", *[w.alias(f"__{k}") for k, w in enumerate(whole)])
    cells: dict[str, list[Column]] = {}
    for k, (o, columns) in enumerate(outputs.items()):
        for n in columns:
            same = len({kind[n] for kind in kinds.values() if n in kind}) == 1
            cells.setdefault(n if same else f"{n}@{o}", []).append(F.col(f"__{k}")[n])
    return met.select(F.col("__output").alias("output"), *[F.coalesce(*c).alias(n) for n, c in cells.items()])


def latest_message(df: DataFrame, day_column: str, created_column: str, message_column: str) -> DataFrame:
    """Rows of each day's last message only; messages without a creation time do not count, and no usable one is an error."""
    known = df.where(F.col(created_column).isNotNull())
    if known.isEmpty():
        raise ValueError("no message with a creation time")
    last = known.groupBy(day_column).agg(F.max(F.struct(created_column, message_column)).alias("__last"))
    met = known.join(last, day_column)
    return met.where(F.col(message_column) == F.col("__last")[message_column]).drop("__last")


def drop_cross_day_rows(df: DataFrame, date_column: str, message_date_column: str, message_column: str) -> DataFrame:
    """Rows of the message's own day; all of a message's rows if none is."""
    if date_column not in df.columns:
        return df
    own = F.coalesce((F.col(date_column) == F.col(message_date_column)).cast("int"), F.lit(0))
    counted = df.withColumn("__own", own).withColumn("__n", F.sum("__own").over(Window.partitionBy(message_column)))
    return counted.where("__own = 1 or __n = 0").drop("__own", "__n")


def html_attr(column: Column, tag: str, attribute: str) -> Column:
    """The attribute of the first such element of an html column."""
    return F.regexp_extract(column, f'<{tag}\\b[^>]*\\b{attribute}="([^"]*)"', 1)
