"""Files of many formats as rows of ``(path, block, row, item, text)``.

``block`` is where the file split starts, ``row`` rises inside it and ``item`` counts
the texts of one JSON array, so ``(path, block, row, item)`` is the order of the
corpus; ``dense_position`` turns it into one number.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import partial, reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions import json as J
from weftline.functions.text import (
    decode_utf8_ignore,
    has_text,
    is_blank,
    strip,
    universal_newlines,
)
from weftline.operators.ranks import div, with_rank
from weftline.operators.select import (
    CSV_SUFFIXES,
    JSON_SUFFIXES,
    PARQUET_SUFFIXES,
    TEXT_SUFFIXES,
    union_sources,
)
from weftline.session import materialize
from weftline.sources import ranges
from weftline.sources.stores import arrow_uri

ORDER = ["path", "block", "row", "item"]
COLUMNS = [*ORDER, "text"]
MIB = 1 << 20
#: Spark holds no longer string, so no larger file is read as one value.
WHOLE_BYTES = (1 << 31) - 1
DAMAGED = 10_000
#: Of small files, what a row of a listing names at most, and what a task reads, about.
PIECE_FILES, PIECE_BYTES = 256, 64 * MIB
TASK_FILES, TASK_BYTES = 64 * PIECE_FILES, 128 * MIB


def suffix_glob(suffixes: Iterable[str]) -> str:
    """A file-name pattern for the suffixes in any case."""

    def any_case(suffix: str) -> str:
        return "".join(
            f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix
        )

    return "*{" + ",".join(any_case(s) for s in suffixes) + "}"


def _reader(spark: SparkSession, suffixes: Iterable[str] | None, recursive: bool):
    reader = spark.read.option("recursiveFileLookup", recursive)
    return reader.option("pathGlobFilter", suffix_glob(suffixes)) if suffixes else reader


def _placed(df: DataFrame) -> DataFrame:
    """Add the place of each row as the scan meets it."""
    return df.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.lit(0).cast("bigint").alias("item"),
        *df.columns,
    )


def _kept(df: DataFrame, skip: Sequence[str]) -> DataFrame:
    """Leave files out by name; the scan does not open them."""
    return df.filter(~F.col("_metadata.file_path").isin(*skip)) if skip else df


#: Formats in which a file can be damaged as a whole.
CHECKED_SUFFIXES = (*PARQUET_SUFFIXES, ".gz")


def skipped_files(
    spark: SparkSession, path: str, recursive: bool = True
) -> DataFrame:
    """``(path, reason)`` of compressed and Parquet files that cannot be read.

    Contents are decoded in full. A file that the store fails to deliver is an error, not
    a damaged file; files above 2 GB are not looked at.
    """
    files = _reader(spark, CHECKED_SUFFIXES, recursive).format("binaryFile").load(path)
    held = files.filter(F.col("_metadata.file_size") <= WHOLE_BYTES).select(
        F.col("_metadata.file_path").alias("path"), "content"
    )

    def check(batches):
        for batch in batches:
            names = batch.column("path").to_pylist()
            reasons = [
                damage(name, content.as_buffer())
                for name, content in zip(names, batch.column("content"), strict=True)
            ]
            yield pa.RecordBatch.from_pydict(
                {"path": pa.array(names), "reason": pa.array(reasons, pa.string())}
            )

    return held.mapInArrow(check, "path string, reason string").filter("reason is not null")


def damage(name: str, content: pa.Buffer) -> str | None:
    """Why a file's content cannot be decoded, or null."""
    try:
        if name.lower().endswith(".gz"):
            with gzip.GzipFile(fileobj=pa.BufferReader(content)) as plain:
                while plain.read(MIB):
                    pass
        else:
            for _ in pq.ParquetFile(pa.BufferReader(content)).iter_batches(1024):
                pass
    except (OSError, EOFError, zlib.error, pa.ArrowException) as error:
        return f"{type(error).__name__}: {str(error).splitlines()[0][:200]}"
    return None


def damaged_names(skipped: DataFrame) -> list[str]:
    """The names of damaged files, for ``skip``. There may not be more than 10,000."""
    names = [r["path"] for r in skipped.select("path").limit(DAMAGED + 1).collect()]
    if len(names) > DAMAGED:
        raise ValueError(f"more than {DAMAGED} damaged files")
    return names


def read_text_files(
    spark: SparkSession,
    path: str,
    suffixes: Iterable[str] | None = None,
    recursive: bool = True,
    skip: Sequence[str] = (),
) -> DataFrame:
    """One document per file: malformed UTF-8 dropped, stripped, blank files left out.

    Below a folder that Arrow can open, tasks list the folders and read the files, many of them each;
    Spark's reader would list all on the driver, with a task for every 32 files. It takes
    files above 64 MiB, other paths, and folders with check sums beside the files, which it compares.
    """
    files = _small_files(spark, path, suffixes, skip) if recursive else None
    if files is None:
        files = _whole_files(spark, path, suffixes, recursive, skip)
    text = strip(universal_newlines(decode_utf8_ignore(F.col("content"))))
    zero = F.lit(0).cast("bigint")
    # a generator, so that the filter does not decode a second time
    return files.select(
        "path", zero.alias("block"), zero.alias("row"), zero.alias("item"), F.explode(F.array(text)).alias("text")
    ).filter("text <> ''")


def _whole_files(
    spark: SparkSession, path: str, suffixes: Iterable[str] | None, recursive: bool, skip: Sequence[str]
) -> DataFrame:
    """``(path, content)`` of files, by Spark's reader."""
    files = _kept(_reader(spark, suffixes, recursive).format("binaryFile").load(path), skip)
    return files.select("path", "content", F.col("_metadata.file_size").alias("size"))


def _small_files(
    spark: SparkSession, path: str, suffixes: Iterable[str] | None, skip: Sequence[str]
) -> DataFrame | None:
    """``(path, content)`` of all files below a folder, or None where Arrow finds no folder, or check sums."""
    found = None if set("{}[]*?\\") & set(path) else arrow_uri(spark, path)
    if found is None or not _is_folder(found[1]):
        return None
    shown, uri = found
    pieces = _listed(spark, shown, uri, suffixes, skip)
    rows, files, size, largest, checked = pieces.agg(
        F.count("*"), F.sum(F.size("names")), F.sum("bytes"), F.max("bytes"), F.max("checked")
    ).first()
    if checked:
        return None

    def read(batches):
        store, root = pafs.FileSystem.from_uri(uri)
        for batch in batches:
            for folder, names in zip(*(batch.column(c).to_pylist() for c in ("folder", "names")), strict=True):
                contents = []
                for name in names:
                    with store.open_input_file(_below(root, folder, name)) as file:
                        contents.append(file.read())
                paths = [_below(shown, folder, name) for name in names]
                yield pa.RecordBatch.from_pydict({"path": paths, "content": pa.array(contents, pa.binary())})

    tasks = max(1, min(rows, spark.sparkContext.defaultParallelism), -(-(files or 0) // TASK_FILES), -(-(size or 0) // TASK_BYTES))
    small = pieces.filter(F.col("bytes") <= PIECE_BYTES).repartition(tasks)
    held = small.mapInArrow(read, "path string, content binary")
    if (largest or 0) <= PIECE_BYTES:
        return held
    large = _whole_files(spark, path, suffixes, True, skip).filter(F.col("size") > PIECE_BYTES)
    return held.unionByName(large.drop("size"))


def _is_folder(uri: str) -> bool:
    try:
        store, root = pafs.FileSystem.from_uri(uri)
        return store.get_file_info(root).type == pafs.FileType.Directory
    except (pa.ArrowException, OSError):
        return False


def _below(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *(part for part in parts if part)])


def _hidden(name: str, folder: bool) -> bool:
    """Names that Spark's listing passes over."""
    if folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _pieces(found: Iterable[pafs.FileInfo], files: int, size: int) -> Iterator[tuple[list[str], int]]:
    """Names and bytes of so many files at most, and so many bytes but for a larger file alone."""
    names, held = [], 0
    for info in found:
        if names and (len(names) == files or held + info.size > size):
            yield names, held
            names, held = [], 0
        names.append(info.base_name)
        held += info.size
    if names:
        yield names, held


def _listed(
    spark: SparkSession, shown: str, uri: str, suffixes: Iterable[str] | None, skip: Sequence[str]
) -> DataFrame:
    """``(folder, names, bytes, checked)``: the files below a folder in pieces, and if any has a check sum beside it.

    Tasks list a level of folders at a time.
    """
    endings = tuple(s.lower() for s in suffixes) if suffixes else ("",)
    skipped = {unquote(name).replace("file:///", "file:/", 1) for name in skip}
    schema = "folder string, names array<string>, bytes long, checked boolean"
    kinds = pa.schema([
        ("folder", pa.string()), ("names", pa.list_(pa.string())), ("bytes", pa.int64()), ("checked", pa.bool_())
    ])

    def rows(store, root, folder):
        found = store.get_file_info(pafs.FileSelector(_below(root, folder)))
        found = sorted(found, key=lambda info: info.base_name)
        for info in found:
            if info.type == pafs.FileType.Directory and not _hidden(info.base_name, True):
                yield f"{folder}/{info.base_name}".lstrip("/"), None, None, None
        wanted = (
            info for info in found
            if info.is_file and info.size and not _hidden(info.base_name, False)
            and info.base_name.lower().endswith(endings) and _below(shown, folder, info.base_name) not in skipped
        )
        sums = {info.base_name for info in found if info.base_name.endswith(".crc")}
        for names, size in _pieces(wanted, PIECE_FILES, PIECE_BYTES):
            yield folder, names, size, any(f".{name}.crc" in sums for name in names)

    def listing(batches):
        store, root = pafs.FileSystem.from_uri(uri)
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                all_rows = list(rows(store, root, folder))
                for at in range(0, len(all_rows), 1000):
                    columns = zip(*all_rows[at : at + 1000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)

    tasks = spark.sparkContext.defaultParallelism
    folders, levels = spark.range(1).select(F.lit("").alias("folder")), []
    while not levels or not folders.isEmpty():
        level = materialize(folders.repartition(tasks).mapInArrow(listing, schema), "listing")
        levels.append(level.filter("names is not null"))
        folders = level.filter("names is null").select("folder")
    return reduce(DataFrame.unionByName, levels)


def _csv_records(lines: DataFrame, delimiter: str) -> tuple[DataFrame, DataFrame]:
    """Records ``(path, record, value)`` that may hold quoted line breaks, and ``(path, header)``."""
    csv = ranges.CsvLines(delimiter)
    found = materialize(ranges.facts(lines, partial(ranges.CsvFacts, csv), ranges.CsvFacts.schema), "csv-ranges")

    def start(first: dict) -> ranges.CsvCutter:
        return ranges.CsvCutter(csv, first["state"])

    records = ranges.cut(lines, ranges.csv_states(found), start, "\n")
    return records, found.filter("block = 0").select("path", "header")


def read_csv_column(
    spark: SparkSession,
    path: str,
    column: str = "text",
    delimiter: str = ",",
    multi_line: bool = True,
    suffixes: Iterable[str] | None = None,
    recursive: bool = True,
    skip: Sequence[str] = (),
) -> DataFrame:
    """The named column of CSV files with headers: stripped, blanks left out.

    Each file's own header, its first record, says where the column is; files without it
    give no rows. Large files are many tasks. Quoted line breaks need a first pass over the
    lines, which finds the open quotes and the headers; with ``multi_line`` False that pass
    only looks for headers, and a line is a record.
    """
    options = {"sep": delimiter, "quote": '"', "escape": '"'}
    lines = _kept(_placed(_reader(spark, suffixes, recursive).text(path)), skip)
    if multi_line:
        records, headers = _csv_records(lines, delimiter)
        records = records.select(
            "path", F.lit(0).cast("bigint").alias("block"), F.col("record").alias("row"), F.lit(0).cast("bigint").alias("item"), "value"
        )
    else:
        headers = lines.filter("block = 0").groupBy("path").agg(F.min_by("value", "row").alias("header"), F.min("row").alias("_first"))
        headers = materialize(headers, "csv-headers")
        records = lines.select("path", "block", "row", "item", "value")
    headers = headers.withColumn("header", F.btrim("header", F.lit("\ufeff")))
    # no header has more names than it has parts
    quoted = F.lit("\\Q" + delimiter + "\\E")
    width = headers.agg(F.max(F.size(F.split("header", quoted, -1)))).first()[0] or 1
    columns = [f"_c{i}" for i in range(width)]
    schema = ", ".join(f"{c} string" for c in columns)
    names = F.from_csv("header", schema, options)
    named = headers.withColumn("names", F.array(*[names[c] for c in columns]))
    # the last of equal names wins, as in a dictionary of the row
    at = width - F.array_position(F.reverse("names"), column).cast("int")
    headers = named.select("path", at.alias("_at"), *([] if multi_line else ["_first"])).filter(F.array_contains("names", column))
    # a file's rows are many and its header is one: skewed files are split
    rows = records.join(headers, "path")
    rows = rows.filter("row > 0") if multi_line else rows.filter("block > 0 or row <> _first")
    fields = F.from_csv("value", schema, options)
    text = F.get(F.array(*[fields[c] for c in columns]), F.col("_at"))
    text = strip(universal_newlines(text))
    return rows.withColumn("text", text).filter("text <> ''").select(*COLUMNS)


def _json_texts(items: Column, field: str) -> Column:
    """The texts of objects and strings, null for other items."""

    def text_of(item: Column) -> Column:
        from_object = F.nullif(strip(J.text_field(item, field)), F.lit(""))
        return F.coalesce(J.string_of(item), from_object)

    return F.transform(items, text_of)


def _json_lines(
    spark: SparkSession,
    path: str,
    suffixes: Iterable[str] | None,
    recursive: bool,
    skip: Sequence[str],
) -> DataFrame:
    """Lines that are not blank, with ``json`` null where a line is not JSON."""
    lines = _kept(_placed(_reader(spark, suffixes, recursive).text(path)), skip)
    return J.with_items(lines.filter(has_text(F.col("value"))), F.col("value"), "json")


def _texts(rows: DataFrame, field: str) -> DataFrame:
    texts = F.posexplode(_json_texts(F.col("json"), field)).alias("item", "text")
    found = rows.select("path", "block", "row", texts).filter("text is not null")
    return found.withColumn("item", F.col("item").cast("bigint"))


def read_jsonl(
    spark: SparkSession,
    path: str,
    field: str = "text",
    suffixes: Iterable[str] | None = None,
    recursive: bool = True,
    skip: Sequence[str] = (),
) -> DataFrame:
    """JSON lines: the field of an object, stripped and not blank, or a string as it is.

    A line that is not JSON costs only itself.
    """
    lines = _json_lines(spark, path, suffixes, recursive, skip)
    return _texts(lines.filter("json is not null"), field)


def _only(placed: DataFrame, paths: DataFrame, keep: bool) -> DataFrame:
    """The rows of the given files, or of all others.

    Up to ``DAMAGED`` names become a filter on files, so that the scan opens no other.
    """
    names = [r["path"] for r in paths.limit(DAMAGED + 1).collect()]
    if len(names) > DAMAGED:
        return placed.join(paths, "path", "left_semi" if keep else "left_anti")
    listed = F.col("_metadata.file_path").isin(*names) if names else F.lit(False)
    return placed.filter(listed if keep else ~listed)


def _json_values(fragments: DataFrame, states: DataFrame, field: str) -> DataFrame:
    """Texts of the files that ``states`` knows as one JSON value each: the columns of this module.

    The fragments are those of all files, since a scan of other files has other ranges.
    A file with an element that is not JSON gives one row without text. An element
    above 128 MiB is an error.
    """

    def start(first: dict) -> ranges.JsonCutter | None:
        level = {ranges.ARRAY: 1, ranges.OBJECT: -1}.get(first["kind"])
        return ranges.JsonCutter(first["state"], first["depth"], level) if level else None

    records = ranges.cut(fragments, states, start, ",")
    files = states.filter("kind is not null").groupBy("path").agg(F.max("total").alias("total"), F.max("kind").alias("kind"))
    records = records.join(files, "path")
    in_array = F.col("kind") == ranges.ARRAY
    value = F.regexp_replace("value", "^\ufeff", "")
    value = F.when(in_array & (F.col("record") == 0), F.regexp_replace(value, r"^[ \t\r\n]*\[", "")).otherwise(value)
    last = in_array & (F.col("record") == F.col("total"))
    value = F.when(last, F.regexp_replace(value, r"\][ \t\r\n]*$", "")).otherwise(value)
    records = records.withColumn("value", value)
    # an array without elements
    records = records.filter(~(in_array & (F.col("total") == 0) & is_blank(F.col("value"))))
    parsed = J.with_loud_json(records, F.col("value"), "json")
    text = _json_texts(F.array("json"), field)
    zero = F.lit(0).cast("bigint")
    found = parsed.select(
        "path", zero.alias("block"), zero.alias("row"), F.col("record").alias("item"), F.get(text, F.lit(0)).alias("text"),
        F.col("json").isNull().alias("_broken"),
    )
    found = found.filter("_broken or text is not null")
    return materialize(found, "json-values")


def _json_files(
    spark: SparkSession,
    path: str | list[str],
    suffixes: Iterable[str] | None,
    recursive: bool,
    skip: Sequence[str],
    field: str,
) -> tuple[DataFrame, DataFrame]:
    """Texts of the files that are one JSON value, and the paths of those files."""
    source = _reader(spark, suffixes, recursive).option("lineSep", ",").text(path)
    fragments = _kept(_placed(source), skip)
    found = ranges.facts(fragments, lambda block: ranges.JsonFacts(), ranges.JsonFacts.schema)
    states = materialize(ranges.json_states(materialize(found, "json-ranges")), "json-states")
    paths = states.filter("kind is not null").select("path").distinct()
    if paths.isEmpty():
        return _texts(fragments.limit(0).withColumn("json", F.lit(None).cast("array<variant>")), field), paths
    values = _json_values(fragments, states, field)
    broken = values.filter("_broken").select("path").distinct()
    good = values.join(broken, "path", "left_anti").drop("_broken")
    return good, paths.join(broken, "path", "left_anti")


def read_json_documents(
    spark: SparkSession,
    path: str | list[str],
    field: str = "text",
    suffixes: Iterable[str] | None = None,
    recursive: bool = True,
    skip: Sequence[str] = (),
) -> DataFrame:
    """Files that each hold one JSON value: an array of objects or strings, or one object.

    Files may be of any size and large ones are many tasks, see ``ranges``. An element of an
    array, or an object, is at most 128 MiB; what is larger is an error. ``item`` is the place in the
    array. Files that are not one value give no rows, but for lines that are (an object on one line).
    """
    return read_json(spark, path, field, suffixes, recursive, skip, by_line=False)


def read_json(
    spark: SparkSession,
    path: str | list[str],
    field: str = "text",
    suffixes: Iterable[str] | None = None,
    recursive: bool = True,
    skip: Sequence[str] = (),
    by_line: bool = True,
) -> DataFrame:
    """JSON files of either kind: lines, or one value over several lines.

    A file that is one array, or one object over several lines, counts as that value; of any
    other the good lines count. A first pass over the bytes finds out which, whatever the
    size of a file; no file is read as one string.
    """
    values, paths = _json_files(spark, path, suffixes, recursive, skip, field)
    others = _only(_kept(_placed(_reader(spark, suffixes, recursive).text(path)), skip), paths, False)
    lines = others.filter(has_text(F.col("value")))
    if not by_line:
        # a file of one line is one value too
        lines = lines.join(lines.groupBy("path").agg(F.count("*").alias("_n")).filter("_n = 1"), "path", "left_semi")
    lines = J.with_items(lines, F.col("value"), "json").filter("json is not null")
    return _texts(lines, field).unionByName(values)


def read_parquet_column(
    spark: SparkSession,
    path: str,
    column: str = "text",
    suffixes: Iterable[str] | None = None,
    recursive: bool = True,
    skip: Sequence[str] = (),
) -> DataFrame:
    """The named string column, not blank, as it is; files without it give no rows.

    Only that column is read. A file that cannot be read is an error, unless ``skip`` names
    it (see ``skipped_files``).
    """
    schema = T.StructType([T.StructField(column, T.StringType())])
    table = (
        _reader(spark, suffixes, recursive)
        .schema(schema)
        .parquet(path)
    )
    return _kept(table, skip).select(
        F.col("_metadata.file_path").alias("path"),
        F.lit(0).cast("bigint").alias("block"),
        F.col("_metadata.row_index").alias("row"),
        F.lit(0).cast("bigint").alias("item"),
        F.col(column).alias("text"),
    ).filter(has_text(F.col("text")))


def ingest_mixed_dir(
    spark: SparkSession,
    directory: str,
    column: str = "text",
    recursive: bool = True,
    readers: Mapping[tuple[str, ...], Callable[..., DataFrame]] | None = None,
    skip: Sequence[str] = (),
) -> DataFrame:
    """Every supported file below a directory but ``skip``, by its extension in any case.

    ``readers`` adds formats (sheets, paged documents): a tuple of suffixes and a
    function ``(spark, directory, column, suffixes, recursive)`` that returns the
    columns of this module.
    """

    def text_files(spark, path, column, suffixes, recursive):
        return read_text_files(spark, path, suffixes, recursive, skip)

    def by_column(read):
        return lambda spark, path, column, suffixes, recursive: read(
            spark, path, column, suffixes=suffixes, recursive=recursive, skip=skip
        )

    formats = {
        TEXT_SUFFIXES: text_files,
        CSV_SUFFIXES: by_column(read_csv_column),
        JSON_SUFFIXES: by_column(read_json),
        PARQUET_SUFFIXES: by_column(read_parquet_column),
        **(readers or {}),
    }
    return union_sources(
        read(spark, directory, column, suffixes, recursive).select(*COLUMNS)
        for suffixes, read in formats.items()
    )


def parse_lines(df: DataFrame, line: str, field: str = "text") -> DataFrame:
    """Add ``text``, unstripped, and ``reason``: why the line is refused, or null."""

    def checked(value: Column) -> Column:
        text = J.text_field(value, field)
        reason = (
            F.when(value.isNull() & J.is_too_large(F.col(line)), J.TOO_LARGE)
            .when(value.isNull(), J.INVALID_JSON)
            .when(J.field_of(value, field).isNull(), J.MISSING_FIELD)
            .when(text.isNull(), J.NOT_A_STRING)
            .when(is_blank(text), J.EMPTY_TEXT)
        )
        return F.struct(text.alias("text"), reason.alias("reason"))

    value = F.array(J.strict_json(strip(F.col(line))))
    # a generator, so that the line is parsed once for both columns and any filter
    return df.select("*", F.inline(F.transform(value, checked)))


def load_valid_jsonl(spark: SparkSession, path: str, field: str = "text") -> DataFrame:
    """The valid lines of JSONL files, texts unstripped."""
    parsed = parse_lines(_placed(spark.read.text(path)), "value", field)
    return parsed.filter("reason is null").select(*COLUMNS)


def rejects(spark: SparkSession, path: str, field: str = "text") -> DataFrame:
    """``(path, line_no, line, reason)`` of the lines ``load_valid_jsonl`` leaves out.

    Every line takes part in the numbering, but only refused ones carry their text.
    """
    parsed = parse_lines(_placed(spark.read.text(path)), "value", field)
    slim = parsed.select(
        "path",
        "block",
        "row",
        "reason",
        F.when(F.col("reason").isNotNull(), F.col("value")).alias("line"),
    )
    numbered = with_rank(
        slim, ["block", "row"], "line_no", by=["path"], bucket=div(F.col("block"), MIB)
    )
    return numbered.filter("reason is not null").select(
        "path", (F.col("line_no") + 1).alias("line_no"), "line", "reason"
    )


def reject_report(df: DataFrame, line: str, field: str = "text") -> DataFrame:
    """``(reason, n)``, with reason ``ok`` for the valid lines."""
    reason = F.coalesce("reason", F.lit("ok")).alias("reason")
    return parse_lines(df, line, field).groupBy(reason).agg(F.count("*").alias("n"))


def load_packed_json(spark: SparkSession, path: str, extra: str = "") -> DataFrame:
    """Packed rows stored as JSON; ``extra`` names further columns as DDL."""
    schema = "input_ids array<int>, labels array<int>" + (f", {extra}" if extra else "")
    return spark.read.schema(schema).json(path)
