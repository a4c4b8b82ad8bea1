"""Read registry drops: headered CSV files whose columns are found by name."""

import re
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roster.schema import ORDINAL, REGISTRY_HEADERS
from roster.sources.records import decoded, faults, find_splits, leaves_open, read_records

# Quotes are doubled inside a quoted cell; a backslash is an ordinary character.
_DIALECT = {"header": True, "escape": '"', "encoding": "UTF-8"}

# A row's place: folder, first number in the file's name, name, block of the file, row of the block.
_PLACE = "struct<folder: string, number: decimal(38,0), file: string, block: long, row: long>"


def literal_path(path: str) -> str:
    """A path whose pattern characters stand for themselves."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _place(file: Column, block: Column, row: Column) -> Column:
    """Folder, then the number in the file's name, then its name: part 100000 comes behind part 99999."""
    encoded = F.substring_index(file, "/", -1)
    folder = F.substr(file, F.lit(1), F.length(file) - F.length(encoded))
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    name = F.when(encoded.contains("%"), decoded).otherwise(encoded)
    number = F.regexp_extract(name, "[0-9]+", 0).try_cast("decimal(38,0)")
    return F.struct(
        folder.alias("folder"), number.alias("number"), name.alias("file"), block.alias("block"), row.alias("row")
    )


def check_header(columns: list[str]) -> None:
    """Refuse a header that repeats one of the needed names.

    Spark renames the repetitions to the name followed by the column's position.
    """
    for header in REGISTRY_HEADERS:
        renamed = [c for i, c in enumerate(columns) if c.casefold() == f"{header}{i}".casefold()]
        if len(renamed) > 1:
            raise ValueError(f"column {header!r} occurs {len(renamed)} times in the header")


def _header(spark: SparkSession, file: str, multi_line: bool) -> tuple[str, ...]:
    columns = spark.read.options(**_DIALECT, multiLine=multi_line).csv(literal_path(file)).columns
    check_header(columns)
    return tuple(columns)


def _texts(header: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in header])


def _wanted(header: tuple[str, ...], prefix: str = "") -> list[Column]:
    return [
        (F.col(f"{prefix}`{name}`") if name in header else F.lit("")).alias(column)
        for name, column in REGISTRY_HEADERS.items()
    ]


def _scan(
    spark: SparkSession, files: list[str], header: tuple[str, ...], multi_line: bool, check: bool
) -> DataFrame:
    """``files`` are literal paths of files or of folders."""
    reader = spark.read.options(**_DIALECT, multiLine=multi_line, enforceSchema=not check, recursiveFileLookup=True)
    scan = reader.schema(_texts(header)).csv(files)
    place = _place(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    )
    return scan.select(*_wanted(header), place.alias(ORDINAL))


def _ddl(header: tuple[str, ...]) -> str:
    names = [name.replace("`", "``") for name in header]
    return ", ".join(f"`{name}` string" for name in names)


def _scan_records(spark: SparkSession, files: list[str], header: tuple[str, ...]) -> DataFrame:
    """Files with records over several lines, each read by many tasks; those with other line ends by one task each."""
    splits = find_splits(spark, [literal_path(file) for file in files])
    known = {decoded(path) for path in splits}
    parted, others = [f for f in files if f in known], [f for f in files if f not in known]
    scans = [_scan(spark, [literal_path(file) for file in others], header, True, False)] if others else []
    if parted:
        records = read_records(spark, [literal_path(file) for file in parted], splits)
        cells = F.from_csv("text", _ddl(header), {"escape": '"'}).alias("_cells")
        place = _place(F.col("path"), F.col("block"), F.col("row")).alias(ORDINAL)
        scans.append(records.select(cells, place).select(*_wanted(header, "_cells."), ORDINAL))
    return reduce(DataFrame.unionByName, scans)


def _heads(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, first, broken) of each file: its first line, and whether a line that begins a record leaves a quoted cell open.

    One pass over the lines. Files without lines have no row.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return lines.groupBy("path").agg(
        F.min(F.struct("block", "row", "value")).getField("value").alias("first"),
        F.max(leaves_open(F.col("value"))).alias("broken"),
    )


class _Kind(NamedTuple):
    """Files that are read alike: one of them, its header, and whether records go over several lines."""

    first: str
    broken: bool
    sample: str
    header: tuple[str, ...]
    files: int


def _kinds(spark: SparkSession, heads: DataFrame, multi_line: bool | None) -> list[_Kind]:
    """The kinds of files, in the order of their first paths; one row for each is gathered, not the files."""
    # A first line that is not a whole record says nothing about files that begin alike.
    own = F.when(leaves_open(F.col("first")), F.col("path"))
    kinds = heads.groupBy("first", "broken", own.alias("own")).agg(F.min("path").alias("sample"), F.count("*").alias("files"))
    found = []
    for row in kinds.orderBy("sample").collect():
        if row.broken and multi_line is False:
            raise ValueError(f"a record goes over several lines in {decoded(row.sample)}")
        header = _header(spark, decoded(row.sample), bool(row.broken or multi_line))
        found.append(_Kind(row["first"], row.broken, row.sample, header, row.files))
    return found


def _paths(heads: DataFrame, kinds: list[_Kind]) -> list[str]:
    """The files of some kinds, in order."""
    chosen = heads.where(F.lit(False))
    for kind in kinds:
        alike = (F.col("first") == F.lit(kind.first)) & (F.col("broken") == F.lit(kind.broken))
        alike = alike & (F.col("path") == kind.sample) if kind.files == 1 else alike & ~leaves_open(F.col("first"))
        chosen = chosen.unionByName(heads.where(alike))
    return sorted(decoded(row.path) for row in chosen.select("path").distinct().collect())


def read_registry(
    spark: SparkSession, path: str | list[str], multi_line: bool | None = None, one_header: bool = False
) -> DataFrame:
    """The 13 needed columns of one file, of a list of files or of a folder, plus the ordinal.

    Columns are taken by header name; a missing one reads as ''. One pass over the lines of all files
    finds the headers and the files in which a record goes over several lines. All files are read in splits;
    those with such records are cut into records first (``records``). Files with the same header are read
    together, so plan and jobs grow with the number of different headers and not with the files. Where
    all files are alike, Spark reads the folder and no list of files is gathered.

    ``multi_line`` True reads every file by one task, False refuses records of several lines. With
    ``one_header`` a file whose header differs from the first one's makes the scan fail.
    """
    paths = [literal_path(p) for p in ([path] if isinstance(path, str) else path)]
    if not paths:
        return _no_rows(spark)
    heads = _heads(spark, paths).persist()
    try:
        kinds = _kinds(spark, heads, multi_line)
        if one_header:
            kinds = [kind._replace(header=kinds[0].header) for kind in kinds]
        ways: dict[tuple[tuple[str, ...], bool], list[_Kind]] = {}
        for kind in kinds:
            if kind.header:
                ways.setdefault((kind.header, kind.broken), []).append(kind)
        scans = []
        for (header, broken), alike in ways.items():
            if broken and multi_line is None and not one_header:
                scans.append(_scan_records(spark, _paths(heads, alike), header))
            else:
                files = paths if len(ways) == 1 else [literal_path(file) for file in _paths(heads, alike)]
                scans.append(_scan(spark, files, header, bool(broken or multi_line), one_header))
    finally:
        heads.unpersist()
    return reduce(DataFrame.unionByName, scans) if scans else _no_rows(spark)


def rejected_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """What ``read_registry`` has to mend: records whose cells are too few or too many, or badly quoted.

    They are read nevertheless: padded, cut, and with their quotes kept. One row for each: ``file``, ``place`` of the
    record in its drop, ``fault`` (short, long or badly_quoted), number of ``cells`` and the record as it stands.
    Spark's permissive reader marks records with other than the header's number of cells; the quotes tell
    which of them are short, and which are badly quoted with the right number. A record of white space alone is no fault.
    """
    paths = [literal_path(p) for p in ([path] if isinstance(path, str) else path)]
    if not paths:
        return spark.createDataFrame([], _REJECTED)
    heads = _heads(spark, paths).persist()
    try:
        found = []
        for kind in (k for k in _kinds(spark, heads, None) if k.header):
            files = [literal_path(file) for file in _paths(heads, [kind])]
            splits = find_splits(spark, files)
            others = [f for f in files if f not in {literal_path(decoded(p)) for p in splits}]
            if others:
                raise ValueError(f"lines of {others[0]} end in carriage returns alone; its records cannot be told apart")
            found.append(_marked(read_records(spark, files, splits), kind.header))
    finally:
        heads.unpersist()
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], _REJECTED)


_REJECTED = f"file string, place {_PLACE}, fault string, cells int, record string"


def _marked(records: DataFrame, header: tuple[str, ...]) -> DataFrame:
    corrupt = "_corrupt"
    while corrupt in header:
        corrupt += "_"
    read = F.from_csv("text", f"{_ddl((*header, corrupt))}", {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    seen = records.where(F.trim("text") != "").select("path", "block", "row", "text", read.alias("read"), faults(F.col("text"), len(header)).alias("found"))
    mismatch = F.col(f"read.`{corrupt}`").isNotNull()
    fault = F.when(mismatch | (F.col("found.fault") == "badly_quoted"), F.col("found.fault"))
    place = _place(F.col("path"), F.col("block"), F.col("row"))
    named = seen.select(place.alias("place"), fault.alias("fault"), F.col("found.cells").alias("cells"), F.col("text").alias("record"))
    return named.where(F.col("fault").isNotNull()).select(F.col("place.file").alias("file"), "place", "fault", "cells", "record")


def _no_rows(spark: SparkSession) -> DataFrame:
    texts = ", ".join(f"{column} string" for column in REGISTRY_HEADERS.values())
    return spark.createDataFrame([], f"{texts}, {ORDINAL} {_PLACE}")


def write_registry(raw: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Write raw rows as a drop of CSV part files whose order is the ordinal's order; all columns unless given.

    Spark runs ``raw`` twice, once to find the ranges: pass a stored frame if it is costly.
    """
    headers = {column: header for header, column in REGISTRY_HEADERS.items()}
    names = [F.col(column).alias(headers[column]) for column in columns or headers]
    (
        raw.repartitionByRange(ORDINAL)
        .sortWithinPartitions(ORDINAL)
        .select(*names)
        .write.options(
            header=True,
            escape='"',
            emptyValue="",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        .csv(path)
    )


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """A target list: headered CSV with the columns county and city."""
    return spark.read.schema("county string, city string").options(header=True, escape='"').csv(path)
