"""Records of CSV files that go over several lines, found by many tasks in one file.

Whether a line break ends a record depends on all quotes before it, so a split of a file alone does not know
where its records begin. But a split can say, for each of the two ways it may begin (between records or inside
a quoted cell), in which way it ends. These answers are combined along the splits of a file; then every split
knows how it begins and cuts its own records. What is left at its two ends belongs to a record that crosses
splits; such pieces are joined by Spark.

A quote opens a cell only at the cell's beginning, ``""`` within it is one quote, and what follows a closing
quote other than a comma makes the rest of the cell plain text, as in Spark's reader. So a stray quote within a
cell opens nothing. A quote that is never closed makes the rest of its file one cell, without the line feed at
the file's end.
"""

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Where a text may stand: at the beginning of a cell, in plain text, in a quoted cell, behind a quote in it,
# behind white space that follows the closing quote.
_CELL, _PLAIN, _QUOTED, _CLOSED, _SPACED = range(5)
# What a quote does there.
_AT_QUOTE = (_QUOTED, _PLAIN, _CLOSED, _QUOTED, _PLAIN)
_COMMA, _WHITE = ord(","), bytes(range(33))


# Cells with quotes where they belong, which most lines have; then a quoted cell may be left open. No step goes back,
# so a long line takes no more stack. Others are scanned quote by quote.
_INSIDE = r'(?:[^"]++|"")*+'
_CELLS = rf'(?:(?:"{_INSIDE}"|[^",]++)?+(?:,|\Z))*+'
_FROM_CELL = re.compile(rf'{_CELLS}(?:\Z|("){_INSIDE}\Z)'.encode())
_FROM_QUOTED = re.compile(rf'{_INSIDE}(?:(\Z)|"(?:,|\Z){_CELLS}(?:\Z|("){_INSIDE}\Z))'.encode())
_CELLS_JAVA = "^" + _CELLS.replace(r"\Z", r"\z")


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a line ends inside a quoted cell that begins inside one or begins a record."""
    if b'"' not in line:
        return inside
    found = (_FROM_QUOTED if inside else _FROM_CELL).match(line)
    if found is None:
        return state_after(line, _QUOTED if inside else _CELL) == _QUOTED
    return found.lastindex is not None


def state_after(line: bytes, state: int) -> int:
    """Where a line ends that begins in ``state``."""
    for i, text in enumerate(line.split(b'"')):
        if i:
            state = _AT_QUOTE[state]
        if text and state != _QUOTED:
            state = _SPACED if state == _CLOSED and not text.strip(_WHITE) else _CELL if text[-1] == _COMMA else _PLAIN
    return state


def _scanned(text: Column) -> Column:
    """The same for a text that begins a record, as a column: ``state``, number of commas between cells, ``bad`` quoting."""

    def step(held: Column, part: Column) -> Column:
        before = held["state"]
        moved = F.when(before == _CELL, _QUOTED).when(before == _QUOTED, _CLOSED).when(before == _CLOSED, _QUOTED).otherwise(_PLAIN)
        state = F.when(held["begun"], moved).otherwise(before)
        outside = (part != "") & (state != _QUOTED)
        closed = outside & (state == _CLOSED)
        rest = F.ltrim(part, F.lit("".join(map(chr, range(33)))))
        after = (
            F.when(~outside, state)
            .when(closed & (rest == ""), _SPACED)
            .when(part.endswith(","), _CELL)
            .otherwise(_PLAIN)
        )
        commas = F.when(outside, F.length(part) - F.length(F.replace(part, F.lit(","), F.lit("")))).otherwise(0)
        bad = (closed & (rest != "") & ~rest.startswith(",")) | (held["begun"] & (before == _SPACED))
        return F.struct(
            after.alias("state"), (held["commas"] + commas).alias("commas"), (held["bad"] | bad).alias("bad"), F.lit(True).alias("begun")
        )

    start = F.struct(F.lit(_CELL).alias("state"), F.lit(0).alias("commas"), F.lit(False).alias("bad"), F.lit(False).alias("begun"))
    return F.aggregate(F.split(text, '"', -1), start, step)


def leaves_open(line: Column) -> Column:
    """Whether a line that begins a record ends inside a quoted cell."""
    clean = ~line.contains('"') | line.rlike(rf"{_CELLS_JAVA}\z")
    left_open = line.rlike(rf'{_CELLS_JAVA}"{_INSIDE}\z')
    return F.when(clean, False).when(left_open, True).otherwise(_scanned(line)["state"] == _QUOTED)


def faults(record: Column, columns: int) -> Column:
    """What a reader of ``columns`` cells has to mend in a record, and how many cells it has.

    ``short`` rows are padded, ``long`` ones are cut; ``badly_quoted`` means text behind a closing quote, or
    a quote that is never closed. One of them is named, bad quoting first.
    """
    found = _scanned(record)
    cells = found["commas"] + 1
    kind = (
        F.when(found["bad"] | (found["state"] == _QUOTED), "badly_quoted")
        .when(cells < columns, "short")
        .when(cells > columns, "long")
    )
    return F.struct(kind.alias("fault"), cells.alias("cells"))


class Split(NamedTuple):
    """How a split begins: inside a quoted cell or not, and in which split that cell's record begins."""

    inside: bool
    opened: int
    crlf: bool


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("value").cast("binary").alias("line"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[tuple[bytes, int]]]]:
    """The lines of each split, which come one after the other."""
    lines = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
    held = next(lines, None)
    while held is not None:
        place = held[1], held[2]

        def chunk():
            nonlocal held
            while held is not None and (held[1], held[2]) == place:
                yield held[0], held[3]
                held = next(lines, None)

        rows = chunk()
        yield *place, rows
        for _ in rows:
            pass


def _answers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split how it ends, if it begins between records and if it begins inside a quoted cell.

    ``begins``: whether a record begins in it, in either case. ``returns``: what a carriage return in the first
    line says about the file: 0 there is none, 1 it ends the line, 2 it stands elsewhere.
    """
    found: list[tuple] = []
    for path, block, lines in _chunks(batches):
        ends, begins, returns = [False, True], [False, False], 0
        for i, (line, _) in enumerate(lines):
            if not i:
                returns = 0 if b"\r" not in line else 1 if line.find(b"\r") == len(line) - 1 else 2
            for k in (0, 1):
                begins[k] |= not ends[k]
                ends[k] = ends_inside(line, ends[k])
        found.append((path, block, *ends, *begins, returns))
    types = [pa.string(), pa.int64(), *[pa.bool_()] * 4, pa.int32()]
    columns = zip(*found) if found else [[] for _ in types]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in _ANSWER.split(", ")])


_ANSWER = "path string, block long, open_after_end boolean, open_after_cell boolean, begins_after_end boolean, begins_after_cell boolean, returns int"


def find_splits(spark: SparkSession, paths: list[str]) -> dict[str, dict[int, Split]]:
    """How each split of the files begins. One row for each split is gathered, as Spark's own list of splits is.

    A file whose first line has a carriage return elsewhere than at its end is not in the result: its records
    may end there.
    """
    found: dict[str, dict[int, Split]] = {}
    # Put in order here: to sort a frame by ranges, Spark would compute it twice.
    answers = sorted(_lines(spark, paths).mapInArrow(_answers, _ANSWER).collect(), key=lambda a: (a.path, a.block))
    inside, opened, crlf, path = False, 0, False, None
    for answer in answers:
        if answer.path != path:
            path, inside, opened, crlf = answer.path, False, 0, answer.returns == 1
            if answer.returns < 2:
                found[path] = {}
        if path in found:
            found[path][answer.block] = Split(inside, opened, crlf)
        if answer.begins_after_cell if inside else answer.begins_after_end:
            opened = answer.block
        inside = answer.open_after_cell if inside else answer.open_after_end
    return found


_RECORD = "path string, block long, row long, text binary, opened long, header boolean"


def _joined(lines: list[bytes], crlf: bool) -> bytes:
    """Spark takes the first line's end for the file's, and reads that as a line feed everywhere."""
    text = b"\n".join(lines)
    return (text + b"\n").replace(b"\r\n", b"\n")[:-1] if crlf else text


def _cut(splits: dict[str, dict[int, Split]]):
    """Records of the splits; a piece of one that crosses splits names the split where it was ``opened``."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = [f.split()[0] for f in _RECORD.split(", ")], [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.bool_()]
        out: list[tuple] = []
        for path, block, lines in _chunks(batches):
            split = splits[path].get(block)
            if split is None:
                raise RuntimeError(f"{path} was split in another way while it was read; read it again")
            inside, opened, header = split.inside, split.opened if split.inside else None, block == 0
            pending, begun = [], 0
            for line, row in lines:
                if not pending:
                    begun = row
                pending.append(line)
                inside = ends_inside(line, inside)
                if inside:
                    continue
                text, pending = _joined(pending, split.crlf), []
                if opened is not None or text:
                    if opened is not None or not header:
                        out.append((path, block, begun, text, opened, header and opened is not None))
                    header, opened = False, None
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out = []
            if pending:
                where = block if opened is None else opened
                out.append((path, block, begun, _joined(pending, split.crlf), where, header))
        columns = zip(*out) if out else [[] for _ in types]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return cut


def read_records(spark: SparkSession, paths: list[str], splits: dict[str, dict[int, Split]]) -> DataFrame:
    """(path, block, row, text): the records of files behind their headers, empty lines left out.

    ``splits`` comes from ``find_splits``. Only if a record crosses splits are the files read a second time, for the pieces.
    """
    cut = _lines(spark, paths).mapInArrow(_cut(splits), _RECORD).withColumn("text", F.col("text").cast("string"))
    whole = cut.where(F.col("opened").isNull()).select("path", "block", "row", "text")
    if not any(split.inside for blocks in splits.values() for split in blocks.values()):
        # The last record of a file may never close its quote.
        whole_or_last = cut.where(~F.col("header")).select("path", "block", "row", "text")
        return whole_or_last
    pieces = cut.where(F.col("opened").isNotNull())
    piece = F.sort_array(F.collect_list(F.struct("block", "row", "text", "header"))).alias("pieces")
    joined = pieces.groupBy("path", "opened").agg(piece).where(~F.exists("pieces", lambda p: p["header"]))
    text = F.array_join(F.transform("pieces", lambda p: p["text"]), "\n")
    crossing = joined.select("path", F.col("opened").alias("block"), F.get("pieces", F.lit(0))["row"].alias("row"), text.alias("text"))
    return whole.unionByName(crossing)


def decoded(path: str) -> str:
    """Spark gives the path as part of an address, with special characters encoded."""
    return unquote(path)
