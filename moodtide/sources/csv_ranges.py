"""Quoted multi-line CSV read by byte ranges, so that one big file is many tasks.

A line break ends a record only outside quotes, and whether a byte is inside quotes depends on everything
before it. So the file is read twice. First each range tells, for every state it may begin in, the state it
ends in; these small tables are put together along the file. Then each range knows its own first state,
finds its first record border and reads every record that begins in it, the last one beyond its end.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.session import durable, ship_package
from moodtide.sources.csv import _QUOTING
from moodtide.sources.files import arrow_file_system

#: Bytes of a range. A task holds one range and its last record in memory.
RANGE_BYTES = 32 << 20
_MORE_BYTES = 1 << 20
_BATCH_BYTES = 8 << 20

# Where a range may begin: before a record, before a field, in a plain field, in quotes, after a quote in quotes.
RECORD, FIELD, PLAIN, QUOTED, AFTER = STATES = "RFPQA"

_CLOSED = rb'[^"]*+(?:""[^"]*+)*+"[^,\n]*+'  # the rest of a quoted field; what follows its last quote is still of it
_FIELD = rb'(?:"' + _CLOSED + rb'|[^",\n][^,\n]*+|)'
_REST = rb"(?:," + _FIELD + rb")*+\n"
_ONE_RECORD = re.compile(_FIELD + _REST)
_FIELDS = re.compile(rb"(?:" + _FIELD + rb"[,\n])*+")
_IN_QUOTES = re.compile(rb'[^"]*+(?:""[^"]*+)*+')
_IN_PLAIN = re.compile(rb"[^,\n]*+")
_TO_BORDER = {
    FIELD: _ONE_RECORD, PLAIN: re.compile(rb"[^,\n]*+" + _REST), QUOTED: re.compile(_CLOSED + _REST),
}


def end_state(data: bytes, state: str, at: int = 0) -> str:
    """The state after ``data[at:]``, begun in ``state``."""
    if at == len(data):
        return state
    if state == AFTER:
        return end_state(data, QUOTED, at + 1) if data[at] == 0x22 else end_state(data, PLAIN, at)
    if state == QUOTED:
        at = _IN_QUOTES.match(data, at).end()
        if at == len(data):
            return QUOTED
        if at + 1 == len(data):
            return AFTER
        at, state = at + 1, PLAIN
    if state == PLAIN:
        at = _IN_PLAIN.match(data, at).end()
        if at == len(data):
            return PLAIN
        at += 1
    at = _FIELDS.match(data, at).end()
    if at == len(data):
        return RECORD if data[-1:] == b"\n" else FIELD
    return end_state(data, QUOTED, at + 1) if data[at] == 0x22 else PLAIN


def end_states(data: bytes) -> str:
    """The end state for each of ``STATES`` as the first one. Two or three passes over the range give all five."""
    plain, quoted = end_state(data, PLAIN), end_state(data, QUOTED)
    after = end_state(data, QUOTED, 1) if data[:1] == b'"' else plain
    return after + after + plain + quoted + after


def first_record(data: bytes, state: str) -> int:
    """Where the first record that begins in ``data`` begins; its length if none does."""
    at = 0
    if state == RECORD:
        return 0
    if state == AFTER:
        state, at = (QUOTED, 1) if data[:1] == b'"' else (PLAIN, 0)
    found = _TO_BORDER[state].match(data, at)
    return found.end() if found else len(data)


def range_records(data: bytes, state: str, more: Callable[[int, int], bytes]) -> Iterator[bytes]:
    """The records that begin in the range, without their line ends; empty lines are none.

    ``more(offset, n)`` reads up to ``n`` bytes at an offset from the range's first byte, none at the end of the
    file. A quote that is never closed takes the rest of the file into its record.
    """
    own, at, step = len(data), first_record(data, state), _MORE_BYTES
    while at < own:
        found = _ONE_RECORD.match(data, at)
        if found:
            end = found.end()
            record = data[at : end - 1].removesuffix(b"\r")
        elif block := more(len(data), step):
            data, step = data + block, step * 2
            continue
        else:
            end = len(data)
            record = data[at:]
        if record:
            yield record
        at = end


def _states_of(batches):
    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            filesystem, path = arrow_file_system(row["path"])
            with filesystem.open_input_file(path) as file:
                data = file.read_at(row["end"] - row["start"], row["start"])
            blank = not data.strip(b"\r\n")
            yield pa.RecordBatch.from_pylist([{**row, "ends": end_states(data), "blank": blank}], _STATE_SCHEMA())


def _STATE_SCHEMA():
    import pyarrow as pa

    return pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("ends", pa.string()), ("blank", pa.bool_())])


def _chain(ranges):
    """First states of one file's ranges: a walk along as many short rows as the file has ranges."""
    ranges = ranges.sort_values("start")
    state, begun, states, headed = RECORD, False, [], []
    for ends, blank in zip(ranges["ends"], ranges["blank"]):
        states.append(state)
        headed.append(not begun and not blank)
        begun = begun or not blank
        state = ends[STATES.index(state)]
    return ranges[["path", "start", "end"]].assign(state=states, headed=headed)


def _records_of(encoding: str, header: bool):
    def read(batches):
        import pyarrow as pa

        def batch_of(path, start, first, values):
            n = len(values)
            columns = [
                pa.array([path] * n, pa.string()), pa.array([start] * n, pa.int64()),
                pa.array(range(first, first + n), pa.int64()), pa.array(values, pa.string()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["src_file", "src_block", "src_row", "value"])

        for batch in batches:
            for row in batch.to_pylist():
                start = row["start"]
                filesystem, path = arrow_file_system(row["path"])
                with filesystem.open_input_file(path) as file:
                    data = file.read_at(row["end"] - start, start)
                    records = range_records(data, row["state"], lambda offset, n: file.read_at(n, start + offset))
                    if header and row["headed"]:
                        next(records, None)
                    first, size, values = 0, 0, []
                    for record in records:
                        values.append(record.decode(encoding, "replace"))
                        size += len(record)
                        if size >= _BATCH_BYTES:
                            yield batch_of(row["path"], start, first, values)
                            first, size, values = first + len(values), 0, []
                    if values:
                        yield batch_of(row["path"], start, first, values)

    return read


def scan_csv_records(
    spark: SparkSession, path: str | list[str], glob: str = "*.csv", range_bytes: int = RANGE_BYTES,
    encoding: str = "utf-8", header: bool = True,
) -> DataFrame:
    """The records of uncompressed CSV files as text (``value``) with the file-order columns of ``scan_lines``.

    Records end with ``\\n`` or ``\\r\\n`` outside quotes; a quote is doubled inside quotes, and one in the middle of
    a plain field is an ordinary character. Each file's first record is left out with ``header``. Empty files have
    no records. Any encoding will do that keeps ASCII bytes to themselves.
    """
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length")
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint")))
    ranges = durable(
        files.filter(F.col("length") > 0).select("path", "length", starts.alias("start"))
        .select("path", "start", F.least(F.col("start") + range_bytes, "length").alias("end"))
    )
    tasks = max(1, ranges.count())
    scanned = ranges.repartition(tasks).mapInArrow(
        _states_of, "path string, start bigint, end bigint, ends string, blank boolean"
    )
    chained = scanned.groupBy("path").applyInPandas(
        _chain, "path string, start bigint, end bigint, state string, headed boolean"
    )
    return durable(chained).repartition(tasks).mapInArrow(
        _records_of(encoding, header), "src_file string, src_block bigint, src_row bigint, value string"
    )


def scan_csv_ranges(
    spark: SparkSession, path: str | list[str], schema: str, glob: str = "*.csv", range_bytes: int = RANGE_BYTES,
    encoding: str = "utf-8", header: bool = True,
) -> DataFrame:
    """``scan_csv`` for big files: the same rows, a task per range instead of one per file, and the file-order columns."""
    records = scan_csv_records(spark, path, glob, range_bytes, encoding, header)
    options = {**_QUOTING, "multiLine": "true", "lineSep": "\n"}
    parsed = records.withColumn("_r", F.from_csv("value", schema, options))
    return parsed.select("_r.*", "src_file", "src_block", "src_row")
