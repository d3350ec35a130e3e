"""CSV files read by byte ranges, also where quoted fields hold newlines.

A newline ends a record unless an odd number of quotes precedes it in the file.  Spark's text source
deals the lines of a file to tasks by byte ranges, so

1. one aggregate counts the quotes of every range (a scan that moves one row per range),
2. a prefix scan over these counts says which ranges begin inside quotes,
3. each range joins its lines to records on its own; what a record has in other ranges (one head and one
   tail per range at most) is stitched by a window over these few rows.

Files where every line holds an even number of quotes have no such newline and go to Spark's own
reader, which splits them by lines.

The driver keeps three numbers per range, as many as Spark's own list of ranges.  A range that the second scan
cuts otherwise than the first (the session's cores changed in between) has no entry and
fails the read; ``spark.sql.files.minPartitionNum`` pins the ranges.

Quotes are expected as CSV writers place them: round a field, and twice inside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD, HEAD, TAIL = 0, 1, 2
PARTS = "file bigint, start bigint, kind int, first boolean, record string"
ARROW = pa.schema([("file", pa.int64()), ("start", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()),
                   ("record", pa.string())])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file (a hash of its path), start (of the range), value: the lines of each range in order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def range_counts(lines: DataFrame) -> DataFrame:
    """One row per range: its quotes, whether a line has an odd number of them, whether a line holds a carriage return inside."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.select("file", "start", quotes.cast("long").alias("n"), F.col("value").rlike(r"\r.").alias("cr")).groupBy(
        "file", "start").agg(F.sum("n").alias("quotes"), F.max(F.col("n") % 2).alias("odd"), F.max("cr").alias("cr"))


def inside_quotes(counts: list[tuple[int, int, int]]) -> dict[tuple[int, int], int]:
    """(file, start) -> 1 for the ranges that begin inside quotes, 0 for the others, from (file, start, quotes)."""
    if not counts:
        return {}
    file, start, quotes = np.array(sorted(counts), np.int64).T
    total = np.cumsum(quotes)
    first = np.append(True, file[1:] != file[:-1])
    before = total - quotes
    before -= np.repeat(before[first], np.diff(np.append(np.flatnonzero(first), len(file))))
    return dict(zip(zip(file.tolist(), start.tolist(), strict=True), (before % 2).tolist(), strict=True))


def _joined(entry: dict[tuple[int, int], int], wanted: tuple[int, ...]):
    """Records, heads and tails of each range (those of the ``wanted`` kinds)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, int] | None = None
        state, held, head, first = 0, [], False, False      # held: lines of the record that is open

        def rows(kind: int, records: list[str], firsts: list[bool]) -> Iterator[pa.RecordBatch]:
            if kind in wanted and records:
                n = len(records)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at[0]] * n, pa.int64()), pa.array([at[1]] * n, pa.int64()), pa.array([kind] * n, pa.int32()),
                     pa.array(firsts, pa.bool_()), pa.array(records, pa.string())], schema=ARROW)

        for batch in batches:
            if not batch.num_rows:
                continue
            file, start = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
            quotes = pc.count_substring(batch.column(2), '"').to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(file)], strict=True):
                here = int(file[a]), int(start[a])
                if here != at:
                    if held:
                        yield from rows(HEAD if head else TAIL, ["\n".join(held)], [first])
                    at = here
                    if at not in entry:
                        raise RuntimeError("the file is cut into other ranges than before: set spark.sql.files.minPartitionNum")
                    state = entry[at]
                    held, head, first = [], bool(state), at[1] == 0
                values = batch.column(2).slice(a, b - a).to_pylist()
                after = (state + np.cumsum(quotes[a:b])) % 2
                state = int(after[-1])
                done, firsts = [], []
                for k, (line, open_) in enumerate(zip(values, after.tolist(), strict=True)):
                    if held or open_ or head:
                        held.append(line)
                        if open_:
                            continue
                        line, held = "\n".join(held), []
                        if head:
                            head = False
                            yield from rows(HEAD, [line], [first])
                            first = False
                            continue
                    done.append(line)
                    firsts.append(first)
                    first = False
                yield from rows(RECORD, done, firsts)
        if held:
            yield from rows(HEAD if head else TAIL, ["\n".join(held)], [first])
    return run


def records(spark: SparkSession, path: str) -> DataFrame | None:
    """first (of its file) and record, one row per record; None where no quoted field holds a line end."""
    lines = _lines(spark, path)
    counts = range_counts(lines).collect()      # one row per range
    if not any(r["odd"] or r["cr"] for r in counts):
        return None
    entry = inside_quotes([(r["file"], r["start"], r["quotes"]) for r in counts])
    whole = lines.mapInArrow(_joined(entry, (RECORD,)), PARTS).select("first", "record")
    if not any(entry.values()):
        return whole
    parts = lines.mapInArrow(_joined(entry, (HEAD, TAIL)), PARTS)
    order = Window.partitionBy("file").orderBy("start", "kind")     # one head and one tail per range at most
    grouped = parts.withColumn("group", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(order))
    stitched = grouped.groupBy("file", "group").agg(
        F.max("first").alias("first"), F.sort_array(F.collect_list(F.struct("start", "kind", "record"))).alias("parts")).select(
        "first", F.array_join(F.col("parts.record"), "\n").alias("record"))
    return whole.unionByName(stitched)


def parsed(found: DataFrame, schema: T.StructType, options: dict) -> DataFrame:
    """The columns of ``schema`` from records; each file's first record must be the header."""
    record = F.regexp_replace(F.col("record"), r"\r$", "")
    record = F.when(F.col("first"), F.regexp_replace(record, "^﻿", "")).otherwise(record)
    rows = found.select("first", record.alias("record")).filter(F.col("record") != "")
    names = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(schema))])
    header = F.from_csv("record", names.simpleString()[7:-1].replace(":", " "), options)
    same = F.array(*[header[f"c{k}"] for k in range(len(schema))]) == F.array(*[F.lit(f.name) for f in schema])
    checked = rows.filter(F.when(~F.col("first"), True).when(same, False).otherwise(
        F.raise_error(F.concat(F.lit("CSV header does not match the schema: "), "record")).cast("boolean")))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return checked.select(F.from_csv("record", ddl, options).alias("r")).select("r.*")
