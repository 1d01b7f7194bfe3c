"""Wide panel CSV source, read per header group.

Spark maps CSV columns by *position* against one schema, so files whose
headers differ must never be read together (February's values would land
under January). The reader lists the files, peeks at each header on the
driver, groups files with identical headers and issues one all-string read
per group; the groups are aligned by name with ``unionByName``.

All cells are read as text: ZIP ``00501`` keeps its zeros and bad numbers
are coerced later (``to_double``) instead of failing the read. The quote
escape is ``"`` (RFC 4180 doubled quotes). NA tokens become NULL in id
columns; ``RegionID`` is cast to bigint.
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import na_to_null
from ..operators.reshape import bq, is_date_header, normalize_header_date
from . import files

BAD = "__bad_record"
CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
CSV_WRITE_OPTIONS = {"header": "true", "escape": '"', "quote": '"', "nullValue": ""}


#: Files of more than this many splits are cut by split_records.
SPLIT_FROM = 4
#: Compressed files have one split, and their size says little.
PACKED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")


def parse_header(line: str) -> list[str]:
    """Header names; a blank name becomes ``_c<i>`` (Spark's convention), an
    id column since it does not start with a digit."""
    return [name if name else f"_c{i}" for i, name in enumerate(next(csv.reader([line])))]


def header_groups(spark: SparkSession, path: str, threads: int = 16) -> tuple[dict[tuple[str, ...], list[str]], dict[str, int]]:
    """Files grouped by header (the first line that is not blank), and each file's
    size in bytes. Header peeks are I/O-bound and run on a small driver thread
    pool when there are many files."""
    listed = [(p, size) for p, size, _mtime in files.list_files(spark, path) if size > 0]
    if len(listed) > 4:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=threads) as pool:
            lines = list(pool.map(lambda ps: files.first_line(spark, ps[0]), listed))
    else:
        lines = [files.first_line(spark, p) for p, _size in listed]
    groups: dict[tuple[str, ...], list[str]] = {}
    for (p, _size), line in zip(listed, lines):
        if line is not None:
            groups.setdefault(tuple(parse_header(line)), []).append(p)
    return groups, dict(listed)


def _check_header(header: tuple[str, ...], source: str) -> None:
    seen = set()
    for name in header:
        if name in seen:
            raise ValueError(f"duplicate column {name!r} in {source}")
        seen.add(name)
        if is_date_header(name):
            normalize_header_date(name)  # raises on a malformed month header


def _sound(header: tuple[str, ...], source: str, multi_line: bool):
    """True, or an error for a record that must not be shortened or split.

    Spark keeps the text of a record whose field count is not the header's.
    Fewer fields are missing cells (NULL). Surplus fields, and without
    ``multi_line`` a quote left open at the end of a line, raise.
    """
    fields = F.regexp_count(F.regexp_replace(F.col(BAD), '"[^"]*"', ""), F.lit(",")) + 1
    faulty = fields > len(header)
    if not multi_line:
        faulty = faulty | (F.pmod(F.regexp_count(F.col(BAD), F.lit('"')), F.lit(2)) == 1)
    # names a data column too: Spark refuses a scan that needs the record's text only
    what = F.concat(F.lit(f"malformed record under the {len(header)} columns of {source}, first field "),
                    F.coalesce(F.col(bq(header[0])), F.lit("")), F.lit(": "), F.col(BAD))
    return F.when(F.col(BAD).isNotNull() & faulty, F.raise_error(what).cast("boolean")).otherwise(F.lit(True))


def read_group(spark: SparkSession, header: tuple[str, ...], paths: list[str],
               source_col: str | None = None, multi_line: bool = True, splittable: bool = False) -> DataFrame:
    """One all-string read of files sharing ``header``; id columns cleaned,
    months in calendar order, optionally the source file as ``source_col``."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, BAD)])
    if splittable:
        records = split_records(spark, paths)
        options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
        parsed = F.from_csv("record", _ddl(schema), {**options, "multiLine": "true"})
        df = records.select("file", parsed.alias("r")).select("r.*", F.col("file").alias(FILE))
    else:
        df = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).schema(schema).csv(paths)
    df = df.where(_sound(header, paths[0], multi_line or splittable))
    ids = [c for c in header if not is_date_header(c)]
    months = sorted((c for c in header if is_date_header(c)), key=normalize_header_date)
    fixed = {}
    for c in ids:
        v = na_to_null(c)
        if c in ("RegionID", "SizeRank"):
            v = F.trim(v).try_cast("bigint")
        fixed[c] = v
    if source_col:
        fixed[source_col] = F.col(FILE) if splittable else F.col("_metadata.file_path")
    # one call each: cleaned id columns, then ids + months in calendar order as SQL text
    order = ids + ([source_col] if source_col else []) + months
    return df.withColumns(fixed).selectExpr(*[bq(c) for c in order])


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{bq(f.name)} STRING" for f in schema.fields)


FILE = "__file"
#: Kinds of pieces that a split yields: a whole record; the rest of a record begun in an earlier split; the beginning of
#: one that ends in a later split; a split that lies within one record.
WHOLE, HEAD, TAIL, WITHIN = range(4)


def split_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, record): the records of CSV files with one header line, a file read by as many tasks as it has splits.

    A line break ends a record unless it is quoted, that is if the number of
    quotes before it in the file is even (doubled quotes count twice). One
    pass counts the quotes of each split; the running sum over a file's
    splits tells which splits begin within quotes. A second pass then cuts
    each split's lines into records on its own, without a shuffle; only the
    pieces of records that cross a split, at most two a split, are brought
    together. Header lines and blank lines are left out. An uneven number of
    quotes in a file raises. Line breaks are LF, or CR LF in a file whose
    first line ends so; within quotes, too, the latter become LF, as in
    Spark's multi-line read.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    counted = lines.groupBy("file", "block").agg(F.sum(F.regexp_count("value", F.lit('"'))).alias("quotes"),
                                                 F.first("value").endswith("\r").alias("cr"))  # a split's lines are in one task
    running = Window.partitionBy("file").orderBy("block")
    states = counted.select("file", "block", (F.col("cr") & (F.col("block") == 0)).alias("crlf"), F.pmod(F.sum("quotes").over(running), F.lit(2)).alias("after"),
                            F.pmod(F.sum("quotes").over(running) - F.col("quotes"), F.lit(2)).alias("before"),
                            F.lead("block").over(running).isNull().alias("last"))
    odd = states.where("before = 1 OR crlf OR (last AND after = 1)").collect()  # splits that begin, files that end within quotes
    for r in odd:
        if r["last"] and r["after"]:
            raise ValueError(f"malformed record: {r['file']} ends within quotes")
    begins_open = {(r["file"], r["block"]) for r in odd if r["before"]}
    crlf = {r["file"] for r in odd if r["crlf"]}
    whole, head, tail, within = WHOLE, HEAD, TAIL, WITHIN

    def cut(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["kind", "file", "block", "record"]
        at, held, state, opened, header = None, [], 0, False, False

        def rows(kinds, texts):
            n = len(texts)
            return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array([at[0]] * n, pa.string()),
                                               pa.array([at[1]] * n, pa.int64()), pa.array(texts, pa.string())], names=names)

        def done():
            if held:  # what the split leaves open
                yield rows([within if opened else tail], ["\n".join(held)])

        for batch in batches:
            file, block, value = batch.columns
            if not batch.num_rows:
                continue
            blocks = block.to_numpy()
            files_ = file.dictionary_encode()
            key = np.stack([files_.indices.to_numpy(), blocks])
            cuts = [0, *(np.flatnonzero((np.diff(key, axis=1) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                here = (file[lo].as_py(), int(blocks[lo]))
                if here != at:
                    yield from done()
                    at, held = here, []
                    state = int(at in begins_open)
                    opened, header = bool(state), at[1] == 0
                text = value.slice(lo, hi - lo)
                quotes = pc.count_substring(text, '"').to_numpy(zero_copy_only=False).astype(np.int64)
                after = (state + np.cumsum(quotes)) % 2
                ends = np.flatnonzero(after == 0)
                state = int(after[-1])
                kinds, texts, start = [], [], 0
                if not held and not opened and len(ends) == hi - lo:  # no open quote: lines are records
                    texts = text.to_pylist()
                    kinds = [whole] * len(texts)
                else:
                    every = text.to_pylist()
                    for e in ends.tolist():
                        texts.append("\n".join([*held, *every[start : e + 1]]))
                        kinds.append(head if opened else whole)
                        held, start, opened = [], e + 1, False
                    held += every[start:]
                kept = []
                for kind, record in zip(kinds, texts):
                    if kind == whole:
                        record = record.removesuffix("\r").replace("\r\n", "\n") if at[0] in crlf else record
                        if header and record.lstrip("\ufeff").strip():
                            header = False
                            continue
                        if not record:
                            continue
                    kept.append((kind, record))
                if kept:
                    yield rows(*map(list, zip(*kept)))
        if at is not None:
            yield from done()

    pieces = lines.mapInArrow(cut, "kind int, file string, block long, record string")
    if not begins_open:  # no split begins within quotes, so none has a piece of a record
        return pieces.select("file", "record")
    broken = pieces.where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("block", "kind")
    numbered = broken.withColumn("n", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "kind", "record")))
    mended = numbered.groupBy("file", "n").agg(F.array_join(F.transform(parts, lambda x: x["record"]), "\n").alias("record"))
    lf = F.regexp_replace(F.regexp_replace("record", r"\r\n", "\n"), r"\r$", "")
    joined = mended.select("file", F.when(F.col("file").isin(list(crlf)), lf).otherwise(F.col("record")).alias("record"))
    return pieces.where(F.col("kind") == WHOLE).select("file", "record").unionByName(joined)


def read_wide_csv(spark: SparkSession, path: str, source_col: str | None = None,
                  multi_line: bool = True, splittable: bool | None = None) -> DataFrame | None:
    """One wide panel (file, folder or glob); None for an empty variant: no file,
    no month column, or no data row (Spark looks for one; size says nothing).
    Files with one header are read by one scan; groups align by name.

    With ``multi_line`` a quoted name may hold line breaks. Spark's own
    multi-line read makes a file one task; files above ``SPLIT_FROM`` splits
    (or all, or none, by ``splittable``) are cut by :func:`split_records`
    instead, so that a large file is read by several tasks. Without
    ``multi_line`` a record that has a line break raises instead of falling
    apart.
    """
    groups, sizes = header_groups(spark, path)
    size = sum(sizes.values())
    at_once = int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b")) if splittable is None else 0
    if not any(is_date_header(c) for header in groups for c in header):
        return None
    frames = []
    for header, paths in groups.items():
        _check_header(header, paths[0])
        split = {p for p in paths if multi_line and not p.endswith(PACKED) and (splittable or at_once and sizes[p] > SPLIT_FROM * at_once)}
        for some, cut in ((sorted(split), True), ([p for p in paths if p not in split], False)):
            if some:
                frames.append(read_group(spark, header, some, source_col, multi_line, cut))
    df = frames[0]
    if len(frames) > 1:
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        ids = [c for c in df.columns if not is_date_header(c)]
        months = sorted((c for c in df.columns if is_date_header(c)), key=normalize_header_date)
        df = df.selectExpr(*[bq(c) for c in ids + months])
    if df.isEmpty():
        return None
    if not any(p.endswith(PACKED) for p in sizes):
        df.landed_bytes = size  # for the choice of a join: what the planner cannot know
    return df
