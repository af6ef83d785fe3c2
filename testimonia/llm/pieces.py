"""Splitting oversized items at natural boundaries.

Cuts do not depend on each other: cut k lies in the window of ``slack`` characters that ends at k * stride, at the best
natural boundary there. An item is worked on by ranges. A range needs itself and two halos, of ``slack + overlap``
characters before it and ``stride`` after it: with them it finds the boundaries of the windows that end in it and the one
after, and emits the pieces that begin at its own cuts. Ranges are told apart by their offsets alone, which prefix sums of
their lengths give, so any number of tasks work on one item and no table of an item's cuts is ever put in order.

Files are read by byte ranges, twice: once for the lengths in characters, once with halos for the pieces. No task holds
a file. The text of a table row is in memory already; its ranges are slices of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from testimonia.sources.shared import shared_dir, written
from testimonia.sources.tables import table

MAX_CHARS, OVERLAP, SLACK = 1800, 150, 450
#: Characters of a row's text, and bytes of a file, in one range.
RANGE_CHARS, RANGE_BYTES = 1 << 16, 8 << 20
_S = r"[ \t\n\x0b\f\r]"
# Boundaries from the best to the least; the cut comes after what is matched.
BOUNDARIES = [rf"(?s)(.*\n{_S}*\n)", r"(?s)(.*\n)(?=[\p{Lu} .'-]{3,40}:)", rf"(?s)(.*[.?!…][\"'”’)]*{_S}+)", r"(?s)(.*\n)", rf"(?s)(.*[,;:—–]{_S}+)", rf"(?s)(.*{_S})"]


def stride_of(max_chars: int, overlap: int, slack: int) -> int:
    stride = max_chars - overlap - slack
    if overlap < 0 or slack < 0 or stride <= slack:
        raise ValueError("max_chars must exceed overlap + 2 * slack")
    return stride


class Cutter:
    """Cuts and pieces of items by their ranges."""

    def __init__(self, max_chars: int, overlap: int, slack: int) -> None:
        import regex

        self.max_chars, self.overlap, self.slack = max_chars, overlap, slack
        self.stride = stride_of(max_chars, overlap, slack)
        self.before, self.after = slack + overlap + self.stride, self.stride
        self.boundaries = [regex.compile(b) for b in BOUNDARIES]

    def n_cuts(self, total: int) -> int:
        """Windows end at stride, 2 * stride, ... before the end: what follows the last cut, with its overlap, fits too."""
        return -(-total // self.stride) - 1 if total > self.max_chars else 0

    def cut(self, text: str, base: int, k: int) -> int:
        """The place of cut k in the item; ``text`` begins at ``base`` and holds its window."""
        start = k * self.stride - self.slack
        window = text[start - base : start - base + self.slack]
        for b in self.boundaries:
            if m := b.match(window):
                return start + m.end(1)
        return start + len(window)

    def pieces(self, text: str, base: int, start: int, end: int, total: int) -> Iterator[tuple[int, int, str]]:
        """(piece_no, piece_start, piece) of the pieces whose window ends in [start, end); ``text``, from ``base``, is the range with its halos."""
        n = self.n_cuts(total)
        first = 0 if start == 0 else -(-start // self.stride)
        last = min(n, -(-end // self.stride) - 1 if end < total else n)
        here = 0 if first == 0 else self.cut(text, base, first) if first <= last else 0
        for k in range(first, last + 1):
            to = self.cut(text, base, k + 1) if k < n else total
            at = max(0, here - self.overlap) if k else 0
            yield k, at, text[at - base : to - base]
            here = to


def split_items(items: DataFrame, max_chars: int = MAX_CHARS, overlap: int = OVERLAP, slack: int = SLACK, text: str = "text", range_chars: int = RANGE_CHARS) -> DataFrame:
    """Rows of ``items`` as pieces of at most ``max_chars`` code points: piece_no, n_pieces, piece_start, piece (and the columns of ``items``).

    A text of at most ``max_chars`` is one piece. Of a longer one, each piece but the first begins with the last
    ``overlap`` characters of the piece before it; the pieces without their overlaps join to the text. A null text gives
    one null piece, an empty one an empty piece. Columns of ``items`` of the names given here are replaced.
    """
    stride_of(max_chars, overlap, slack)
    own = [c for c in items.columns if c not in ("piece_no", "n_pieces", "piece_start", "piece")]
    items = items.select(*own)
    at_text = own.index(text)
    schema = T.StructType([*items.schema.fields, *(T.StructField(c, T.IntegerType()) for c in ("piece_no", "n_pieces", "piece_start")), T.StructField("piece", T.StringType())])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(max_chars, overlap, slack)
        for b in batches:
            rows, nos, counts, starts, out = [], [], [], [], []
            for i, t in enumerate(b.column(at_text).to_pylist()):
                total = len(t or "")
                n = cutter.n_cuts(total) + 1
                for s in range(0, max(1, total), range_chars):
                    base = max(0, s - cutter.before)
                    end = min(total, s + range_chars)
                    for k, a, piece in cutter.pieces((t or "")[base : end + cutter.after], base, s, end, total):
                        rows.append(i)
                        nos.append(k)
                        counts.append(n)
                        starts.append(a)
                        out.append(None if t is None else piece)
            kept = b.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(nos, pa.int32()), pa.array(counts, pa.int32()), pa.array(starts, pa.int32()), pa.array(out, pa.string())], names)

    return items.mapInArrow(run, schema)


def _file_ranges(batches: Iterator[pa.RecordBatch], range_bytes: int) -> Iterator[pa.RecordBatch]:
    """(path, size) to the byte ranges of each file."""
    for b in batches:
        for r in b.to_pylist():
            starts = list(range(0, r["size"], range_bytes)) or [0]
            n = len(starts)
            yield pa.RecordBatch.from_arrays([pa.array([r["path"]] * n), pa.array(range(n), pa.int64()), pa.array(starts, pa.int64()), pa.array([min(range_bytes, r["size"] - s) for s in starts], pa.int64())], ["path", "range_no", "byte_start", "n_bytes"])


def _read_range(path: str, start: int, n: int) -> bytes:
    from pyarrow import fs

    files, at = fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))
    with files.open_input_file(at) as f:
        f.seek(max(0, start))
        return f.read(n)


def _body(path: str, start: int, n: int) -> str:
    """The characters that begin inside the byte range."""
    raw = _read_range(path, start, n + 3)
    a = 0
    while a < len(raw) and raw[a] & 0xC0 == 0x80 and start > 0:
        a += 1
    b = min(n, len(raw))
    while b < len(raw) and raw[b] & 0xC0 == 0x80:
        b += 1
    return raw[a:b].decode("utf-8", "replace")


def _range_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lengths = [len(_body(r["path"], r["byte_start"], r["n_bytes"])) for r in b.to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lengths, pa.int64())], [*b.schema.names, "n_chars"])


def with_offsets(ranges: DataFrame, block: int = 4096) -> DataFrame:
    """Adds start and total (in characters) to the ranges of each file by prefix sums of n_chars.

    Sums run inside blocks of ``block`` ranges, and one row per block carries them on, so that the ranges of a giant file
    are not in one task: with ranges of 8 MB a block is 32 GB of a file.
    """
    ranges = ranges.withColumn("_b", F.floor(F.col("range_no") / block))
    sums = ranges.groupBy("path", "_b").agg(F.sum("n_chars").alias("_s"))
    over = Window.partitionBy("path").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("path", "_b", F.coalesce(F.sum("_s").over(over), F.lit(0).cast("long")).alias("_before"), F.sum("_s").over(Window.partitionBy("path")).alias("total"))
    inside = Window.partitionBy("path", "_b").orderBy("range_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.sum("n_chars").over(inside) - F.col("n_chars")
    return ranges.withColumn("_own", own).join(sums, ["path", "_b"]).withColumn("start", F.col("_before") + F.col("_own")).drop("_b", "_before", "_own")


def split_files(spark: SparkSession, paths: DataFrame, max_chars: int = MAX_CHARS, overlap: int = OVERLAP, slack: int = SLACK, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """UTF-8 files cut as :func:`split_items` cuts a text, without reading a whole file in any task.

    ``paths``: path string (an URI or absolute path), size long. Gives path, piece_no, piece_start, piece. Bytes that
    are no UTF-8 come out as the replacement sign. An empty file gives one empty piece.
    """
    stride_of(max_chars, overlap, slack)
    step = "path string, range_no long, byte_start long, n_bytes long"
    ranges = paths.select("path", F.col("size").cast("long").alias("size")).mapInArrow(lambda it: _file_ranges(it, range_bytes), step)
    ranges = written(ranges.repartition("path", "range_no").mapInArrow(_range_lengths, step + ", n_chars long"), "ranges")  # a few bytes for each range

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(max_chars, overlap, slack)
        for b in batches:
            for r in b.to_pylist():
                at, n, start = r["byte_start"], r["n_bytes"], r["start"]
                begin = max(0, at - 4 * cutter.before)
                head = _body(r["path"], begin, at - begin)[-cutter.before :] if at else ""
                body, tail = _body(r["path"], at, n), _body(r["path"], at + n, 4 * cutter.after)[: cutter.after]
                out = list(cutter.pieces(head + body + tail, start - len(head), start, start + len(body), r["total"]))
                if out:
                    no, first, piece = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array([r["path"]] * len(out)), pa.array(no, pa.int64()), pa.array(first, pa.int64()), pa.array(piece, pa.string())], ["path", "piece_no", "piece_start", "piece"])

    return with_offsets(ranges).repartition("path", "range_no").mapInArrow(run, "path string, piece_no long, piece_start long, piece string")


def _chunks(spark: SparkSession, directory: str, *columns: str) -> DataFrame:
    return table(spark, directory, "chunks").select("chunk_id", "text", *columns)


def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    return split_items(_chunks(spark, directory)).where("n_pieces > 1 and piece_no = 0").select("chunk_id").distinct()


def p3_pieces(spark: SparkSession, directory: str) -> DataFrame:
    """The pieces of every chunk, with its pages and turns, and how many turns begin in the piece itself; a chunk delivered twice comes out once."""
    c = _chunks(spark, directory, "page_start", "page_end", "n_turns").distinct()
    p = split_items(c).withColumn("own", F.when(F.col("piece_no") > 0, F.expr(f"substr(piece, {OVERLAP + 1})")).otherwise(F.col("piece")))
    begun = F.regexp_count("own", F.lit(r"(?m)^[\p{Lu}][\p{Lu} .'-]{2,60}:"))
    return p.select("chunk_id", "piece_no", "n_pieces", "piece_start", "page_start", "page_end", "n_turns", begun.alias("turns_begun"), F.length("piece").alias("n_chars"), F.col("piece").alias("text"))


def p3_file_pieces(spark: SparkSession, directory: str) -> DataFrame:
    """All texts of ``documents``, written as plain text files of one commission's corpus dump, cut by byte ranges."""
    import uuid

    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    table(spark, directory, "documents").where("text is not null").select("text").write.text(folder)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).select("path", F.col("length").alias("size"))
    return split_files(spark, files, range_bytes=1 << 20).select(F.sha2("path", 256).alias("file"), "piece_no", "piece_start", F.length("piece").alias("n_chars"), F.xxhash64("piece").alias("print"))
