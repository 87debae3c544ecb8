"""Documents into pages, texts into line blocks, ordered tables into row blocks."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions.text import block_label, py_strip
from folioflow.session import written

PAGE_BREAK = "\f"
BLOCK_ROWS = 20


def explode_pages(df: DataFrame, text: str = "text", sep: str = PAGE_BREAK) -> DataFrame:
    """One row per page: 1-based ``page_num`` and the trimmed ``page_text``. No shuffle."""
    kept = [c for c in df.columns if c != text]
    pages = F.split(F.col(text), re.escape(sep))
    return df.select(*kept, F.posexplode(pages).alias("_pos", "_page")).select(
        *kept, (F.col("_pos") + 1).alias("page_num"), py_strip(F.col("_page")).alias("page_text")
    )


def blocks_of(lines: Column, n: int = BLOCK_ROWS) -> Column:
    """Blocks of ``n`` of an array of lines. The array must be a column of its own: an expression
    would be worked out again for each block."""
    starts = F.sequence(F.lit(1), F.size(lines), F.lit(n))
    return F.transform(starts, lambda i: F.array_join(F.slice(lines, i, n), "\n"))


def line_blocks(df: DataFrame, text: str = "text", n: int = BLOCK_ROWS) -> DataFrame:
    """Pages of ``n`` lines for texts without page breaks. Cut inside the row, no shuffle."""
    kept = [c for c in df.columns if c != text]
    lines = df.select(*kept, F.split(F.col(text), "\n").alias("_lines"))
    return lines.select(*kept, F.posexplode(blocks_of(F.col("_lines"), n)).alias("_pos", "_block")).select(
        *kept, (F.col("_pos") + 1).alias("page_num"), F.col("_block").alias("page_text")
    )


def render_row(columns: list[str], sep: str = "\t") -> Column:
    """Cells as text, empty where null."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def drop_blank_blocks(blocks: DataFrame, text: str = "text") -> DataFrame:
    return blocks.filter(py_strip(F.col(text)) != "")


def row_blocks(
    df: DataFrame,
    part: str,
    order: list[str],
    cells: list[str],
    n: int = BLOCK_ROWS,
    clip: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Blocks of ``n`` rows per sheet: ``part, block, first_row, last_row, label, text``.

    ``cells`` are the columns shown. The rows are put in order by range, in one shuffle, and a task streams its range
    into runs of lines. A sheet that began in earlier ranges goes on where those stop, one number a range; the blocks
    are then cut out of the runs, and only those that lie across two runs are put together. Rows that tie on
    ``order`` stand by a hash, so that neither a hot sheet nor a hot value has to share a range.
    """
    # Cells are rendered behind the shuffle: the rows go through here twice, once to sample the ranges.
    by, shown = {f"_by{i}": c for i, c in enumerate(order)}, {f"_cell{i}": c for i, c in enumerate(cells)}
    raw = df.select(F.col(part).alias("sheet"), *[F.col(c).alias(k) for k, c in (by | shown).items()])
    keys = ["sheet", *by, "_hash", "_tie"]
    tied = raw.withColumns({"_hash": F.xxhash64(*raw.columns), "_tie": F.monotonically_increasing_id()})
    ranged = tied.repartitionByRange(slices, *keys) if slices else tied.repartitionByRange(*keys)
    ordered = ranged.sortWithinPartitions(*keys).select("sheet", render_row([*shown]).alias("_text"))
    schema = T.StructType([T.StructField(name, kind or df.schema[part].dataType) for name, kind in RUN_FIELDS.items()])
    streamed = written(ordered.mapInArrow(lambda batches: runs_of_lines(batches, n), schema), "runs")

    told = streamed.filter("one_sheet IS NOT NULL").select("range_no", "first_sheet", "sheet", "one_sheet", "n_rows")
    bases = df.sparkSession.createDataFrame(range_bases(told.collect()), "range_no int, base bigint")
    lines = streamed.filter("one_sheet IS NULL").join(F.broadcast(bases), "range_no")
    start = F.when(F.col("is_first"), F.coalesce("base", F.lit(0))).otherwise(0) + F.col("seq")
    numbered = lines.select("sheet", "lines", "ends", start.alias("start"), (start + F.size("lines")).alias("stop"))
    cut = numbered.select("*", F.explode(F.expr(f"sequence(start div {n}, (stop - 1) div {n})")).alias("block"))
    first, last = F.greatest("start", F.col("block") * n), F.least("stop", (F.col("block") + 1) * n)
    text = F.array_join(F.slice("lines", (first - F.col("start") + 1).cast("int"), (last - first).cast("int")), "\n")
    pieces = cut.select("sheet", "block", first.alias("first"), last.alias("last_row"), text.alias("text"), ((last == F.col("stop")) & F.col("ends")).alias("ends"))
    is_whole = (F.col("first") == F.col("block") * n) & ((F.col("last_row") == (F.col("block") + 1) * n) | F.col("ends"))
    # At most two pieces a run are left.
    stitched = pieces.filter(~is_whole).groupBy("sheet", "block").agg(F.array_sort(F.collect_list(F.struct("first", "text"))).alias("held"), F.max("last_row").alias("last_row"))
    joined = F.array_join(F.transform("held", lambda x: x["text"]), "\n").alias("text")
    blocks = pieces.filter(is_whole).select("sheet", "block", "last_row", "text").unionByName(stitched.select("sheet", "block", "last_row", joined))
    top = F.col("block") * n
    return blocks.select(F.col("sheet").alias(part), "block", (top + 1).alias("first_row"), "last_row", block_label(top, n, F.col("last_row"), clip).alias("label"), "text")


# A run is ``lines`` of one sheet from its ``seq``-th row in the range on; ``ends`` says that the sheet ends with it. One
# row a range has no lines: it names the first and last sheet and the last one's rows there. None is the sheet's type.
RUN_FIELDS = {
    "sheet": None, "first_sheet": None, "range_no": T.IntegerType(), "is_first": T.BooleanType(), "ends": T.BooleanType(), "seq": T.LongType(),
    "lines": T.ArrayType(T.StringType()), "one_sheet": T.BooleanType(), "n_rows": T.LongType(),
}
# Blocks of a run.
RUN_BLOCKS = 200


def runs_of_lines(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Runs of the lines of a range, which come in order, cut at multiples of ``n`` rows from the sheet's first here."""
    range_no, size = TaskContext.get().partitionId(), n * RUN_BLOCKS
    sheet, held, seq, sheets, first_sheet, schema = None, [], 0, 0, None, None

    def run(lines: list[str], ends: bool) -> dict:
        return {"sheet": sheet, "range_no": range_no, "is_first": sheets == 1, "ends": ends, "seq": seq, "lines": lines}

    for batch in batches:
        kind = batch.column("sheet").type
        schema = pa.schema([("sheet", kind), ("first_sheet", kind), ("range_no", pa.int32()), ("is_first", pa.bool_()), ("ends", pa.bool_()), ("seq", pa.int64()), ("lines", pa.list_(pa.string())), ("one_sheet", pa.bool_()), ("n_rows", pa.int64())])
        out = []
        for value, lines in sheets_of(batch):
            if not sheets or value != sheet:
                if sheets:
                    out.append(run(held, True))
                sheet, held, seq, sheets, first_sheet = value, [], 0, sheets + 1, first_sheet if sheets else value
            held = held + lines
            while len(held) > size:
                out.append(run(held[:size], False))
                held, seq = held[size:], seq + size
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if sheets:
        told = {"sheet": sheet, "first_sheet": first_sheet, "range_no": range_no, "one_sheet": sheets == 1, "n_rows": seq + len(held)}
        yield pa.RecordBatch.from_pylist([run(held, False), told], schema)


def sheets_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(sheet, its lines) of a batch in order."""
    sheets, lines = batch.column("sheet").to_pylist(), batch.column("_text").to_pylist()
    at = 0
    for sheet, group in groupby(sheets):
        end = at + sum(1 for _ in group)
        yield sheet, lines[at:end]
        at = end


def range_bases(ranges: list) -> list[tuple[int, int]]:
    """How many rows of a range's first sheet stand in earlier ranges; there is one entry a range."""
    bases, before = [], None
    for r in sorted(ranges, key=lambda r: r.range_no):
        bases.append((r.range_no, before[1] if before and r.first_sheet == before[0] else 0))
        before = (r.sheet, r.n_rows + (bases[-1][1] if r.one_sheet else 0))
    return bases


def batch_by_file(pages: DataFrame, key: list[str], size: int = 250) -> DataFrame:
    """Pages of a file gathered in page order for batched model calls, ``size`` page numbers at most each."""
    rest = [c for c in pages.columns if c not in key]
    batch = F.expr(f"(page_num - 1) div {size}").alias("batch")
    gathered = pages.groupBy(*key, batch).agg(F.array_sort(F.collect_list(F.struct("page_num", *[c for c in rest if c != "page_num"]))).alias("pages"))
    return gathered.withColumn("n_pages", F.size("pages"))


def order_pages(pages: DataFrame) -> DataFrame:
    """Reading order, for the output edge only."""
    return pages.orderBy("source_file", "part", "page_num")


def union_chunks(*handlers: DataFrame) -> DataFrame:
    """The chunks of all handlers as one table."""
    first, *others = handlers
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def image_chunks(files: DataFrame, content: str = "content") -> DataFrame:
    """One image is one chunk: page 0, no text, the bytes as they are."""
    kept = [c for c in files.columns if c != content]
    return files.select(
        *kept, F.lit("").alias("part"), F.lit(0).alias("page_num"), F.lit("").alias("page_text"), F.col(content).alias("image")
    )
