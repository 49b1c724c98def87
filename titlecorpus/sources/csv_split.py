"""Split reading of CSV with quoted newlines (O8): one large file, many tasks.

A line break ends a record only outside quotes, and a split does not know
whether it starts inside. So each split is read as plain lines twice. First it
tells where it would end, outside or inside quotes, for both ways it may start;
a prefix over the splits of a file (one row a split) gives the true start of
each. Then each split puts its records together from their true starts. A
record that crosses splits is stitched from its pieces, which alone are
shuffled. The records are parsed by Spark's own CSV parser.

Quotes count as the parser counts them: a quote opens a field only at its
start, doubled quotes stay inside, and after a closing quote the field goes on
to the next delimiter. Lines end with ``\\n`` or ``\\r\\n``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from titlecorpus.session import ship_package

#: Kinds of piece: a whole record, the begin of one that its split does not end, and what continues one of an earlier split.
WHOLE, TAIL, HEAD = 0, 1, 2


def inside_after(line: str, inside: bool) -> bool:
    """Whether the place after ``line`` is inside quotes, if the place before it is or is not."""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            while at >= 0 and line.startswith('""', at):
                at = line.find('"', at + 2)
            if at < 0:
                return True
            # What follows a closing quote belongs to the field, up to the delimiter.
            at = line.find(",", at)
            if at < 0:
                return False
            at += 1
        if line.startswith('"', at):
            at += 1
        else:
            at = line.find(',"', at)
            if at < 0:
                return False
            at += 2
        inside = True


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, _file, _block): the physical lines of each split, in order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))


def split_starts(lines: DataFrame) -> DataFrame:
    """(_file, _block) of the splits that start inside quotes."""

    def rows(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        key = ends = None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, *ends)], ["_file", "_block", "outside", "inside"])

        for b in batches:
            # Runs of lines of one split; lines without quotes change nothing and come as NULL.
            file, block = b.column("_file"), b.column("_block")
            start = 0
            while start < b.num_rows:
                now = (file[start].as_py(), block[start].as_py())
                same = pc.and_(pc.equal(file, now[0]), pc.equal(block, now[1]))
                end = start + (pc.index(same.slice(start), False).as_py() if not pc.all(same.slice(start)).as_py() else b.num_rows - start)
                if now != key:
                    if key is not None:
                        yield row()
                    key, ends = now, [False, True]
                for line in b.column("value").slice(start, end - start).drop_null().to_pylist():
                    ends = [inside_after(line, x) for x in ends]
                start = end
        if key is not None:
            yield row()

    quoted = lines.withColumn("value", F.when(F.contains("value", F.lit('"')), F.col("value")))
    states = quoted.mapInArrow(rows, "_file string, _block long, outside boolean, inside boolean")
    # A split ends alike for both starts, or keeps them, or swaps them. The start of a split is the end of the
    # last one of the first kind before it, or outside, swapped as often as splits since then swap.
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    swaps = states.withColumn("_swaps", F.sum((F.col("outside") & ~F.col("inside")).cast("long")).over(upto) % 2)
    fixed = F.when(F.col("outside") == F.col("inside"), (F.col("outside").cast("long") + F.col("_swaps")) % 2)
    start = (F.coalesce(F.last("_fixed", ignorenulls=True).over(before), F.lit(0)) + F.coalesce(F.lag("_swaps").over(Window.partitionBy("_file").orderBy("_block")), F.lit(0))) % 2
    return swaps.withColumn("_fixed", fixed).withColumn("_start", start).where("_start = 1").select("_file", "_block")


def pieces(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """(_file, _block, _row, kind, value): records and pieces of records; ``_row`` counts those that start in the split from 0.

    Of the splits only those that start inside quotes are broadcast, 8 bytes
    each: some MB for a petabyte in splits of 128 MB.
    """

    def rows(batches):
        import pyarrow as pa

        key, held, n, inside, kind = None, [], 0, False, WHOLE
        out = []

        def end():
            """What the split leaves open."""
            if held:
                out.append((*key, n if kind == TAIL else -1, kind, "\n".join(held)))

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()))],
                                              ["_file", "_block", "_row", "kind", "value"])
            out.clear()
            return made

        for b in batches:
            for line, file, block, late in zip(*(b.column(c).to_pylist() for c in ("value", "_file", "_block", "late"))):
                if key != (file, block):
                    end()
                    key, held, n, inside = (file, block), [], 0, late
                    kind = HEAD if late else TAIL
                if '"' in line:
                    inside = inside_after(line, inside)
                held.append(line)
                if not inside:
                    text = "\n".join(held) if len(held) > 1 else line
                    held = []
                    if kind == HEAD:
                        out.append((*key, -1, HEAD, text))
                        kind = TAIL
                    elif text not in ("", "\r"):  # the parser skips empty lines
                        out.append((*key, n, WHOLE, text))
                        n += 1
            if out:
                yield batch()
        end()
        if out:
            yield batch()

    key = F.xxhash64("_file", "_block")
    late = F.broadcast(starts.select(key.alias("_late")))
    marked = lines.withColumn("_key", key).join(late, F.col("_key") == F.col("_late"), "left").select("value", "_file", "_block", F.col("_late").isNotNull().alias("late"))
    return marked.mapInArrow(rows, "_file string, _block long, _row long, kind int, value string")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _block, _row, value): the text of every record, header lines included; order = (file, split, row in split)."""
    ship_package(spark)
    lines = _lines(spark, path)
    every = pieces(lines, split_starts(lines))
    parts = every.where(F.col("kind") != WHOLE)
    # Where a continued record began: the last split before with a TAIL. Places only, one or two a split; the texts meet by record.
    upto = Window.partitionBy("_file").orderBy("_block", F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    tail = F.when(F.col("kind") == TAIL, F.struct(F.col("_block").alias("b"), F.col("_row").alias("r")))
    owner = parts.select("_file", "_block", "_row", "kind").withColumn("_owner", F.last(tail, ignorenulls=True).over(upto)).select(
        "_file", "_block", "kind", "_owner")
    joined = parts.drop("_row").join(owner, ["_file", "_block", "kind"])
    pieces_ = F.array_sort(F.collect_list(F.struct("_block", F.col("kind"), "value")))
    stitched = joined.groupBy("_file", "_owner").agg(F.array_join(pieces_.getField("value"), "\n").alias("value"))
    crossing = stitched.select("_file", F.col("_owner.b").alias("_block"), F.col("_owner.r").alias("_row"), "value")
    return every.where(F.col("kind") == WHOLE).select("_file", "_block", "_row", "value").unionByName(crossing)


def read_csv_splits(spark: SparkSession, path: str, columns: list[str], options: dict) -> DataFrame:
    """The cells of ``columns`` (the names in the header, in its order) as strings, with (_file, _block, _row).

    Every file must start with that header. ``options``: those of Spark's CSV source.
    """
    given = records(spark, path)
    parser = {**options, "header": "false", "multiLine": "true", "lineSep": "\n"}
    cells = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    parsed = F.from_csv(F.regexp_replace("value", "\\r\\z", ""), cells, parser)
    first = (F.col("_block") == 0) & (F.col("_row") == 0)
    named = given.withColumn("_cells", parsed)
    same = F.array(*(F.col("_cells").getField(c) for c in columns)) == F.array(*(F.lit(c) for c in columns))
    wrong = F.raise_error(F.concat(F.lit("the header differs in "), F.col("_file"))).cast("boolean")
    return named.where(F.when(~first, True).when(F.coalesce(same, F.lit(False)), False).otherwise(wrong)).select(
        *(F.col("_cells").getField(c).alias(c) for c in columns), "_file", "_block", "_row")
