"""CSV records out of split text files.

A record may run over many lines, as quoted fields may hold line ends, so
whether a line begins a record depends on all quotes before it in its file. A
line is read once as a pair of facts: whether a quoted field is open at its
end if none was open at its start, and if one was. Such pairs compose: within
a split by a running window over its lines (a split is what one task reads),
over the splits of a file by the same window over one row a split. That tells
the state in which every split starts, and the lines of records that run on,
also over the border of splits, are joined; all other lines are records by
themselves and are not moved again. How far back the record of a line begins
is kept with the line for either state, so its lines are moved once more only.

Quotes count where a CSV reader counts them: at the start of a field, and inside
a quoted one, where two stand for one. A quote inside a plain field is text. An
open quote that nothing closes takes the rest of its file into its record, as
in any reader of such files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A whole quoted field at its start, with what stands behind its last quote.
QUOTED = r'(^|,)"[^"]*+(?:""[^"]*+)*+"[^,]*+'
#: What is left of a quoted field that was open at the start of a line.
CLOSING = r'^[^"]*+(?:""[^"]*+)*+"(?!")'


def _opens(text: Column) -> Column:
    """True if a quoted field is open at the end of ``text``, which starts outside of one."""
    return F.regexp_replace(text, QUOTED, "$1").rlike('(^|,)"')


def _state(before: Column, start: Column) -> Column:
    """The state behind ``before`` (struct of base, flip) when its sequence starts in ``start``."""
    base = F.coalesce(before["base"], start)
    return base != before["flip"]


def _effects(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``before`` and ``after``, struct(base, flip): what the rows of ``by`` before each
    one, and with it, do to the state. Base: what the last row that forgets the state
    set (null: none does); flip: whether it was turned since.

    A row (if_closed, if_open) forgets the state if both are alike, and turns it
    if each is the other's."""
    upto = Window.partitionBy(*by).orderBy(*order)
    rows = rows.withColumn("_turn", (F.col("if_closed") & ~F.col("if_open")).cast("int"))
    # relative to the number of turns so far, so that later ones can be counted from it
    mark = F.when(F.col("if_closed") == F.col("if_open"), F.col("if_closed") != (F.sum("_turn").over(upto) % 2 == 1))
    rows = rows.withColumn("_mark", mark)

    def effect(to: int) -> Column:
        seen = upto.rowsBetween(Window.unboundedPreceding, to)
        odd = F.coalesce(F.sum("_turn").over(seen), F.lit(0)) % 2 == 1
        return F.struct(F.last("_mark", ignorenulls=True).over(seen).alias("base"), odd.alias("flip"))

    return rows.withColumns({"before": effect(-1), "after": effect(0)}).drop("_turn", "_mark")


def read_lines(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, int]:
    """(file, block, row, value, before, after, back_closed, back_open) for every line, and the number
    of files. Back: how many rows further up the line's record begins in its split if that starts
    outside or inside a quoted field (null: in an earlier split)."""
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), "value")
    inside = F.regexp_replace("value", CLOSING, "")
    closes = F.col("value").rlike(CLOSING)
    quoted = F.col("value").contains('"')
    lines = lines.withColumn("if_closed", quoted & _opens(F.col("value"))).withColumn("if_open", ~(quoted & closes) | _opens(F.concat(F.lit("x"), inside)))
    lines = _effects(lines, ["file", "block"], ["row"]).drop("if_closed", "if_open")
    upto = Window.partitionBy("file", "block").orderBy("row")
    begin = {name: F.last(F.when(~_state(F.col("before"), F.lit(name == "open")), F.col("row")), ignorenulls=True).over(upto) for name in ("closed", "open")}
    return lines.withColumns({f"back_{name}": F.col("row") - at for name, at in begin.items()}), len(text.inputFiles())


def records(lines: DataFrame) -> DataFrame:
    """file, block, row (of the first line), value of every record that is not empty."""
    # one row a split: its effect on the state, and where its last record starts if it starts in either state
    at = F.struct("block", "row")
    begins = {name: F.max(F.when(~_state(F.col("before"), F.lit(name == "open")), at)).alias(f"begin_{name}") for name in ("closed", "open")}
    last = F.max_by("after", "row")
    splits = lines.groupBy("file", "block").agg(last.alias("effect"), *begins.values())
    splits = splits.withColumns({"if_closed": _state(F.col("effect"), F.lit(False)), "if_open": _state(F.col("effect"), F.lit(True))})
    splits = _effects(splits, ["file"], ["block"]).withColumn("start", _state(F.col("before"), F.lit(False)))
    begin = F.when(F.col("start"), F.col("begin_open")).otherwise(F.col("begin_closed"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("begin", begin).withColumn("carried", F.last("begin", ignorenulls=True).over(earlier)).select("file", "block", "start", "carried")
    # one row a split is sent, so that the lines stay where they are read
    known = lines.join(F.broadcast(splits), ["file", "block"])
    back = F.when(F.col("start"), F.col("back_open")).otherwise(F.col("back_closed"))
    first = F.coalesce(F.when(back.isNotNull(), F.struct("block", (F.col("row") - back).alias("row"))), F.col("carried"))
    known = known.select("file", "block", "row", "value", first.alias("first"), _state(F.col("before"), F.col("start")).alias("opened"), _state(F.col("after"), F.col("start")).alias("open"))
    alone = known.filter(~F.col("opened") & ~F.col("open")).select("file", "block", "row", "value")
    parts = known.filter(F.col("opened") | F.col("open"))
    parts = parts.groupBy("file", "first").agg(F.sort_array(F.collect_list(F.struct("block", "row", "value"))).alias("all"))
    joined = parts.select("file", "first.block", "first.row", F.array_join(F.transform("all", lambda x: x["value"]), "\n").alias("value"))
    text = F.regexp_replace(F.regexp_replace("value", r"\r$", ""), "^\ufeff", "")
    return alone.unionByName(joined).withColumn("value", text).filter(F.col("value") != "")
