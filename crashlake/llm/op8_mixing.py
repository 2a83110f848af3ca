"""Mixing sources to target weights by hash-threshold histograms.

Every document has a hash of its id. Words are summed by source and by the
hash's leading bits; in each source the bucket where the running sum passes
the budget is found, and only that bucket is split by the next bits, level by
level, until one hash is left. If several rows have that hash, they are split
in the same way by a hash of the whole row, and rows alike in that too by a
number that each gets as they are written. Documents below the threshold are
taken once more than the rest: the budgets are nested, nothing is sorted, and
only the boundary bucket is read again. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crashlake.llm.common import stage, words

#: Weights of the sources in turn, share of all words to take, most copies of a source, bits of a level and of the hash.
WEIGHTS, SHARE, MOST, STEP, BITS = (3, 1, 2), 1.5, 2, 12, 60


def hashed(doc_id: Column) -> Column:
    """The first 60 bits of the md5 of the id's decimal text (null: of an empty text)."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def fine_hash(doc: Column) -> Column:
    """The first 60 bits of the md5 of the whole row as JSON."""
    return F.conv(F.substring(F.md5(F.to_json(doc, {"ignoreNullFields": "false"}).cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target. ``sizes``: source, source_size, one row each.
    Sources by code point, null last, weigh ``weights`` in turn; a target stops at
    ``most`` times its source, the excess being shared by weight among the others.

    With sources in the order of cap by weight, the stopped ones come first; the
    level of the others is the greatest (budget left) / (weight left)."""
    one = Window.partitionBy(F.lit(0))  # a row for each source
    turn = F.row_number().over(one.orderBy(F.col("source").asc_nulls_last()))
    rows = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn - 1) % len(weights) + 1))
    rows = rows.withColumn("cap", most * F.col("source_size"))
    before = one.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = share * F.sum("source_size").over(one) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = left / (F.sum("weight").over(one) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    rows = rows.withColumn("level", level)
    return rows.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * F.max("level").over(one)).alias("target"))


def _by_source(rows: DataFrame, sources: DataFrame, how: str = "inner") -> DataFrame:
    sources = sources.withColumnRenamed("source", "__source")
    return rows.join(sources, F.col("source").eqNullSafe(F.col("__source")), how).drop("__source")


def _boundary(rows: DataFrame, at: DataFrame) -> DataFrame:
    """source, need, prefix, n, ties: the hash at which the running sum of a source's
    ``size`` passes ``need``, what is still needed before it, and the words and rows
    of that hash. ``rows``: source, size, hash; ``at``: source, need."""
    at = at.select("source", "need", F.lit(0).cast("long").alias("prefix"))
    for level in range(1, BITS // STEP + 1):
        bucket = F.shiftright("hash", BITS - STEP * level)
        inside = _by_source(rows.select("source", "size", "hash"), at).where(F.shiftright("hash", BITS - STEP * (level - 1)) == F.col("prefix"))
        sums = inside.groupBy("source", "need", bucket.alias("prefix")).agg(F.sum("size").alias("n"), F.count(F.when(F.col("size") > 0, 1)).alias("ties"))
        upto = F.sum("n").over(Window.partitionBy("source").orderBy("prefix"))
        passing = sums.withColumn("upto", upto).where("upto > need")
        first = passing.groupBy("source").agg(F.min(F.struct("prefix", "need", "upto", "n", "ties")).alias("x"))
        last = stage(first.select("source", (F.col("x.need") - (F.col("x.upto") - F.col("x.n"))).alias("need"), "x.prefix", "x.n", "x.ties"), "boundary")
        at = last.select("source", "need", "prefix")
    return last


def thresholds(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target, whole, cut, need, n, ties: documents of hash below
    ``cut`` are taken whole + 1 times, the others ``whole`` times; of those of hash
    ``cut``, ``ties`` rows of ``n`` words in all, ``need`` words once more. ``rows``:
    source, size, hash."""
    plan = stage(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    found = _boundary(rows, plan).withColumnRenamed("prefix", "cut")
    return stage(_by_source(plan.drop("need"), found, "left").withColumn("cut", F.coalesce("cut", F.lit(0).cast("long"))), "thresholds")


def _nearer(n: Column, need: Column) -> Column:
    """1 if taking ``n`` words is nearer to ``need`` than taking none, else 0."""
    return F.coalesce((n - need < need).cast("long"), F.lit(0).cast("long"))


def _split(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` of the hashes in ``hot`` with extra (0 or 1): first by the hash of the
    row, then, among rows alike, by a number fixed as they are written."""
    ties = stage(rows.withColumn("fine", fine_hash(F.col("doc"))).withColumn("seq", F.monotonically_increasing_id()), "ties")
    last = _boundary(ties.select("source", "size", F.col("fine").alias("hash")), hot)
    last = last.select("source", F.col("need").alias("rest"), F.col("prefix").alias("fine_cut"), (F.col("n") / F.col("ties")).alias("each"))
    # monotonically_increasing_id: the task that wrote the row, and a number within it
    ties = _by_source(ties, stage(last, "fine-boundary"), "left")
    alike = (F.col("fine") == F.col("fine_cut")) & (F.col("size") > 0)
    equal = ties.where(alike)
    bucket = F.shiftright("seq", STEP)
    before = F.sum("m").over(Window.partitionBy("source").orderBy("bucket")) - F.col("m")
    counts = equal.groupBy("source", bucket.alias("bucket")).agg(F.count("*").alias("m")).withColumn("before", before)
    number = F.row_number().over(Window.partitionBy("source", "bucket").orderBy("seq"))
    counts = counts.select(F.col("source").alias("__s"), F.col("bucket").alias("__b"), "before")
    # the k nearest to need: whole rows that fit, and one more if that is nearer
    fit = F.floor(F.col("rest") / F.col("each"))
    most = fit + _nearer(F.col("each"), F.col("rest") - fit * F.col("each"))
    numbered = equal.withColumn("bucket", bucket).withColumn("number", number).join(counts, F.col("source").eqNullSafe(F.col("__s")) & (F.col("bucket") == F.col("__b")))
    chosen = numbered.select("doc", "source", "size", "hash", (F.col("before") + F.col("number") <= most).cast("long").alias("extra"))
    others = ties.where(~F.coalesce(alike, F.lit(False)))
    return others.select("doc", "source", "size", "hash", F.coalesce((F.col("fine") < F.col("fine_cut")).cast("long"), F.lit(0).cast("long")).alias("extra")).union(chosen)


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``doc`` (the whole row), size, source_size, target, copies.

    A null text has size 0; a null source is a source, the last; a source
    without words has target 0 and no copies; rows that repeat an id are taken
    alike but for the id at a source's threshold, whose rows are split; an
    empty table gives none. Each source's words differ from its target by at
    most half the words of one row."""
    rows = docs.select(F.struct("*").alias("doc"), F.col(source).alias("source"), hashed(F.col(doc_id)).alias("hash"), F.size(words(F.col(text))).cast("long").alias("size"))
    found = thresholds(stage(rows.select("source", "size", "hash"), "sizes"), weights, share, most)
    joined = _by_source(rows, found)
    tied = F.coalesce(F.col("ties") > 1, F.lit(False))
    extra = F.when(F.col("hash") < F.col("cut"), 1).when(F.col("hash") == F.col("cut"), _nearer(F.col("n"), F.col("need"))).otherwise(0)
    columns = ["doc", "size", "source_size", "target"]
    hot = found.where(tied).select("source", "need", "cut")
    if hot.isEmpty():
        return joined.select(*columns, (F.col("whole") + extra).alias("copies"))
    mark = tied & (F.col("hash") == F.col("cut"))
    plain = joined.where(~mark).select(*columns, (F.col("whole") + extra).alias("copies"))
    split = _split(joined.where(mark).select("doc", "source", "size", "hash"), hot.select("source", "need"))
    return plain.union(_by_source(split, found).select(*columns, (F.col("whole") + F.col("extra")).alias("copies")))


def mixed(docs: DataFrame, **columns) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns of ``docs``."""
    taken = mix(docs, **columns).where("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("doc.*")
