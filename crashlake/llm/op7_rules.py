"""Quality rules as robust multivariate outliers, in DataFrame functions only.

Base statistics of each whole text become a vector of transformed measures,
in whole 1/UNIT steps so that every sum below is exact and reruns agree. Per
language and source a minimum-covariance-determinant estimate is sought: from
each of several starts, the half of the texts nearest to the estimate gives the
next mean and covariance (STEPS concentration steps); the start that ends in
the least determinant wins, and all texts that it finds near give the final
estimate. A row is rejected if its Mahalanobis distance from the estimate is
beyond CUTOFF.

Copies of a text count once in the estimate, so that no text, however often it was
copied, can make itself the rule; texts that differ break it down only from
half of a group on. The half is exact: of the distance bin at its border only the
share that is missing counts. A group of fewer than LEAST different texts is judged
by its language's estimate, and that by the whole corpus's.

Null texts are empty and fail the base rules; null languages and sources are
values of their own; very long texts and repeated rows are judged like any other;
columns of any name stay inside ``doc``; an empty table gives none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crashlake.llm.common import BLANKS, let, stage, words

SYMBOLS = "#*$%&|<>"
#: Fewest words, and most words in repeated windows (percent of all words).
MIN_WORDS, MAX_REPEATED = 50, 50
WINDOW = 3


def _repeated(w: Column) -> Column:
    """Words in windows of three that the text holds twice or more."""
    hashes = F.transform(F.slice(w, 1, F.greatest(F.size(w) - (WINDOW - 1), F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def doubled(s: Column) -> Column:
        same = F.transform(s, lambda x, j: F.when((x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]), x["p"]).otherwise(F.lit(-1)))
        return let(F.sort_array(F.array_remove(same, -1)), covered)

    def marked(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(ordered, doubled))

    return let(hashes, marked)


def statistics(text: Column) -> dict[str, Column]:
    """The base statistics of a whole text; a null text is empty."""
    text = F.coalesce(text, F.lit(""))
    split = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated(w).cast("long").alias("n_repeat_words")))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, BLANKS, "") != "")
    return {
        "__w": split,
        "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


#: Measures in 1/UNIT steps; the least standard deviation each may have (of the
#: measure itself); the factor that makes the covariance of the nearer half, and of the
#: rows within NEAR, consistent for four normal measures; concentration steps, bins
#: of the distance (a factor of exp(1/BINS) each), the squared distance that one in
#: forty rows of four normal measures exceeds (chi-square), and the one that one
#: in a thousand does, beyond which a row is rejected. Floor i lets measure i deviate by at most
#: sqrt(CUTOFF) * FLOORS[i] in a tight group, within what each measure can reach.
UNIT = 256
FLOORS = (0.3, 0.25, 0.08, 0.35)
CONSISTENT, CONSISTENT_NEAR, STEPS, BINS, NEAR, CUTOFF = 2.109, 1.0645, 3, 16, 11.143, 18.467
P = len(FLOORS)
#: Centres of the starts: a quantile of each measure. Signs and repeats err upwards only.
STARTS = ((0.5, 0.5, 0.5, 0.5), (0.25, 0.5, 0.25, 0.25))
#: Different texts that a group needs for an estimate of its own.
LEAST = 40
GROUP = ["level", "lang", "source"]


def measures() -> list[Column]:
    """Signs per hundred words and repeated lines per hundred words (logs), characters per word, share of repeated words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    raw = [F.log1p(100 * F.col("n_symbols") / n), F.col("word_chars") / n, F.col("n_repeat_words") / n, F.log1p(100 * F.col("n_dup_lines") / n)]
    return [F.floor(x * UNIT + 0.5).cast("long").alias(f"g{i}") for i, x in enumerate(raw)]


def with_statistics(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``doc`` (the whole row), lang, source, a hash of the text, the base statistics, base_failed and the measures g0..g3."""
    rows = docs.select(F.struct("*").alias("doc"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"), F.xxhash64(F.col(text)).alias("text_hash"),
                       *[c.alias(name) for name, c in statistics(F.col(text)).items()]).select("*", "__w.*").drop("__w")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed).select("*", *measures())


def _on_group(rows: DataFrame, groups: DataFrame, *more: str) -> DataFrame:
    names = [*GROUP, *more]
    groups = groups.withColumnsRenamed({c: f"__{c}" for c in names})
    same = F.lit(True)
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return rows.join(groups, same).drop(*[f"__{c}" for c in names])


def _first_distance() -> Column:
    """Squared distance from a start's centre in units of the median deviations."""
    return sum((((F.col(f"g{i}") - F.col(f"m{i}")) / F.greatest(1.4826 * F.col(f"d{i}"), F.lit(FLOORS[i] * UNIT))) ** 2 for i in range(P)), F.lit(0.0))


def with_distance(rows: DataFrame) -> DataFrame:
    """``rows`` with d2, the squared Mahalanobis distance: forward substitution with the Cholesky factor."""
    for i in range(P):
        rest = sum((F.col(f"l{i}{j}") * F.col(f"y{j}") for j in range(i)), F.lit(0.0))
        rows = rows.withColumn(f"y{i}", (F.col(f"g{i}") - F.col(f"m{i}") - rest) / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(P)), F.lit(0.0))).drop(*[f"y{i}" for i in range(P)])


PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
SUMS = ["n", *(f"s{i}" for i in range(P)), *(f"s{i}{j}" for i, j in PAIRS)]


def _sums() -> list[Column]:
    return [F.count("*").alias("n"), *[F.sum(f"g{i}").alias(f"s{i}") for i in range(P)], *[F.sum(F.col(f"g{i}") * F.col(f"g{j}")).alias(f"s{i}{j}") for i, j in PAIRS]]


def _factor(sums: DataFrame, keys: list[str], consistent: float) -> DataFrame:
    """Mean m_i and Cholesky factor l_ij of the covariance from SUMS (double)."""
    out = sums.select(*keys, *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(P)], *[
        (consistent * (F.col(f"s{i}{j}") / F.col("n") - F.col(f"s{i}") / F.col("n") * (F.col(f"s{j}") / F.col("n"))) + (
            (FLOORS[i] * UNIT) ** 2 if i == j else 0.0)).alias(f"a{i}{j}") for i, j in PAIRS])
    for i, j in PAIRS:
        less = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.col(f"a{i}{i}") - less) if i == j else (F.col(f"a{i}{j}") - less) / F.col(f"l{j}{j}"))
    return out.select(*keys, *[f"m{i}" for i in range(P)], *[f"l{i}{j}" for i, j in PAIRS])


def _half(rows: DataFrame) -> DataFrame:
    """The estimate of every group and start from the half of its rows with the least
    d2: whole bins of it, and of the one at the border the share that is missing."""
    keys = [*GROUP, "start"]
    sums = rows.groupBy(*keys, F.floor(BINS * F.log1p("d2")).alias("bin")).agg(*_sums())
    whole = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("n").over(whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    half = F.least(F.floor((F.sum("n").over(whole) + P + 1) / 2), F.sum("n").over(whole))
    sums = sums.withColumn("before", before).withColumn("left", half - F.col("before")).where("left > 0")
    full = F.col("left") >= F.col("n")
    # one bin a group at most is taken in part, so that the sums below are exact but for one product
    parts = [(F.coalesce(F.sum(F.when(full, F.col(c))), F.lit(0)) + F.coalesce(F.max(F.when(~full, F.col(c) * (F.col("left") / F.col("n")))), F.lit(0.0))).alias(c) for c in SUMS]
    return _factor(sums.groupBy(*keys).agg(*parts), keys, CONSISTENT)


def estimates(rows: DataFrame) -> DataFrame:
    """lang, source, m_i, l_ij: the estimate that judges each group, from the different
    texts that pass the base rules."""
    null = F.lit(None).cast("string")
    levels = F.array(*[F.struct(F.lit(k).alias("level"), (F.col("lang") if k < 2 else null).alias("lang"), (F.col("source") if k < 1 else null).alias("source")) for k in range(3)])
    measures = [f"g{i}" for i in range(P)]
    rows = rows.where(~F.col("base_failed")).select(F.inline(levels), "text_hash", *measures).distinct().drop("text_hash")
    rows = stage(rows, "vectors")
    quantile = lambda q, x, name: F.expr(f"percentile_disc({q}) within group (order by {x})").alias(name)
    wanted = sorted({(start[i], i) for start in STARTS for i in range(P)})
    centre = rows.groupBy(*GROUP).agg(F.count("*").alias("texts"), *[quantile(q, f"g{i}", f"q{i}_{int(100 * q)}") for q, i in wanted])
    starts = F.array(*[F.struct(F.lit(k).alias("start"), *[F.col(f"q{i}_{int(100 * start[i])}").alias(f"m{i}") for i in range(P)]) for k, start in enumerate(STARTS)])
    centre = stage(centre.select(*GROUP, "texts", F.inline(starts)), "centres")
    means = [f"m{i}" for i in range(P)]
    spread = stage(_on_group(rows, centre).groupBy(*GROUP, "start", *means).agg(*[quantile(0.5, f"abs(g{i} - m{i})", f"d{i}") for i in range(P)]), "deviations")
    found = stage(_half(_on_group(rows, spread).withColumn("d2", _first_distance())), "estimate")
    for _ in range(STEPS):
        found = stage(_half(with_distance(_on_group(rows, found))), "estimate")
    values = [c for c in found.columns if c not in (*GROUP, "start")]
    volume = F.col("l00") * F.col("l11") * F.col("l22") * F.col("l33")
    best = found.groupBy(*GROUP).agg(F.min(F.struct(volume.alias("volume"), "start", *values)).alias("x")).select(*GROUP, "x.*").select(*GROUP, *values)
    near = with_distance(_on_group(rows, best)).where(F.col("d2") <= NEAR).groupBy(*GROUP).agg(*[c.cast("double").alias(n) for c, n in zip(_sums(), SUMS)])
    final = stage(_factor(near, GROUP, CONSISTENT_NEAR), "final")
    # which level judges a group: the first one of LEAST different texts
    texts = centre.where("start = 0").select(*GROUP, "texts")
    own, langs = texts.where("level = 0"), texts.where("level = 1").select(F.col("lang").alias("__l"), F.col("texts").alias("in_lang"))
    picked = own.join(langs, F.col("lang").eqNullSafe(F.col("__l")))
    level = F.when(F.col("texts") >= LEAST, 0).when(F.col("in_lang") >= LEAST, 1).otherwise(2)
    picked = picked.select(F.col("lang").alias("for_lang"), F.col("source").alias("for_source"), level.alias("level"), F.when(level < 2, F.col("lang")).alias("lang"), F.when(level < 1, F.col("source")).alias("source"))
    # written, so that its size, a row for each group, is known where rows are joined to it
    return stage(_on_group(picked, final).select(F.col("for_lang").alias("lang"), F.col("for_source").alias("source"), *values), "judges")


def judge(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`with_statistics`, written once, with d2 and ``kept``."""
    rows = stage(rows, "statistics")
    found = estimates(rows).withColumnsRenamed({"lang": "__lang", "source": "__source"})
    joined = rows.join(found, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left")
    return with_distance(joined).withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("d2") <= CUTOFF, F.lit(False)))
