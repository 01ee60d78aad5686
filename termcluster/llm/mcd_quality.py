"""Quality rules with robust multivariate outliers, in DataFrame expressions.

Each document gets statistics of its whole text. Base rules reject documents of
fewer than ``MIN_WORDS`` words or with more than ``MAX_REPEATED`` percent of words
in repeated 5-word windows. The others are judged by four transformed statistics

    log mean word length, log(1 + 10 symbols per word),
    repeated share of the lines with words, repeated share of the words,

each in units of a spread below which differences don't matter (``UNITS``). For
every (language, source) the minimum covariance determinant gives their centre
and scatter: starting from two estimates (all rows; all rows, unit scatter), each
step takes the share ``CORE`` of the rows with the smallest Mahalanobis distances
and estimates anew, until the estimates repeat; the smaller determinant wins.
Whole bins and the added variance allow estimates that repeat in a cycle: of a
cycle, the smallest determinant counts. One
unit of variance is added, so that constant statistics do no harm. A document
whose squared distance exceeds ``LIMIT`` is rejected.

The rows nearest to the centre are found without sorting a group: distances are
counted in at most ``BINS`` bins, and every step is one aggregate of exact
integer sums by (group, bin), so its result doesn't depend on the partitioning,
and a group with a third of all rows is pre-aggregated like any other. The
bin that holds the last wanted row counts whole.

Scale: the statistics (some 100 bytes per document; with ``keep_row`` the rows as
well) are computed once, without a shuffle, and written to the shared folder; steps
read only the statistics. Estimates are a
row per group and start; Spark broadcasts them if they are small. A group and
start whose estimates repeat takes no part in later steps.

Defined cases: null or empty texts have no words and fail the base rules; null
languages and sources form groups of their own; repeated rows count as often as
they occur; a group of one row keeps it. Rows that fail the base rules take no
part in the estimates. Extra columns are ignored, or kept in ``row``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termcluster.llm.shared import scratch

MIN_WORDS, MAX_REPEATED = 10, 20
UNITS = (0.15, 0.2, 0.1, 0.08)
CORE = 0.75
#: Factor that makes the scatter of the nearest three quarters consistent for normal data in four dimensions.
CONSISTENT = 1.486
#: The 0.9999 quantile of the chi-square distribution with four degrees of freedom.
LIMIT = 23.51
GRID = 1024
BINS, BINS_PER_DOUBLING = 1024, 32
#: A guard that raises: every step leads to one of finitely many cores, so estimates repeat long before.
STEPS = 1000
#: Tasks that hold the estimates, a row per group and start.
GROUP_TASKS = 16
Z = ("z1", "z2", "z3", "z4")
PAIRS = [(i, j) for i in range(4) for j in range(i + 1)]
ESTIMATES = ["det", *(f"m{i}" for i in range(4)), *(f"l{i}{j}" for i, j in PAIRS)]
KEYS = ["glang", "gsource", "start", "n"]
#: Products are summed in two halves, the lower of so many bits: sums of longs stay exact up to 2**40 rows.
LOW_BITS = 20


def text_statistics(docs: DataFrame, text: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines and
    n_repeat_words to docs, whose columns must have other names."""
    kept = [c for c in docs.columns if c != text]
    spaces = "\t\n\x0b\x0c\r"
    t = F.coalesce(F.col(text), F.lit(""))
    one = docs.select(*kept, t.alias("t"), F.translate(t, spaces, " " * len(spaces)).alias("flat"))
    two = one.select(*kept, F.array_remove(F.split("flat", " "), "").alias("ws"), F.char_length(F.translate("flat", " ", "")).cast("long").alias("word_chars"),
                     (F.char_length("t") - F.char_length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
                     F.filter(F.split("t", "\n", -1), lambda x: F.translate(x, " " + spaces, "") != "").alias("lines"))
    three = two.select(*kept, "word_chars", "n_symbols", F.size("ws").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                       F.transform("ws", lambda w: F.xxhash64(w)).alias("hs"))
    # columns that a lambda reads are named more than once, so that they are computed once per row
    windows = F.when(F.size("hs") > 4, F.transform(F.sequence(F.lit(0), F.size("hs") - 5), lambda i: F.xxhash64(*(F.get("hs", i + k) for k in range(5)))))
    stats = [*kept, "word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines"]
    four = three.select(*stats, windows.alias("wins"))
    ordered = F.sort_array(F.transform("wins", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    five = four.select(*stats, F.when(F.size(F.array_distinct("wins")) < F.size("wins"), ordered).alias("srt"))
    twice = F.transform("srt", lambda s, k: F.when((F.get("srt", k - 1)["h"] == s["h"]) | (F.get("srt", k + 1)["h"] == s["h"]), s["i"]))
    six = five.select(*stats, F.sort_array(F.array_compact(twice)).alias("starts"))
    steps = F.transform("starts", lambda p, k: F.least(F.lit(5), F.coalesce(F.get("starts", k + 1) - p, F.lit(5))))
    return six.select(*stats, F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def vectors() -> list[Column]:
    """The transformed statistics on an integer grid, so that sums are exact."""
    n = F.greatest("n_words", F.lit(1))
    x = (F.log((F.col("word_chars") + 1) / n), F.log1p(10 * F.col("n_symbols") / n), F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), F.col("n_repeat_words") / n)
    return [F.round(v * F.lit(GRID / u)).cast("long").alias(z) for v, u, z in zip(x, UNITS, Z, strict=True)]


def estimates(sums: DataFrame, unit: Column) -> DataFrame:
    """Centre (m1..m4), Cholesky factor (l11, l21, l22, ...) of the scatter and
    its log determinant, from the sums of a group; unit: unit scatter only."""
    exact = "decimal(20,0)"
    product = {(i, j): F.col(f"h{i}{j}").cast(exact) * F.lit(1 << LOW_BITS).cast("decimal(8,0)") + F.col(f"p{i}{j}").cast(exact) for i, j in PAIRS}
    mean = [F.col(f"s{i}").cast("double") / F.col("k") / GRID for i in range(4)]
    cov = {(i, j): F.when(unit, 0.0).otherwise(CONSISTENT * (product[i, j].cast("double") / F.col("k") / (GRID * GRID) - mean[i] * mean[j])) + float(i == j) for i, j in PAIRS}
    out = sums.select("glang", "gsource", "start", "n", *(m.alias(f"m{i}") for i, m in enumerate(mean)), *(c.alias(f"c{i}{j}") for (i, j), c in cov.items()))
    for i, j in PAIRS:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l{j}{j}"))
    det = sum((F.log(f"l{i}{i}") for i in range(4)), F.lit(0.0))
    return out.select("glang", "gsource", "start", "n", *(f"m{i}" for i in range(4)), *(f"l{i}{j}" for i, j in PAIRS), det.alias("det"))


def distance() -> Column:
    """Squared Mahalanobis distance, by forward substitution."""
    y: list[Column] = []
    for i in range(4):
        v = F.col(Z[i]) / GRID - F.col(f"m{i}")
        for j in range(i):
            v = v - F.col(f"l{i}{j}") * y[j]
        y.append(v / F.col(f"l{i}{i}"))
    return sum((v * v for v in y), F.lit(0.0))


def same_group() -> Column:
    return F.col("lang").eqNullSafe(F.col("glang")) & F.col("source").eqNullSafe(F.col("gsource"))


def moment_sums() -> list[Column]:
    product = {(i, j): F.col(Z[i]) * F.col(Z[j]) for i, j in PAIRS}
    return [F.count("*").alias("k"), *(F.sum(z).alias(f"s{i}") for i, z in enumerate(Z)),
            *(F.sum(F.shiftright(p, LOW_BITS)).alias(f"h{i}{j}") for (i, j), p in product.items()),
            *(F.sum(p.bitwiseAND((1 << LOW_BITS) - 1)).alias(f"p{i}{j}") for (i, j), p in product.items())]


def concentration_step(stats: DataFrame, now: DataFrame) -> DataFrame:
    """Estimates from the rows nearest to those of now."""
    names = ["k", *(f"s{i}" for i in range(4)), *(f"{c}{i}{j}" for c in "hp" for i, j in PAIRS)]
    near = stats.join(now, same_group()).withColumn("bin", F.least(F.lit(BINS - 1), F.floor(BINS_PER_DOUBLING * F.log2(1 + distance()))).cast("int"))
    bins = near.groupBy(*KEYS, "bin").agg(*moment_sums())
    nearer = F.sum("k").over(Window.partitionBy("glang", "gsource", "start").orderBy("bin")) - F.col("k")
    core = bins.withColumn("nearer", nearer).filter(F.col("nearer") < F.ceil(CORE * F.col("n")))
    return estimates(core.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in names)), F.lit(False))


def concentrated(stats: DataFrame) -> DataFrame:
    """The final estimates (best) of each group and start, and the steps taken.

    The state after each step of 1, 2, 4, ... is kept as seen: a later one equal
    to it closes a cycle, and best is the least since then."""
    def small(df: DataFrame) -> DataFrame:
        return scratch(df.coalesce(GROUP_TASKS), "mcd", compression="none")

    whole = stats.groupBy(F.col("lang").alias("glang"), F.col("source").alias("gsource")).agg(*moment_sums())
    whole = whole.withColumn("n", F.col("k")).withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    est = F.struct(*ESTIMATES)
    now = small(estimates(whole, F.col("start") == 1).select(*KEYS, est.alias("est"), est.alias("seen"), est.alias("best"), F.lit(0).alias("steps"), F.lit(False).alias("done")))
    moving = now.count()
    for step in range(1, STEPS + 1):
        if not moving:
            return now.select(*KEYS, "best", "steps")
        going = now.filter("not done")
        to = concentration_step(stats, going.select(*KEYS, "est.*")).select(*(F.col(c).alias(f"to_{c}") for c in KEYS), est.alias("to"))
        same = F.col("start") == F.col("to_start")
        for c in ("glang", "gsource"):
            same = same & F.col(c).eqNullSafe(F.col(f"to_{c}"))
        moved = going.join(to, same).withColumn("stays", F.col("to") == F.col("est")).withColumn("done", F.col("stays") | (F.col("to") == F.col("seen")))
        moved = moved.withColumn("best", F.when(F.col("stays"), F.col("to")).otherwise(F.least("best", "to")))
        if step & (step - 1) == 0:
            moved = moved.select(*KEYS, "to", "done", *(F.when(F.col("done"), F.col(c)).otherwise(F.col("to")).alias(c) for c in ("seen", "best")))
        moved = moved.select(*KEYS, F.col("to").alias("est"), "seen", "best", F.lit(step).alias("steps"), "done")
        now = small(moved.union(now.filter("done")))
        moving = now.filter("not done").count()
    raise RuntimeError(f"the estimates of {moving} groups and starts don't repeat within {STEPS} concentration steps")


def covariance_determinants(stats: DataFrame) -> DataFrame:
    """Estimates of each (lang, source) from rows with the columns z1..z4."""
    best = concentrated(stats).select(*KEYS, "best.*").groupBy("glang", "gsource").agg(F.min(F.struct("det", "start", *ESTIMATES[1:])).alias("e"))
    return scratch(best.select("glang", "gsource", "e.*").drop("start", "det").coalesce(GROUP_TASKS), "mcd", compression="none")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", keep_row: bool = False) -> DataFrame:
    """One row per document: id, the statistics, base_failed, distance (null
    where base_failed) and kept; keep_row: the input row as a struct."""
    columns = [F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("txt")]
    row = [F.struct("*").alias("row")] if keep_row else []
    measured = text_statistics(docs.select(*columns, *row), "txt").withColumn("base_failed", base_failed()).select("*", *vectors())
    stats = scratch(measured, "stats")
    groups = covariance_determinants(stats.drop("row").filter("not base_failed"))
    judged = stats.join(groups, same_group(), "left").withColumn("distance", F.when(~F.col("base_failed"), distance()))
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= LIMIT)
    out = ["id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "distance"]
    return judged.select(*out, kept.alias("kept"), *(["row"] if keep_row else []))
