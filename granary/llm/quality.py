"""Quality rules: plain counts with limits, and robust multivariate outliers per language and source.

The counts of a text become a vector of transformed statistics.  For every group of language and source
the minimum covariance determinant estimate (the mean and scatter of that share of the rows which lies
tightest) is found by concentration steps from two fixed starts: rank all rows by their distance, keep
the nearest share, estimate again.  A text is rejected when its squared Mahalanobis distance, given its
length, exceeds a chi-square quantile.

Only DataFrame functions run here.  Every step is one aggregation with partial results before its
shuffle, so a group that holds a third of all rows costs as much as many small ones; what is iterated is
a staged table of a few numbers per document, never the text.
"""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.session import stage

SPACE = " \t\n\x0b\f\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Limits of the base rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Bits of a packed window that hold its place; texts with more words take the slower exact form.
PLACE_BITS = 24

#: Statistics: the length, which the others are judged against, then those that are judged.
STATISTICS = ("length", "distinct", "word_length", "symbols", "dup_lines", "repeats", "line_length")
#: What a statistic counts in the shortest text that is judged: words, characters at five to a word, lines of
#: five words, places of repeated windows of three.
UNITS = (MIN_WORDS, MIN_WORDS, 5 * MIN_WORDS, 5 * MIN_WORDS, MIN_WORDS / 5, MIN_WORDS / 3, MIN_WORDS / 5)
#: Standard deviation below which no statistic is taken to vary: that of the square root of a share of n units
#: from counting alone, 1 / (2 sqrt(n)), so that one occurrence is no outlier where a group has none.
FLOORS = tuple(0.5 / math.sqrt(n) for n in UNITS)
#: Share of a group's rows that the estimate rests on.
CORE = 0.75
#: Chance that a text of a normal group is rejected; the README has the share of labelled good texts.
REJECTED = 1e-3
#: Rows that a group needs for an estimate of its own; smaller ones are pooled by language, then all, and if these
#: are still too few they are judged by the estimate of all rows.
MIN_GROUP = 20 * len(STATISTICS)
#: Rank accuracy of the quantiles, as a share 1/ACCURACY of a group.
ACCURACY = 10_000
#: Steps of an estimate, which gets tighter with each; it is used as it then is, settled or not.
MAX_STEPS, SETTLED = 8, 1e-3
#: Groups (of a few hundred bytes each) whose estimates are sent to every task.
BROADCAST_GROUPS = 20_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``COUNTS``, ``n_distinct`` words and ``n_lines`` with a word (their names are taken
    by the new columns); a null text has no words.  Linear in the length of a text but for one sort."""
    words = F.split(F.btrim("_q_text", F.lit(SPACE)), WORD_BREAK)
    lines = F.filter(F.split("_q_text", "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    place = F.lit((1 << PLACE_BITS) - 1).cast("bigint")
    packed = F.transform(
        F.slice("_q_words", 1, F.greatest(F.size("_q_words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("_q_words", i + 1), F.get("_q_words", i + 2))
        .bitwiseAND(F.bitwise_not(place)).bitwiseOR(i.cast("bigint")),
    )
    hashed = lambda x: F.shiftright(x, PLACE_BITS)
    beside = lambda x, i, step: F.coalesce(hashed(x) == hashed(F.get("_q_sorted", i + step)), F.lit(False))
    repeated = F.filter("_q_sorted", lambda x, i: beside(x, i, -1) | beside(x, i, 1))
    at = lambda k: F.get("_q_repeated", k).bitwiseAND(place).cast("int")
    same_words = lambda a, b: F.concat_ws(" ", F.slice("_q_words", a + 1, 3)) == F.concat_ws(" ", F.slice("_q_words", b + 1, 3))
    clash = F.exists(
        F.sequence(F.lit(0), F.size("_q_repeated") - 2),
        lambda k: (hashed(F.get("_q_repeated", k)) == hashed(F.get("_q_repeated", k + 1))) & ~same_words(at(k), at(k + 1)),
    )
    places = F.transform("_q_repeated", lambda x: x.bitwiseAND(place).cast("int"))
    exactly = (F.size("_q_words") >= 1 << PLACE_BITS) | ((F.size("_q_repeated") > 1) & clash)
    return (
        docs.withColumn("_q_text", F.coalesce(F.col(text), F.lit("")))
        .withColumn("_q_words", F.filter(words, lambda w: w != ""))
        .withColumn("_q_lines", lines)
        .withColumn("_q_sorted", F.sort_array(packed))
        .withColumn("_q_repeated", repeated)
        .withColumn("_q_places", F.when(exactly, _repeated_places()).otherwise(places))
        .withColumns({
            "n_words": F.size("_q_words").cast("bigint"),
            "word_chars": F.char_length(F.array_join("_q_words", "")).cast("bigint"),
            "n_symbols": F.regexp_count("_q_text", F.lit(SYMBOLS)).cast("bigint"),
            "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("bigint"),
            "n_repeat_words": F.size(F.array_distinct(F.flatten(
                F.transform("_q_places", lambda p: F.array(p, p + 1, p + 2))
            ))).cast("bigint"),
            "n_distinct": F.size(F.array_distinct("_q_words")).cast("bigint"),
            "n_lines": F.size("_q_lines").cast("bigint"),
        })
        .drop("_q_text", "_q_words", "_q_lines", "_q_sorted", "_q_repeated", "_q_places")
    )


def _repeated_places() -> Column:
    """Places of repeated windows by their words, for the rare text whose packed hashes do not tell."""
    windows = F.transform(
        F.slice("_q_words", 1, F.greatest(F.size("_q_words") - 2, F.lit(0))),
        lambda w, i: F.struct(F.concat_ws(" ", w, F.get("_q_words", i + 1), F.get("_q_words", i + 2)).alias("w"), i.alias("i")),
    )
    marked = F.aggregate(
        F.sort_array(windows),
        F.struct(F.lit(None).cast("string").alias("w"), F.lit(0).alias("i"), F.array().cast("array<int>").alias("found")),
        lambda last, x: F.struct(
            x["w"].alias("w"), x["i"].alias("i"),
            F.when(x["w"] == last["w"], F.concat(last["found"], F.array(last["i"], x["i"]))).otherwise(last["found"]).alias("found"),
        ),
    )
    return F.array_distinct(marked["found"])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _vector() -> Column:
    """The transformed statistics of a row with words: logarithms of sizes, square roots of shares."""
    root = lambda part, whole: F.sqrt(F.col(part) / F.col(whole))
    return F.array(
        F.log("n_words"), F.log("n_distinct"), F.log(F.col("word_chars") / F.col("n_words")),
        root("n_symbols", "word_chars"), root("n_dup_lines", "n_lines"), root("n_repeat_words", "n_words"),
        F.log(F.col("n_words") / F.col("n_lines")),
    )


# --- estimates --------------------------------------------------------------------------------

SIZE = len(STATISTICS)
PAIRS = list(combinations_with_replacement(range(SIZE), 2))
KEY = ["grp", "start"]


def _moments() -> list[Column]:
    """Mean and scatter of ``x1..``; a row alone has no scatter beyond the floors."""
    means = [F.avg(f"x{i}").alias(f"m{i}") for i in range(SIZE)]
    return means + [F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i, j in PAIRS]


def _inverted(moments: DataFrame, keep: list[str]) -> DataFrame:
    """Means, the inverse of the lower Cholesky factor of the scatter (floors added) and its log
    determinant, one column per entry; each line of the factor is a projection of its own."""
    frame = moments
    for j in range(SIZE):
        line = {}
        for i in range(j, SIZE):
            value = F.col(f"c{j}_{i}") + (F.lit(FLOORS[j] ** 2) if i == j else F.lit(0.0))
            for k in range(j):
                value = value - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            line[f"s{i}"] = value
        frame = frame.withColumns(line).withColumn(f"l{j}_{j}", F.sqrt(f"s{j}"))
        frame = frame.withColumns({f"l{i}_{j}": F.col(f"s{i}") / F.col(f"l{j}_{j}") for i in range(j + 1, SIZE)})
    for j in range(SIZE):
        frame = frame.withColumn(f"w{j}_{j}", 1 / F.col(f"l{j}_{j}"))
        for i in range(j + 1, SIZE):
            total = F.lit(0.0)
            for k in range(j, i):
                total = total + F.col(f"l{i}_{k}") * F.col(f"w{k}_{j}")
            frame = frame.withColumn(f"w{i}_{j}", -total / F.col(f"l{i}_{i}"))
    volume = sum((F.log(f"l{j}_{j}") for j in range(SIZE)), F.lit(0.0))
    return frame.select(
        *keep, *[f"m{i}" for i in range(SIZE)], *[f"w{i}_{j}" for j, i in PAIRS], volume.alias("volume")
    )


def _distance(first: int = 0) -> Column:
    """Squared distance of ``x`` under ``m`` and ``w``, without what the statistics before ``first`` explain."""
    parts = []
    for i in range(first, SIZE):
        value = sum((F.col(f"w{i}_{j}") * (F.col(f"x{j}") - F.col(f"m{j}")) for j in range(i + 1)), F.lit(0.0))
        parts.append(F.pow(value, 2))
    return sum(parts, F.lit(0.0))


def _beside(rows: DataFrame, side: DataFrame, keys: list[str], groups: int, kind: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``side``, which has a row for each of ``groups`` keys (times two starts).

    A group may hold a third of all rows, so rows are not dealt out by group alone: up to
    ``BROADCAST_GROUPS`` the side, then of known size, goes to every task; beyond, rows of a group are
    spread over salts and the side is repeated for each.
    """
    if groups <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(side), keys, kind)
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(salts)))
    repeated = side.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return spread.join(repeated, [*keys, "_salt"], kind).drop("_salt")


def _nearest(rows: DataFrame, groups: int) -> DataFrame:
    """Moments of the ``CORE`` share of each group's rows with the smallest ``d``."""
    cut = rows.groupBy(*KEY).agg(F.percentile_approx("d", CORE, ACCURACY).alias("cut"))
    return _beside(rows, cut, KEY, groups).where("d <= cut").groupBy(*KEY).agg(*_moments())


def _estimates(rows: DataFrame, groups: int) -> DataFrame:
    """The tightest core of each ``grp``: ``m``, ``w`` (both scaled for a normal core) by group.

    Starts: distances from the medians in units of the median deviations, as they are, and cut off at
    one unit, which far values do not stretch.
    """
    columns = [f"x{i}" for i in range(SIZE)]
    half = lambda c: F.percentile_approx(c, 0.5, ACCURACY)
    middle = rows.groupBy("grp").agg(*[half(c).alias(f"{c}_mid") for c in columns])
    centred = _beside(rows, middle, ["grp"], groups)
    spread = centred.groupBy("grp").agg(
        *[half(F.abs(F.col(c) - F.col(f"{c}_mid"))).alias(f"{c}_mad") for c in columns]
    )
    unit = [
        F.pow((F.col(c) - F.col(f"{c}_mid")) / F.greatest(1.4826 * F.col(f"{c}_mad"), F.lit(f)), 2)
        for c, f in zip(columns, FLOORS, strict=True)
    ]
    started = _beside(centred, spread, ["grp"], groups).select("grp", *columns, F.explode(F.array(
        F.struct(F.lit(0).alias("start"), sum(unit, F.lit(0.0)).alias("d")),
        F.struct(F.lit(1).alias("start"), sum((F.least(u, F.lit(1.0)) for u in unit), F.lit(0.0)).alias("d")),
    )).alias("s")).select("grp", *columns, "s.*")
    model = stage(_inverted(_nearest(started, groups), KEY), "quality-start")
    doubled = rows.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    for _ in range(MAX_STEPS):
        ranked = _beside(doubled, model, KEY, groups).withColumn("d", _distance()).select(*KEY, *columns, "d")
        after = stage(_inverted(_nearest(ranked, groups), KEY), "quality-step")
        before = model.select(*KEY, F.col("volume").alias("before"))
        model, moved = after, after.join(before, KEY).where(F.abs(F.col("volume") - F.col("before")) > SETTLED)
        if moved.isEmpty():
            break
    best = model.groupBy("grp").agg(F.min_by(F.struct(*[c for c in model.columns if c != "grp"]), F.struct("volume", "start")).alias("best"))
    factor = 1 / math.sqrt(consistency(CORE, SIZE))
    chosen = best.select("grp", "best.*").drop("start", "volume")
    return chosen.withColumns({f"w{i}_{j}": F.col(f"w{i}_{j}") * factor for j, i in PAIRS})


def fit(counted: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """The model, one row per language and source (nulls are values of their own): ``m`` and ``w``.

    ``counted`` has the columns of ``text_counts``; rows that fail the base rules take no part.  A language
    and source with under ``MIN_GROUP`` rows shares the estimate of the small sources of its language, or
    failing that of all that is left; if even that is too small, that of all rows.  Only where all usable rows
    together are under ``MIN_GROUP``, too few to tell what is usual, ``m`` and ``w`` are null.
    """
    usable = counted.where(~base_failed()).select(F.col(lang).alias("lang"), F.col(source).alias("source"), _vector().alias("x"))
    rows = stage(usable.select("lang", "source", *[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(SIZE)]), "quality-rows")
    sizes = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = sizes.withColumn("n", F.when(F.col("n") < MIN_GROUP, F.col("n")).otherwise(0))
    pooled = small.groupBy("lang").agg(F.sum("n").alias("pool"))
    key = lambda level, *parts: F.to_json(F.struct(F.lit(level).alias("level"), *parts))
    groups = stage(
        sizes.join(pooled.withColumnRenamed("lang", "pool_lang"), F.col("lang").eqNullSafe(F.col("pool_lang")))
        .withColumn("grp", F.when(F.col("n") >= MIN_GROUP, key(0, "lang", "source")).when(F.col("pool") >= MIN_GROUP, key(1, "lang")).otherwise(key(2)))
        .select("lang", "source", "grp", "n"),
        "quality-groups",
    )
    left = groups.where(F.col("grp") == key(2)).agg(F.sum("n")).first()[0] or 0
    groups = groups.drop("n")
    columns = [f"x{i}" for i in range(SIZE)]
    named = _with(rows, groups, "lang", "source").select("grp", *columns)
    if 0 < left < MIN_GROUP:
        named = named.where(F.col("grp") != key(2)).unionByName(rows.select(key(2).alias("grp"), *columns))
    named = stage(named, "quality-vectors")
    enough = stage(named.groupBy("grp").count().where(F.col("count") >= MIN_GROUP).select("grp"), "quality-enough")
    estimated = enough.count()
    estimates = _estimates(_beside(named, enough, ["grp"], estimated), estimated)
    return stage(groups.join(estimates, "grp", "left").drop("grp"), "quality-model")


def _with(rows: DataFrame, model: DataFrame, lang: str, source: str) -> DataFrame:
    """``rows`` with what ``model`` has for their language and source; nulls are values."""
    key = lambda a, b: F.to_json(F.struct(a.alias("lang"), b.alias("source")))
    keyed = rows.withColumn("_q_key", key(rows[lang], rows[source]))
    side = model.withColumn("_q_key", key(F.col("lang"), F.col("source"))).drop("lang", "source")
    return _beside(keyed, side, ["_q_key"], model.count(), "left").drop("_q_key")


def judge(counted: DataFrame, model: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``counted`` with ``base_failed``, ``distance`` (squared, given the length; null without an estimate)
    and ``kept``.  A row whose group has no estimate is kept if it passes the base rules."""
    limit = chi_square_quantile(1 - REJECTED, SIZE - 1)
    names = [c for c in counted.columns if c not in ("base_failed", "distance", "kept")]
    held = counted.select(
        F.struct(*names).alias("_q_row"), counted[lang].alias("lang"), counted[source].alias("source"),
        base_failed().alias("base_failed"), F.when(F.col("n_words") > 0, _vector()).alias("_q_x"),
    )
    scored = _with(held, model, "lang", "source").withColumns({f"x{i}": F.get("_q_x", F.lit(i)) for i in range(SIZE)})
    return scored.select("_q_row.*", "base_failed", _distance(first=1).alias("distance")).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))
    )


# --- chi-square -------------------------------------------------------------------------------


def chi_square_below(x: float, degrees: int) -> float:
    """Distribution function: the series of the lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, x = degrees / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-17:
        n += 1
        term *= x / n
        total += term
    return min(1.0, total * math.exp(a * math.log(x) - x - math.lgamma(a)))


def chi_square_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 10.0 * degrees + 200
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_below(middle, degrees) < p else (low, middle)
    return high


def consistency(core: float, degrees: int) -> float:
    """By how much the scatter of the core of normal rows has to grow to be that of all rows."""
    return core / chi_square_below(chi_square_quantile(core, degrees), degrees + 2)
