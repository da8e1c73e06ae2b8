"""Quality rules: word statistics and robust multivariate outliers.

Every document becomes a vector of transformed statistics. Per language and source a
minimum-covariance-determinant estimate (concentration steps from deterministic
starts) gives centre and scatter, and a document whose Mahalanobis distance lies past a
chi-square cut-off is rejected. All of it is Column functions: no Python runs on rows.

Defined cases: a null or empty text has no words and fails the base rules; null language
or source form a group of their own; a group with fewer than ``min_rows`` eligible rows is
pooled with the small groups of its language, then of all; a pool still smaller rejects nothing.
Ties and repeated rows count as often as they come. All input columns stay, and a clash of
names keeps the input column and raises no error in ``keep_quality``.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.llm.common import free_name, once, small, stored, text_or_empty

SPACE = " \t\n\x0b\f\r"
SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

#: Smallest scale of each statistic: differences below it never make an outlier.
FLOORS = {"length": 1.0, "word_length": 0.12, "symbols": 0.3, "lines": 0.5, "repeats": 0.5}


def _trimmed(col: Column) -> Column:
    return F.trim(col, F.lit(SPACE))


def word_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed.

    ``text`` itself is dropped on the way only if the caller selects it away."""
    keep = [c for c in df.columns]
    t, trimmed = free_name(df, "t_"), free_name(df, "s_")
    out = once(df, *keep, **{t: text_or_empty(text)})
    out = once(out, *keep, t, **{trimmed: _trimmed(F.col(t))})
    words = F.when(F.col(trimmed) == "", F.expr("cast(array() as array<string>)")).otherwise(
        F.split(F.col(trimmed), SPLIT, -1)
    )
    lines = F.filter(F.split(F.col(t), "\n", -1), lambda x: _trimmed(x) != "")
    out = once(
        out,
        *keep,
        words_=words,
        lines_=F.when(F.instr(F.col(trimmed), "\n") > 0, lines).otherwise(F.expr("cast(array() as array<string>)")),
        n_symbols=F.regexp_count(F.col(t), F.lit(SYMBOLS)).cast("long"),
    )
    n = F.size("words_")
    # position bits: the smallest power of two not below the number of words
    out = once(
        out,
        *keep,
        "words_",
        "n_symbols",
        n_words=n.cast("long"),
        word_chars=F.length(F.array_join("words_", "")).cast("long"),
        n_lines=F.size("lines_").cast("long"),
        n_dup_lines=(F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long"),
        bits_=F.expr("shiftleft(1L, cast(ceil(log2(greatest(size(words_), 2))) as int))"),
    )
    # each 3-word window as one number, hash above and position below, so that one
    # sort of plain numbers brings equal windows together; others may come along, the more the longer the text
    window = "(xxhash64(words_[i], words_[i + 1], words_[i + 2]) & -bits_) | cast(i as bigint)"
    out = once(
        out,
        *out.columns,
        windows_=F.expr(
            f"case when n_words < 4 then cast(array() as array<bigint>) else "
            f"sort_array(transform(sequence(0, cast(n_words as int) - 3), i -> {window})) end"
        ),
    )
    same = "(x & -bits_) = (windows_[i {0} 1] & -bits_)"
    again = (
        f"filter(windows_, (x, i) -> case when i > 0 and {same.format('-')} then true "
        f"when i < size(windows_) - 1 then {same.format('+')} else false end)"
    )
    # only these are compared word by word
    told = "named_struct('a', words_[p], 'b', words_[p + 1], 'c', words_[p + 2], 'p', p)"
    out = once(
        out,
        *(c for c in out.columns if c != "windows_"),
        alike_=F.expr(f"sort_array(transform(transform({again}, x -> cast(x & (bits_ - 1) as int)), p -> {told}))"),
    )
    equal = "(x.a = alike_[i {0} 1].a and x.b = alike_[i {0} 1].b and x.c = alike_[i {0} 1].c)"
    repeated = (
        f"filter(alike_, (x, i) -> case when i > 0 and {equal.format('-')} then true "
        f"when i < size(alike_) - 1 then {equal.format('+')} else false end)"
    )
    out = once(
        out,
        *(c for c in out.columns if c not in ("alike_", "words_")),
        places_=F.expr(f"sort_array(transform({repeated}, x -> cast(x.p as bigint)))"),
    )
    covered = F.expr(
        "aggregate(places_, named_struct('n', 0L, 'end', -1L), "
        "(a, p) -> named_struct('n', a.n + p + 3 - greatest(p, a.end), 'end', p + 3), a -> a.n)"
    )
    out = once(out, *(c for c in out.columns if c not in ("places_", "bits_")), n_repeat_words=covered)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def statistic_vector() -> dict[str, Column]:
    """The transformed statistics, smoothed so that short texts vary no more than long ones."""
    n, lines = F.col("n_words").cast("double"), F.col("n_lines").cast("double")
    return {
        "length": F.log1p(n),
        "word_length": F.log((F.col("word_chars") + 250.0) / (n + 50.0)),
        "symbols": F.sqrt(F.col("n_symbols") / (n + 10.0)),
        "lines": F.sqrt(F.col("n_dup_lines") / (lines + 3.0)),
        "repeats": F.sqrt(F.col("n_repeat_words") / (n + 10.0)),
    }


def chi_square(p: int, q: float) -> float:
    """Quantile of the chi-square distribution (Wilson-Hilferty)."""
    return p * (1 - 2 / (9 * p) + NormalDist().inv_cdf(q) * (2 / (9 * p)) ** 0.5) ** 3


def _groups(rows: DataFrame, lang: str, source: str, min_rows: int) -> DataFrame:
    """Adds ``group_``: language and source, or a pool where that has too few eligible rows."""
    one = F.to_json(F.struct(F.col(lang).alias("l"), F.col(source).alias("s")))
    rows = rows.withColumn("own_", one).withColumn("lang_", F.to_json(F.struct(F.col(lang).alias("l"))))
    sizes = rows.groupBy("own_", "lang_").agg(F.count_if(~F.col("base_failed")).alias("n"))
    large = F.col("n") >= min_rows
    of_lang = sizes.where(~large).groupBy("lang_").agg(F.sum("n").alias("m"))
    names = sizes.join(of_lang, "lang_", "left").select(
        F.col("own_").alias("own2_"),
        F.when(large, F.col("own_")).when(F.col("m") >= min_rows, F.col("lang_")).otherwise(F.lit("*")).alias("group_"),
    )
    names = small(stored(names, "quality-groups"))
    return rows.join(names, F.col("own_") == F.col("own2_"), "left").drop("own_", "own2_", "lang_")


def _scatter(rows: DataFrame, keys: list[str], y: list[str], ridge: float) -> DataFrame:
    """Mean, inverse of the regularised covariance and its log determinant per group of ``rows``."""
    p = len(y)
    sums = [F.avg(c).alias(f"m_{c}") for c in y]
    cross = [F.avg(F.col(a) * F.col(b)).alias(f"c_{i}_{j}") for i, a in enumerate(y) for j, b in enumerate(y) if i <= j]
    got = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_used"), *sums, *cross)

    def entry(i: int, j: int) -> Column:
        i, j = min(i, j), max(i, j)
        cov = F.col(f"c_{i}_{j}") - F.col(f"m_{y[i]}") * F.col(f"m_{y[j]}")
        return cov * (1 - ridge) + F.lit(ridge if i == j else 0.0)

    matrix = F.array(*(F.array(*(entry(i, j) for j in range(p))) for i in range(p)))
    got = once(got, *keys, "n_used", centre=F.array(*(F.col(f"m_{c}") for c in y)), a0=matrix)
    sweep = (
        "transform(s.a, (row, i) -> transform(row, (v, j) -> case "
        "when i = k and j = k then -1 / s.a[k][k] "
        "when i = k then v / s.a[k][k] when j = k then v / s.a[k][k] "
        "else v - s.a[i][k] * s.a[k][j] / s.a[k][k] end))"
    )
    got = once(
        got,
        *keys,
        "n_used",
        "centre",
        swept=F.expr(
            f"aggregate(sequence(0, {p - 1}), named_struct('a', a0, 'd', 0D), "
            f"(s, k) -> named_struct('a', {sweep}, 'd', s.d + ln(s.a[k][k])), s -> s)"
        ),
    )
    return got.select(*keys, "n_used", "centre", F.col("swept.a").alias("minus_inverse"), F.col("swept.d").alias("log_det"))


def _distance(y: list[str]) -> Column:
    """Squared Mahalanobis distance of the row's ``y`` from ``centre``."""
    diff = [F.col(c) - F.col("centre")[i] for i, c in enumerate(y)]
    total = F.lit(0.0)
    for i in range(len(y)):
        for j in range(i, len(y)):
            total = total - diff[i] * diff[j] * F.col("minus_inverse")[i][j] * (1.0 if i == j else 2.0)
    return total


def covariance_outliers(
    stats: DataFrame,
    lang: str = "lang",
    source: str = "source",
    part: float = 0.75,
    steps: int = 4,
    min_rows: int = 100,
    ridge: float = 0.1,
    clean_share: float = 0.999999,
) -> DataFrame:
    """``stats`` (rows of ``word_statistics``) with ``group_``, ``distance2`` and ``kept``.

    The subset of share ``part`` with least covariance determinant is sought by ``steps``
    concentration steps from two deterministic starts (robust distance over all statistics,
    and over all but length); the start with the lower determinant is used. ``ridge`` mixes the
    scatter with the identity in units of ``FLOORS`` or the median absolute deviation, so that
    statistics that are constant in a group stay invertible."""
    vector = statistic_vector()
    names = list(vector)
    y = [f"y_{n}" for n in names]
    # written once: every later step reads numbers, not texts
    rows = stored(stats.withColumns({f"x_{n}": c for n, c in vector.items()}), "quality-rows")
    rows = _groups(rows, lang, source, min_rows)
    fit = rows.where(~F.col("base_failed")).select("group_", *(f"x_{n}" for n in names))
    middle = fit.groupBy("group_").agg(
        F.count(F.lit(1)).alias("n_fit"), *(F.percentile_approx(f"x_{n}", 0.5, 1000).alias(f"mid_{n}") for n in names)
    )
    middle = small(stored(middle, "quality-middle"))
    spread = fit.join(middle, "group_").groupBy("group_", "n_fit", *(f"mid_{n}" for n in names)).agg(
        *(F.percentile_approx(F.abs(F.col(f"x_{n}") - F.col(f"mid_{n}")), 0.5, 1000).alias(f"mad_{n}") for n in names)
    )
    scales = small(stored(spread, "quality-scales"))

    def scaled(df: DataFrame) -> DataFrame:
        unit = {n: F.greatest(F.col(f"mad_{n}") * 1.4826, F.lit(FLOORS[n])) for n in names}
        return df.join(scales, "group_", "left").withColumns(
            {f"y_{n}": (F.col(f"x_{n}") - F.col(f"mid_{n}")) / unit[n] for n in names}
        )

    fit = scaled(fit).where(F.col("n_fit") >= min_rows).select("group_", *y)
    starts = F.array(
        F.struct(F.lit(0).alias("start"), sum((F.col(c) ** 2 for c in y), F.lit(0.0)).alias("d2")),
        F.struct(F.lit(1).alias("start"), sum((F.col(c) ** 2 for c in y[1:]), F.lit(0.0)).alias("d2")),
    )
    fit = stored(fit.select("group_", *y, F.inline(starts)), "quality-fit")
    keys = ["group_", "start"]
    near = fit
    for step in range(steps + 1):
        cut = near.groupBy(*keys).agg(F.percentile_approx("d2", [part, 0.5], 1000).alias("cut"))
        cut = small(stored(cut, f"quality-cut{step}"))
        chosen = near.join(cut, keys).where(F.col("d2") <= F.col("cut")[0])
        model = small(stored(_scatter(chosen, keys, y, ridge), f"quality-model{step}"))
        near = fit.drop("d2").join(model, keys).withColumn("d2", _distance(y)).select(*keys, *y, "d2")
    # consistency: the median distance of the fitted rows is that of a chi-square
    middle_of = near.groupBy(*keys).agg(F.percentile_approx("d2", 0.5, 1000).alias("d2_mid"))
    best = (
        model.join(middle_of, keys)
        .groupBy("group_")
        .agg(F.min_by(F.struct("centre", "minus_inverse", "log_det", "d2_mid"), F.struct("log_det", "start")).alias("b"))
        .select("group_", "b.*")
    )
    best = small(stored(best, "quality-best"))
    p = len(y)
    scale = F.greatest(F.col("d2_mid") / chi_square(p, 0.5), F.lit(1.0))
    out = scaled(rows).join(best, "group_", "left").withColumn("distance2", _distance(y) / scale)
    fine = F.coalesce(F.col("distance2") <= chi_square(p, clean_share), F.lit(True))
    extra = {f"{a}_{n}" for n in names for a in ("x", "y", "mid", "mad")} | {"centre", "minus_inverse", "log_det", "d2_mid", "n_fit"}
    return out.withColumn("kept", ~F.col("base_failed") & fine).drop(*extra)


def keep_quality(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with its columns only."""
    body = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(body.alias("doc"), F.col("text"), F.col("lang"), F.col("source"))
    judged = covariance_outliers(word_statistics(rows).drop("text"), **options)
    return judged.where("kept").select("doc.*")
