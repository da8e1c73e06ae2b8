"""Secret scans: fixed patterns plus character Markov models.

Two first-order models over characters, one of random strings and one of ordinary
identifiers, are trained from labelled samples: the values that the patterns find are random, and the distinct
shorter runs of letters and digits of all texts are ordinary, each once and also in capitals, with a capital, and doubled with a
capital between, as identifiers are put together. A long run of token characters is a secret if the mean log-likelihood ratio of
its transitions exceeds a threshold, which is chosen on samples that the models have not seen. Transitions say nothing that lead
to or from a sign between words, from digit to digit, or to the same character, and a run needs ``MIN_SCORED`` that do: so rules of hyphens,
numbers, dates and paths are no secrets. UUIDs are none by their shape. All of it is
Column functions: places of matches come from the pieces between them, so no Python runs on rows.

Defined cases: null and empty texts have no spans; a text that is one match is one span; a model trained from no samples is
uniform, so that with no samples at all nothing is added to the
patterns. A run that lies within one span of the patterns adds nothing; one that goes beyond it is judged as a whole.
Only a row's key columns and text travel; other columns may have any names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.llm.common import once, stored, text_or_empty

#: Fixed patterns, in the order in which kinds are listed.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the 4 letters and 16 more; a shorter run holds no longer one
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

#: Characters the models know; all others are one more symbol, numbered 0. Digits come last.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
SIZE = len(ALPHABET) + 1
FIRST_DIGIT = ALPHABET.index("0") + 1
MIN_RUN = 20
MIN_SCORED = 8
CANDIDATE = r"[A-Za-z0-9+/_=-]{" + str(MIN_RUN) + ",}"
ORDINARY = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9]{4," + str(MIN_RUN - 1) + r"}(?![A-Za-z0-9+/_=-])"
UUID = "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
#: Where there are too few samples to choose, and the least that is chosen.
DEFAULT_THRESHOLD, LEAST_THRESHOLD = 2.0, 1.0

SPAN = "struct<start:bigint,kind:int,end:bigint>"
NO_SPANS = f"cast(array() as array<{SPAN}>)"


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def base_spans(df: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """``keep`` with ``assign``, ``access``, ``hex`` (arrays of spans), ``values`` (the secrets
    themselves) and ``runs`` (long runs of token characters that lie within no span, with their text)."""
    rows = once(df, *keep, t_=text_or_empty(text))
    none = F.expr("cast(array() as array<string>)")
    has = {
        "assign": F.col("t_").contains("=") | F.col("t_").contains(":"),
        "access": F.col("t_").contains("AKIA"),
        "hex": F.lit(True),
        "runs": F.lit(True),
    }
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "runs": CANDIDATE}
    found = {
        f"{k}_m": F.when(has[k], F.expr(f"regexp_extract_all(t_, {_quoted(p)}, 0)")).otherwise(none)
        for k, p in patterns.items()
    }
    rows = once(rows, *keep, "t_", **found)
    pieces = {
        f"{k}_p": F.when(F.size(f"{k}_m") > 0, F.expr(f"split(t_, {_quoted(p)}, -1)")).otherwise(none)
        for k, p in patterns.items()
    }
    second = F.when(F.size("assign_m") > 0, F.expr(f"regexp_extract_all(t_, {_quoted(ASSIGN)}, 2)")).otherwise(none)
    rows = once(rows, *keep, *found, second=second, **pieces)

    def places(name: str, kind: int) -> Column:
        return F.expr(
            f"aggregate({name}_m, named_struct('k', 0, 'at', 0L, 'out', {NO_SPANS}), "
            f"(a, m) -> named_struct('k', a.k + 1, 'at', a.at + length({name}_p[a.k]) + length(m), 'out', "
            f"concat(a.out, array(named_struct('start', a.at + length({name}_p[a.k]), 'kind', {kind}, "
            f"'end', a.at + length({name}_p[a.k]) + length(m))))), a -> a.out)"
        )

    rows = once(
        rows, *keep, "second", "access_m", "hex_m", "runs_m",
        assign_all=places("assign", 0), access=places("access", 1), hex=places("hex", 2), runs_all=places("runs", 3),
    )
    rows = once(
        rows, *keep, "access", "hex", "runs_m", "runs_all",
        assign=F.expr("filter(assign_all, (x, i) -> length(second[i]) >= 6)"),
        values=F.expr("concat(filter(second, x -> length(x) >= 6), access_m, hex_m)"),
    )
    rows = once(rows, *keep, "assign", "access", "hex", "values", "runs_m", "runs_all", base=F.concat("assign", "access", "hex"))
    free = (
        "filter(transform(runs_all, (x, i) -> named_struct('start', x.start, 'end', x.end, 'run', runs_m[i])), "
        f"x -> not exists(base, b -> b.start <= x.start and x.end <= b.end) and not x.run rlike '{UUID}')"
    )
    return rows.select(*keep, "assign", "access", "hex", "values", "base", F.expr(free).alias("runs"))


# --------------------------------------------------------------------------
# Models
# --------------------------------------------------------------------------
def _codes(value: str) -> str:
    """Numbers of the characters of ``value``."""
    return f"transform(filter(split({value}, ''), c -> c <> ''), c -> cast(instr('{ALPHABET}', c) as int))"


def neutral(a: int, b: int) -> bool:
    """Does a transition between these two numbers of characters say nothing?"""
    return not a or not b or a == b or (a >= FIRST_DIGIT and b >= FIRST_DIGIT)


def train_models(samples: DataFrame, random: str = "random", value: str = "value", prior: float = 20.0) -> list[float]:
    """Log-likelihood ratio, random against ordinary, of each transition (row-wise, SIZE by SIZE; 0: says nothing).

    Transitions are smoothed towards the model's single characters, as much as ``prior`` observations; the random model
    is half uniform, since secrets of other alphabets than those of the samples are random, too.
    ``samples`` holds a boolean ``random`` and the string. The table that reaches the driver has
    one row per model and transition, whatever the number of samples."""
    known = samples.where(F.col(random).isNotNull() & F.col(value).isNotNull())
    coded = once(known, random, codes=F.expr(_codes(value)))
    pairs = coded.where(F.size("codes") > 1).select(
        random, F.explode(F.expr(f"transform(sequence(1, size(codes) - 1), i -> codes[i - 1] * {SIZE} + codes[i])")).alias("pair")
    )
    counts = {(r[0], r[1]): r[2] for r in pairs.groupBy(random, "pair").count().collect()}

    def shares(model: bool) -> list[float]:
        rows = [[0 if neutral(a, b) else counts.get((model, a * SIZE + b), 0) for b in range(SIZE)] for a in range(SIZE)]
        seen = [sum(row[b] for row in rows) for b in range(SIZE)]
        single = [(n + 1) / (sum(seen) + SIZE) for n in seen]
        return [(n + prior * p) / (sum(row) + prior) for row in rows for n, p in zip(row, single)]

    if not counts:
        return [0.0] * SIZE**2
    ratios = (math.log((r + 1 / SIZE) / 2 / o) for r, o in zip(shares(True), shares(False)))
    return [0.0 if neutral(*divmod(k, SIZE)) else x for k, x in enumerate(ratios)]


def labelled_samples(rows: DataFrame, texts: DataFrame, text: str = "text") -> DataFrame:
    """``(random, value, seen)`` from the ``values`` of ``base_spans`` and all texts; the models are trained on those ``seen``.

    Words are brought down to the distinct ones before anything is counted."""
    values = rows.select(F.explode("values").alias("value")).distinct()
    words = texts.select(F.explode(F.regexp_extract_all(text_or_empty(text), F.lit(ORDINARY), F.lit(0))).alias("value"))
    words = words.distinct().join(values, "value", "left_anti").where(~F.col("value").rlike("^[0-9]+$"))
    seen = (F.pmod(F.xxhash64("value"), F.lit(5)) > 0).alias("seen")
    named = words.select(F.lit(False).alias("random"), "value", seen).unionByName(values.select(F.lit(True).alias("random"), "value", seen))
    return stored(named, "secrets-samples")


def _forms(samples: DataFrame) -> DataFrame:
    """Ordinary samples as they occur in identifiers."""
    title = F.initcap("value")
    forms = F.when(F.col("random"), F.array("value")).otherwise(
        F.array_distinct(F.array(F.col("value"), F.upper("value"), title, F.concat(F.col("value"), title)))
    )
    return samples.select("random", F.explode(forms).alias("value"))


def _as_runs(samples: DataFrame) -> DataFrame:
    """Ordinary samples put together, as long runs hold several words."""
    title = F.initcap("value")
    return samples.select("random", F.when(F.col("random"), F.col("value")).otherwise(F.concat_ws("_", "value", title, F.upper("value"))).alias("value"))


def choose_threshold(unseen: DataFrame, table: list[float]) -> float:
    """A quarter of the way from the score that one in a thousand ordinary samples exceeds to that which one in twenty
    random ones falls short of: nearer to the ordinary side, as secrets of other alphabets score lower than the samples."""
    scored = unseen.select("random", _score(F.col("value"), table).alias("score"))
    row = scored.agg(
        F.percentile_approx(F.when(~F.col("random"), F.col("score")), 0.999, 10_000).alias("o"),
        F.percentile_approx(F.when(F.col("random"), F.col("score")), 0.05, 10_000).alias("r"),
    ).first()
    if row.o is None or row.r is None or row.r <= row.o:
        return DEFAULT_THRESHOLD
    return max(LEAST_THRESHOLD, row.o + (row.r - row.o) / 4)


def find_secrets(
    df: DataFrame, *keep: str, text: str = "text", samples: DataFrame | None = None, threshold: float | None = None,
) -> DataFrame:
    """``keep`` and ``spans``: array of (start, kind, end) by start, then kind, ``base`` those of the patterns.

    ``samples`` (random, value) train the models; without them, the values the patterns find are
    the random strings and the shorter runs of all texts the ordinary ones."""
    rows = stored(base_spans(df, *keep, text=text), "secrets")
    if samples is None:
        named = labelled_samples(rows, df, text)
        table = train_models(_forms(named.where("seen")))
        unseen = _as_runs(named.where("not seen"))
    else:
        unseen = F.pmod(F.xxhash64("value"), F.lit(5)) == 0
        table, unseen = train_models(samples.where(~unseen)), samples.where(unseen)
    limit = choose_threshold(unseen, table) if threshold is None else threshold
    scored = once(rows, *keep, "assign", "access", "hex", "base", found=F.filter("runs", lambda x: _score(x["run"], table) > limit))
    spans = "array_sort(concat(base, transform(found, x -> named_struct('start', x.start, 'kind', 3, 'end', x.end))))"
    return scored.select(*keep, "assign", "access", "hex", F.expr("array_sort(base)").alias("base"), F.expr(spans).alias("spans"))


def _score(run: Column, table: list[float]) -> Column:
    """Mean ratio of the transitions that say something; null if they are too few."""
    numbers = F.split(F.lit(",".join(f"{x:.6g}" for x in table)), ",").cast("array<double>")
    codes = F.transform(F.filter(F.split(run, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c).cast("int"))
    place = F.transform(
        F.slice(F.arrays_zip(codes.alias("a"), F.slice(codes, 2, 1 << 30).alias("b")), 1, F.greatest(F.size(codes) - 1, F.lit(0))),
        lambda p: numbers[p["a"] * SIZE + p["b"]],
    )
    start = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n"))
    add = lambda a, x: F.struct((a["s"] + x).alias("s"), (a["n"] + F.when(x != 0, 1).otherwise(0)).alias("n"))
    return F.aggregate(place, start, add, lambda a: F.when(a["n"] >= MIN_SCORED, a["s"] / a["n"]))


def spans_text(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(
        f"array_join(transform({spans}, x -> concat(array({names})[x.kind], ':', cast(x.start as string), ':', cast(x.end as string))), ',')"
    )


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[secret]", **options) -> DataFrame:
    """``docs`` with every span (overlapping ones merged) replaced by ``mark``; ``n_chars`` follows."""
    body = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(body.alias("doc"), F.col(text).alias("text"))
    found = find_secrets(rows, "doc", text="text", **options)
    merged = F.expr(
        "aggregate(spans, named_struct('out', cast('' as string), 'at', 0L), (a, s) -> case "
        "when s.end <= a.at then a "
        f"when s.start < a.at or (s.start = a.at and a.at > 0) then named_struct('out', a.out, 'at', s.end) "
        "else named_struct('out', concat(a.out, substring(t_, cast(a.at + 1 as int), cast(s.start - a.at as int)), "
        f"'{mark}'), 'at', s.end) end, "
        "a -> concat(a.out, substring(t_, cast(a.at + 1 as int))))"
    )
    found = once(found, "doc", "spans", t_=F.col("doc")[text].cast("string"))
    found = once(found, "doc", "spans", new_=F.when(F.size("spans") > 0, merged).otherwise(F.col("t_")))

    def column(name: str) -> Column:
        if name == text:
            return F.col("new_").alias(name)
        if name == "n_chars":
            kind = docs.schema[name].dataType
            return F.when(F.size("spans") > 0, F.length("new_").cast(kind)).otherwise(F.col("doc")[name]).alias(name)
        return F.col("doc")[name].alias(name)

    return found.select(*(column(c) for c in docs.columns))
