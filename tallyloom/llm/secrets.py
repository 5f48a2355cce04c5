"""Secret scans: fixed patterns, and a battery of randomness tests; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in the order in which they are listed, their patterns, and what length counts.
PATTERNS = {
    "assign": r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{32,}",
}
KINDS = ("assign", "access", "hex", "random")
#: Matches that are walked one after the other.
RUN = 256
#: Tokens that the battery looks at: this many characters or more of these.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: Encodings a token may have: their alphabets, in order of value.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
#: Share of equal pairs of characters that written language has at least.
TEXT_COLLISIONS = 0.05


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as structs of start, end (exclusive, in code
    points) and match; the texts between them tell where they are. They are walked in runs
    of ``RUN``, so that a text of very many matches is no array grown one by one."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = (start + F.length(pair["match"])).cast("long")
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(F.struct(start.cast("long").alias("start"), end.alias("end"), pair["match"].alias("match")))).alias("spans"))

    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    pairs = F.zip_with(gaps, found, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))
    zero = F.lit(0).cast("long")

    def runs(all_pairs: Column) -> Column:
        at = F.sequence(F.lit(0), F.floor((F.size(all_pairs) - 1) / RUN).cast("int"))
        return F.transform(at, lambda i: F.aggregate(F.slice(all_pairs, i * RUN + 1, RUN), F.struct(zero.alias("at"), empty.alias("spans")), step))

    def starts(walked: Column) -> Column:
        return F.aggregate(walked, F.array(zero), lambda acc, run: F.concat(acc, F.array(F.element_at(acc, -1) + run["at"])))

    def moved(run: Column, by: Column) -> Column:
        return F.transform(run["spans"], lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["match"].alias("match")))

    joined = _let(_let(pairs, runs), lambda r: F.flatten(F.zip_with(r, F.slice(starts(r), 1, F.size(r)), moved)))
    walked = F.when(F.size(found) <= RUN, F.aggregate(pairs, F.struct(zero.alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"])).otherwise(joined)
    return F.when(F.size(found) > 0, walked).otherwise(empty)


def _normal_two_sided(z: Column) -> Column:
    """Two-sided tail of the standard normal distribution, by a rational approximation
    of the error function (Abramowitz and Stegun 7.1.26, error below 2e-7)."""
    x = F.abs(z) / F.lit(2.0**0.5)
    t = F.lit(1.0) / (F.lit(1.0) + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.least(F.lit(1.0), poly * F.exp(-x * x))


def _normal_upper(z: Column) -> Column:
    return F.when(z >= 0, _normal_two_sided(z) / 2).otherwise(1 - _normal_two_sided(z) / 2)


def encoding(token: Column) -> Column:
    """The alphabet that a token seems to be drawn from; null if it lacks digits or
    letters that all but few random tokens have."""
    digits, lower, upper = token.rlike("[0-9]"), token.rlike("[a-z]"), token.rlike("[A-Z]")
    return (
        F.when(token.rlike("^[0-9a-f]+$") & digits & lower, F.lit("hex"))
        .when(token.rlike("^[0-9A-F]+$") & digits & upper, F.lit("hex"))
        .when(token.rlike("^[A-Z2-7]+=*$") & digits, F.lit("base32"))
        .when(token.rlike("^[A-Za-z0-9+/_-]+=*$") & digits & lower & upper, F.lit("base64"))
    )


def battery(span: Column) -> Column:
    """A candidate span with the tests of its characters against random draws.

    Adds ``class`` (encoding and length, by powers of the square root of two),
    ``random_p``: three times the least p-value of the chi-squared test of uniformity,
    the runs test of the alphabet's halves and the lag-one serial correlation, and
    ``text_p``: how likely written language repeats characters as rarely.
    """
    kind = encoding(span["match"])
    alphabet = F.element_at(F.create_map(*(F.lit(x) for pair in ALPHABETS.items() for x in pair)), kind)
    body = F.translate(F.regexp_replace(span["match"], "=+$", ""), "-_", "+/")
    body = F.when(kind == "hex", F.lower(body)).otherwise(body)
    values = F.transform(F.filter(F.split(body, ""), lambda c: c != ""), lambda c: F.call_function("locate", c, alphabet) - 1)
    return F.struct(span["start"].alias("start"), span["end"].alias("end"), kind.alias("kind"), F.length(alphabet).cast("double").alias("k"), values.alias("v"))


def tested(one: Column) -> Column:
    """The p-values of a candidate that ``battery`` has prepared."""
    v, k = one["v"], one["k"]
    n = F.size(v).cast("double")
    squares = F.aggregate(F.transform(F.array_distinct(v), lambda s: F.pow(F.size(F.filter(v, lambda x: x == s)).cast("double"), F.lit(2))), F.lit(0.0), lambda a, x: a + x)
    df = k - 1
    chi = k / n * squares - n
    chi_z = (F.cbrt(F.greatest(chi, F.lit(0.0)) / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    chi_p = _normal_upper(chi_z)
    after = F.slice(v, 2, F.greatest(F.size(v) - 1, F.lit(0)))
    high = F.size(F.filter(v, lambda x: x >= k / 2)).cast("double")
    low = n - high
    runs = 1 + F.size(F.filter(F.zip_with(after, v, lambda b, a: (a >= k / 2) != (b >= k / 2)), lambda x: x)).cast("double")
    mean_runs = 2 * high * low / n + 1
    spread = F.sqrt(F.greatest(2 * high * low * (2 * high * low - n) / (n * n * (n - 1)), F.lit(1e-9)))
    runs_p = F.when((high == 0) | (low == 0), F.lit(0.0)).otherwise(_normal_two_sided((runs - mean_runs) / spread))
    mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / n
    around = F.aggregate(v, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
    lag = F.aggregate(F.zip_with(after, v, lambda b, a: F.coalesce((a - mean) * (b - mean), F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)
    serial_p = F.when(around == 0, F.lit(0.0)).otherwise(_normal_two_sided((lag / around + 1 / n) * F.sqrt(n)))
    pairs = (squares - n) / 2
    expected = n * (n - 1) / 2 * TEXT_COLLISIONS
    text_p = 1 - _normal_upper((2 * F.sqrt(pairs + 0.75) - 2 * F.sqrt(expected)))
    band = F.floor(2 * F.log2(n)).cast("int")
    return F.struct(one["start"].alias("start"), one["end"].alias("end"), F.concat_ws(":", one["kind"], band.cast("string")).alias("class"), F.least(F.lit(1.0), 3 * F.least(chi_p, runs_p, serial_p)).alias("random_p"), F.greatest(text_p, F.lit(1e-300)).alias("text_p"))


def _candidates(text: Column) -> Column:
    likely = F.filter(located(text, TOKEN), lambda s: encoding(s["match"]).isNotNull())
    return F.transform(F.transform(likely, battery), tested)


def _step_up(tally: list, column: str, rate: float) -> dict[str, float]:
    """Benjamini and Hochberg's threshold in each class, in steps of a quarter decade:
    the largest step t at which at least m * t / rate of the m p-values are."""
    out: dict[str, float] = {}
    for name in sorted({r["class"] for r in tally}):
        mine = sorted((r[column], r["n"]) for r in tally if r["class"] == name)
        m = sum(n for _, n in mine)
        steps = sorted({s for s, _ in mine}, reverse=True)  # s: floor(-4 log10 p), so p <= 10 ** (-s / 4)
        out[name] = max((10.0 ** (-s / 4) for s in steps if m * 10.0 ** (-s / 4) <= rate * sum(n for x, n in mine if x >= s)), default=0.0)
    return out


def false_discovery_limits(docs: DataFrame, text: str = "text", rate: float = 0.01) -> tuple[dict[str, float], dict[str, float]]:
    """For each class of encoding and length, the p-values up to which candidates are
    called not random, and up to which they are called not written language.

    Both hold the false discovery rate within the class, so that long tokens, of which
    the tests can tell more, do not lend their certainty to short ones. What comes to
    the driver is a histogram: a few classes, and p-values in quarter decades.
    """
    seen = docs.select(F.explode(_candidates(F.coalesce(F.col(text), F.lit("")))).alias("c"))
    step = lambda c: F.least(F.floor(-4 * F.log10(F.greatest(F.col(c), F.lit(1e-30)))), F.lit(120)).cast("int")
    tally = seen.select("c.*").groupBy("class", step("random_p").alias("random"), step("text_p").alias("language")).agg(F.count("*").alias("n")).collect()
    return _step_up(tally, "random", rate), _step_up(tally, "language", rate)


def _limit(limits: dict[str, float], name: Column) -> Column:
    if not limits:
        return F.lit(0.0)
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for pair in limits.items() for x in pair)), name), F.lit(0.0))


def _ranked(spans: Column, rank: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))


def find_secrets(docs: DataFrame, *, text: str = "text", rate: float = 0.01, out: str = "secrets") -> DataFrame:
    """Adds ``out``: an array of kind, start and end (exclusive, in code points), by
    start and then by kind as listed in ``KINDS``.

    The patterns' spans always stay. Other tokens count as ``random`` where the battery
    does not reject randomness and rejects written language, both at the false
    discovery rate within their class, and where no pattern's span overlaps them. Whole
    texts are read, nothing is shuffled but the histogram of p-values; a null or empty
    text has no spans, and rows keep their places in any case. A column named
    like ``out`` is replaced.
    """
    random_limit, text_limit = false_discovery_limits(docs, text, rate)
    whole = F.coalesce(F.col(text), F.lit(""))
    least = {"assign": lambda s: F.length(F.regexp_extract(s["match"], PATTERNS["assign"], 2)) >= 8, "access": lambda s: F.length(s["match"]) >= 16}
    made = docs
    for kind, pattern in PATTERNS.items():
        made = made.withColumn(f"__{kind}", located(whole, pattern))
    parts = []
    for i, kind in enumerate(PATTERNS):
        hits = F.filter(F.col(f"__{kind}"), least[kind]) if kind in least else F.col(f"__{kind}")
        parts.append(_ranked(hits, i))
    made = made.withColumns({"__base": F.concat(*parts), "__candidates": _candidates(whole)})
    passed = F.filter(F.col("__candidates"), lambda c: (c["random_p"] > _limit(random_limit, c["class"])) & (c["text_p"] <= _limit(text_limit, c["class"])) & ~F.exists(F.col("__base"), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    every = F.array_sort(F.concat(F.col("__base"), _ranked(passed, 3)))
    names = F.array(*(F.lit(k) for k in KINDS))
    spans = F.transform(every, lambda s: F.struct(F.get(names, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return made.withColumn(out, spans).drop("__assign", "__access", "__hex", "__base", "__candidates")


def redact(docs: DataFrame, *, text: str = "text", mark: str = "[SECRET]", rate: float = 0.01) -> DataFrame:
    """The documents with each secret's span (overlapping ones as one) replaced by ``mark``.

    Nulls stay null; all other columns stay as they are; rows are neither lost nor moved.
    """
    found = find_secrets(docs, text=text, rate=rate, out="__secrets")

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        between = F.when(fresh, F.concat(F.substring(F.col(text), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], between).alias("out"))

    tail = lambda acc: F.concat(acc["out"], F.substring(F.col(text), (acc["at"] + 1).cast("int"), F.length(text)))
    clean = F.aggregate("__secrets", F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), step, tail)
    return found.withColumn(text, F.when(F.size("__secrets") > 0, clean).otherwise(F.col(text))).drop("__secrets")


def shown(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
