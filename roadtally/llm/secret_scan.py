"""Secret scans: patterns, and a randomness test battery over other long tokens; DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadtally.llm.common import staged

#: The base patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_HEAD = r"""(?i)^(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN_LEAST = 6
ACCESS, ACCESS_LEAST = r"AKIA[A-Z0-9]+", 20
HEX, HEX_LEAST = r"[0-9a-f]{24,}", 24
#: What the battery looks at.
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "random")

#: Encodings by name, pattern that a token must match, alphabet in its order.
_UP, _LOW, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = (
    ("digits", r"^[0-9]+$", _DIGITS), ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef"), ("lower", r"^[a-z]+$", _LOW), ("upper", r"^[A-Z]+$", _UP),
    ("base32", r"^[A-Z2-7]+$", _UP + "234567"), ("base36", r"^(?:[0-9a-z]+|[0-9A-Z]+)$", _DIGITS + _LOW), ("letters", r"^[A-Za-z]+$", _UP + _LOW),
    ("base62", r"^[A-Za-z0-9]+$", _UP + _LOW + _DIGITS), ("base64", "", _UP + _LOW + _DIGITS + "+/_-"),
)
#: Encodings in which case does not count.
FOLDED = ("hex", "base36")
#: Shares of letters and digits within words and within numbers; other characters are alike.
USUAL = dict(zip(_LOW, (
    0.082, 0.015, 0.028, 0.043, 0.127, 0.022, 0.020, 0.061, 0.070, 0.0015, 0.0077, 0.040, 0.024, 0.067, 0.075, 0.019, 0.00095, 0.060, 0.063, 0.091,
    0.028, 0.0098, 0.024, 0.0015, 0.020, 0.00074))) | dict(zip(_DIGITS, (0.22, 0.17, 0.13, 0.1, 0.08, 0.07, 0.06, 0.06, 0.055, 0.055)))
#: How often a small letter, capital, digit or sign is followed by each of these in names, paths and words.
FOLLOWS = ((0.90, 0.04, 0.02, 0.04), (0.32, 0.60, 0.04, 0.04), (0.08, 0.07, 0.75, 0.10), (0.50, 0.20, 0.25, 0.05))
#: Share of random tokens that the battery rejects, rounded up: 0.3 to 0.8 % for all encodings and for 20 to 64 characters.
REJECTED = 0.01
LN10 = 2.302585092994046


@dataclass(frozen=True)
class Battery:
    """`reject`: chance under randomness below which a token is no secret. `discovery`: the false-discovery rate.

    `prior_pairs`: as how many pairs of neighbours the habits of ordinary text count before any is seen.
    """

    reject: float = 1e-3
    discovery: float = 0.01
    prior_pairs: float = 50_000.0
    bins: int = 400


def found(text: Column, pattern: str, least: int, guard: Column, inner: str = "") -> Column:
    """(start, end) in code points of a pattern's leftmost matches that do not overlap and whose value has `least` code points.

    The pieces between matches and the matches themselves are as long as the
    text, so their lengths give the places. `inner` is what stands before the
    value. Texts that fail `guard` are not searched.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    value = (lambda m: F.length(F.regexp_replace(m, inner, ""))) if inner else F.length
    steps = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: F.struct(
        F.length(p).alias("gap"), F.length(m).alias("size"), (value(m) >= least).alias("fine")))
    empty = F.array().cast("array<struct<start:int,end:int,fine:boolean>>")
    # the ends so far are carried along the matches
    walked = F.aggregate(steps, F.struct(F.lit(0).alias("at"), empty.alias("out")), lambda a, s: F.struct(
        (a["at"] + s["gap"] + s["size"]).alias("at"), F.concat(a["out"], F.array(F.struct(
            (a["at"] + s["gap"]).alias("start"), (a["at"] + s["gap"] + s["size"]).alias("end"), s["fine"].alias("fine")))).alias("out")))["out"]
    return F.when(guard, F.filter(walked, lambda m: m["fine"])).otherwise(empty)


def base_spans(text: Column) -> dict[str, Column]:
    """Array of (start, end, fine) of each base kind."""
    return {
        "assign": found(text, ASSIGN, ASSIGN_LEAST, text.rlike(r"(?i)(?:passw|secret|token|api_?key)"), ASSIGN_HEAD),
        "access": found(text, ACCESS, ACCESS_LEAST, text.contains("AKIA")),
        "hex": found(text, HEX, HEX_LEAST, text.rlike("[0-9a-f]{24}")),
    }


def _tail(z: Column) -> Column:
    """Chance of a standard normal value above z: a rational approximation, good to 1e-7."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, rx, start, end, token, encoding, k of each token that the battery tests, from columns doc_id, rx, text."""
    text = F.col("text")
    spans = found(text, TOKEN, 20, text.rlike(TOKEN))
    tokens = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.rtrim(text.substr(s["start"] + 1, s["end"] - s["start"]), F.lit("=")).alias("token")))
    # the outer form, as the plain one makes Spark search the text twice
    rows = docs.where(F.length("text") >= 20).select("doc_id", "rx", F.inline_outer(tokens)).where("start is not null")
    encoding, k, alphabet = F.lit(ENCODINGS[-1][0]), F.lit(len(ENCODINGS[-1][2])), F.lit(ENCODINGS[-1][2])
    for name, pattern, letters in reversed(ENCODINGS[:-1]):
        fits = F.col("token").rlike(pattern)
        encoding = F.when(fits, F.lit(name)).otherwise(encoding)
        k, alphabet = F.when(fits, F.lit(len(letters))).otherwise(k), F.when(fits, F.lit(letters)).otherwise(alphabet)
    rows = rows.withColumns({"encoding": encoding, "k": k, "alphabet": alphabet})
    # case does not count in hex and base 36; an underscore and a dash are the slash and the plus of the other base 64
    plain = F.when(F.col("encoding").isin(*FOLDED), F.lower("token")).otherwise(F.col("token"))
    return rows.withColumn("token", F.when(F.col("encoding") == "base64", F.translate(plain, "_-", "/+")).otherwise(plain))


def _sum(values: Column, of=lambda x: x) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + of(x))


def battery(tokens: DataFrame) -> DataFrame:
    """Adds n, codes (one-based places in the alphabet), p_random to tokens.

    Chi-squared tests whether the encoding's characters are equally frequent;
    runs counts the changes between the lower and the upper half of its
    alphabet, given how many characters lie in each; serial correlation
    compares neighbours. Each gives a value that is standard normal under
    randomness. p_random is three times the least of their chances, two-sided
    for runs and serial correlation.
    """
    letters = F.filter(F.split("token", ""), lambda c: c != "")
    rows = tokens.withColumn("n", F.length("token")).where("n > 2").withColumn(
        "codes", F.transform(letters, lambda c: F.instr(F.col("alphabet"), c).cast("double")))
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    codes = F.col("codes")
    squares = _sum(F.array_distinct(codes), lambda c: F.pow(F.size(F.filter(codes, lambda x: x == c)).cast("double"), F.lit(2)))
    mean = _sum(codes) / n
    high = F.transform(codes, lambda c: (c > k / 2).cast("double"))
    rows = rows.withColumns({"squares": squares, "mean": mean, "high": high}).withColumn("ones", _sum(F.col("high")))
    later, earlier = F.slice("high", F.lit(2), F.col("n") - 1), F.slice("high", F.lit(1), F.col("n") - 1)
    away = F.transform(codes, lambda c: c - F.col("mean"))
    rows = rows.withColumns({
        "chi2": k / n * F.col("squares") - n,
        "changes": _sum(F.zip_with(later, earlier, lambda a, b: F.abs(a - b))), "away": away,
    })
    spread = _sum(F.col("away"), lambda x: x * x)
    lagged = _sum(F.zip_with(F.slice("away", F.lit(2), F.col("n") - 1), F.slice("away", F.lit(1), F.col("n") - 1), lambda a, b: a * b))
    rows = rows.withColumns({"spread": spread, "lagged": lagged})
    both = 2 * F.col("ones") * (n - F.col("ones"))
    z_chi = (F.col("chi2") - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    z_runs = F.try_divide(F.col("changes") - both / n, F.sqrt(both * (both - n) / (n * n * (n - 1))))
    z_serial = (F.try_divide(F.col("lagged"), "spread") + 1 / n) * F.sqrt(n)
    far = F.lit(9.0)
    chance = F.least(tail(z_chi), 2 * tail(F.abs(F.coalesce(z_runs, far))), 2 * tail(F.abs(F.coalesce(z_serial, far))))
    return rows.withColumn("p_random", F.least(F.lit(1.0), 3 * chance)).select(
        *tokens.columns, "n", F.transform("codes", lambda c: c.cast("int")).alias("codes"), "p_random")


def tail(z: Column) -> Column:
    """Chance of a standard normal value above z (Abramowitz and Stegun 26.2.17, good to 1e-7)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _habits() -> Column:
    """Array of (e, m, kinds, usual, steps): each encoding's characters by kind, their usual shares, and which kind follows which.

    `m` is how many characters tokens of the encoding are made of; in base 64
    the underscore and the dash have become the slash and the plus.
    """
    out = []
    for name, _, letters in ENCODINGS:
        letters = letters[:64]
        kinds = [0 if c in _LOW else 1 if c in _UP else 2 if c in _DIGITS else 3 for c in letters]
        shares = [USUAL.get(c.lower(), 1.0) for c in letters]
        total = [sum(s for s, kind in zip(shares, kinds) if kind == of) for of in range(4)]
        present = [sum(step for step, t in zip(steps, total) if t) for steps in FOLLOWS]
        steps = [step / at if t else 0.0 for steps, at in zip(FOLLOWS, present) for step, t in zip(steps, total)]
        out.append(F.struct(
            F.lit(name).alias("e"), F.lit(len(letters)).alias("m"), F.array(*map(F.lit, kinds)).alias("kinds"),
            F.array(*(F.lit(s / total[kind]) for s, kind in zip(shares, kinds))).alias("usual"), F.array(*map(F.lit, steps)).alias("steps")))
    return F.array(*out)


def _pair(codes: Column, m: Column) -> Column:
    """Numbers of the pairs of neighbours of an array of one-based codes."""
    n = F.size(codes)
    return F.zip_with(F.slice(codes, F.lit(1), n - 1), F.slice(codes, F.lit(2), n - 1), lambda a, b: ((a - 1) * m + b - 1).cast("int"))


def likeness(tested: DataFrame, settings: Battery) -> DataFrame:
    """e, m, seen, usual: for each pair of neighbours of an encoding, the logarithm of how much likelier random tokens make its second character.

    `usual` compares with the fixed habits of words, `seen` with the pairs
    of the tokens that the battery rejects, to which the habits are added with
    the weight of `prior_pairs`. Random tokens that were rejected too are taken
    off first: the share REJECTED of what was left, alike from all pairs.
    """
    habits = tested.sparkSession.range(1).select(F.inline(_habits()))
    rejected = F.col("p_random") < settings.reject
    counts = tested.where(rejected).join(F.broadcast(habits.select("e", "m")), F.col("encoding") == F.col("e")).select(
        "encoding", F.explode(_pair(F.col("codes"), F.col("m"))).alias("own")).groupBy("encoding", "own").agg(F.count(F.lit(1)).alias("c"))
    left = tested.where(~rejected).groupBy(F.col("encoding").alias("l")).agg(F.sum(F.col("n") - 1).alias("pairs"))
    cells = habits.select("*", F.explode(F.sequence(F.lit(0), F.col("m") * F.col("m") - 1)).alias("pair"))
    first, second = F.floor(F.col("pair") / F.col("m")).cast("int"), F.col("pair") % F.col("m")
    habit = F.get("steps", F.get("kinds", first) * 4 + F.get("kinds", second)) * F.get("usual", second)
    # a few thousand cells of each encoding, whatever the input
    cells = cells.select("e", "m", "pair", first.alias("first"), habit.alias("habit")).join(
        counts, (F.col("e") == F.col("encoding")) & (F.col("pair") == F.col("own")), "left").join(F.broadcast(left), F.col("e") == F.col("l"), "left")
    random = REJECTED * F.coalesce("pairs", F.lit(0)) / (F.col("m") * F.col("m"))
    cells = cells.withColumn("c", F.greatest(F.coalesce("c", F.lit(0)) - random, F.lit(0.0)))
    weight = settings.prior_pairs / F.col("m")
    seen = (F.col("c") + weight * F.col("habit")) / (F.sum("c").over(Window.partitionBy("e", "first")) + weight)
    cells = cells.withColumn("seen", seen).groupBy("e", "m").agg(F.array_sort(F.collect_list(F.struct(
        "pair", (-F.log(F.col("seen") * F.col("m"))).alias("seen"), (-F.log(F.col("habit") * F.col("m"))).alias("usual")))).alias("cells"))
    return cells.select("e", "m", *(F.transform("cells", lambda c: c[name]).alias(name) for name in ("seen", "usual")))


def discoveries(tested: DataFrame, settings: Battery) -> DataFrame:
    """The tokens that the battery leaves random and that ordinary text is unlikely to make.

    A token is ranked by how much likelier its characters are at random than
    as ordinary text, where each depends on the one before (`likeness`). As a
    likelihood ratio is 1 in the mean over ordinary text, the chance of one of
    r or more is at most 1 / r; of the chances by habits and by what was seen the
    larger counts. These chances undergo Benjamini and Hochberg's control over
    the tokens that the battery leaves, apart for each encoding and each
    doubling of the length, so that many short words cannot drown few long
    keys. The ranks come from counts in bins of the chances' logarithm, a table
    of fixed size.
    """
    like = staged(tested.sparkSession, likeness(tested, settings), "likeness")
    rows = tested.where(F.col("p_random") >= settings.reject).join(F.broadcast(like), F.col("encoding") == F.col("e"))
    pairs = _pair(F.col("codes"), F.col("m"))
    ratio = F.least(_sum(pairs, lambda i: F.get("seen", i)), _sum(pairs, lambda i: F.get("usual", i)))
    rows = rows.select(*tested.columns, F.least(F.greatest(F.floor(10 / LN10 * ratio), F.lit(0)), F.lit(settings.bins - 1)).cast("int").alias("bin"))
    rows = rows.withColumn("lengths", F.floor(F.log2("n")).cast("int"))
    group = ["encoding", "lengths"]
    down = Window.partitionBy(*group).orderBy(F.desc("bin"))
    counts = rows.groupBy(*group, "bin").agg(F.count(F.lit(1)).alias("c"))
    counts = counts.withColumn("found", F.sum("c").over(down)).withColumn("of", F.sum("c").over(Window.partitionBy(*group)))
    limits = counts.where(F.pow(F.lit(10.0), -F.col("bin") / 10) <= settings.discovery * F.col("found") / F.col("of")).groupBy(
        F.col("encoding").alias("e"), F.col("lengths").alias("l")).agg(F.min("bin").alias("from"))
    # a row for each encoding and doubling of the length: a few hundred at most
    return rows.join(F.broadcast(limits), (F.col("encoding") == F.col("e")) & (F.col("lengths") == F.col("l"))).where(F.col("bin") >= F.col("from"))


def scan(docs: DataFrame, settings: Battery = Battery(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans: where secrets stand in each text.

    Base kinds are patterns (assignments to names of secrets, access keys, hex
    strings). The kind `random` adds tokens of 20 or more characters that
    overlap no base span, whose encoding is inferred from their characters and
    that pass the battery and the false-discovery control. `spans` lists
    kind:start:end in code points, end exclusive, by start, then by kind as
    listed in KINDS; base_sha256 is the digest of the same list without `random`.

    Null or empty text: no spans. Repeated rows come back repeated; rows of
    one doc_id are scanned apart. A null doc_id stays null. Empty table: no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("rx"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tested = staged(spark, battery(candidates(rows)), "tokens")
    extra = discoveries(tested, settings).groupBy(F.col("doc_id").alias("own_id"), F.col("rx").alias("own_rx")).agg(
        F.collect_set(F.struct("start", "end")).alias("random"))
    base = rows.select("doc_id", "rx", *(spans.alias(kind) for kind, spans in base_spans(F.col("text")).items()))
    joined = base.join(extra, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("rx") == F.col("own_rx")), "left")

    def placed(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))

    def listed(spans: Column) -> Column:
        names = F.array(*map(F.lit, KINDS))
        return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")

    joined = joined.withColumn("base", F.concat(*map(placed, KINDS[:3])))
    free = F.filter(F.coalesce("random", F.array().cast("array<struct<start:int,end:int>>")), lambda r: ~F.exists(
        "base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    joined = joined.withColumn("random", free)
    return joined.select(
        "doc_id", *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.concat("base", placed("random"))).alias("spans"))
