"""Secrets by patterns and by character Markov models.

Two first-order Markov models of characters, one of random strings and one of ordinary
identifiers, are trained from labelled samples. A run of key characters, or what a pattern
leaves of it, is a secret if the log-likelihood ratio of the two models exceeds a threshold
for its length: as high as most random samples of that length reach, and above ordinary ones.

Base patterns report their matches whatever the models say. All of it is built-in columns:
training counts character pairs in a grouped aggregation, and only that table, bounded by
the square of the alphabet, becomes a constant of the scoring expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tenorline.llm.shared import written
from tenorline.llm.spans import by_start, count_of, matches, replaced, told

KINDS = ("assign", "access", "hex")
LEARNED = "random"
# The base patterns (inner repetitions possessive, which matches the same).
ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?[A-Za-z0-9+/_.=-]++")
ASSIGNED = r"^(?i:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)$"
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"[0-9a-f]{24,}+"
#: A run for the models: at least so many characters of keys.
LEAST_LENGTH = 12
RUN = r"[A-Za-z0-9+/_=-]{12,}+"
#: Ordinary identifiers and words, the other class of the training sample.
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z_][A-Za-z0-9_-]{3,}+(?![A-Za-z0-9+/_=-])"
#: Characters from "+" to "z" are known by their place among these; 0 is the start and what comes before "+", the last what follows "z".
BEFORE_FIRST, CODES = 42, 82
THRESHOLD, SMOOTHING = 12.0, 10.0
#: Lengths from which a threshold holds, and the shares of random and of ordinary strings below it.
LENGTHS, MISSED, BELOW, RAISED = (12, 16, 20, 26, 34), 0.01, 0.999, 1.25
#: Documents that the labelled sample is drawn from, about.
SAMPLE = 20_000


def base_spans(text: Column) -> Column:
    """Spans of the three base kinds by start, then kind; null text has none."""
    given = F.coalesce(text, F.lit(""))
    found = F.concat(
        matches(given, ASSIGN, "assign", given.rlike("(?i)passw|secret|token|api_?key"),
                lambda m: F.length(F.regexp_extract(m, ASSIGNED, 1)) >= 6),
        matches(given, ACCESS, "access", F.contains(given, F.lit("AKIA")), lambda m: F.length(m) >= 20),
        matches(given, HEX, "hex", given.rlike("[0-9a-f]{24}"), lambda m: F.lit(True)))
    return by_start(found, KINDS)


def _identifiers(words: Column, number: Column) -> list[Column]:
    """Names, paths and numbers as code and logs have them, from four words and a number."""
    w = [F.get(words, F.lit(k)) for k in range(4)]
    small, year = F.pmod(number, F.lit(100)).cast("string"), (F.pmod(number, F.lit(60)) + 1970).cast("string")
    digits = F.abs(number).cast("string")
    return [
        F.lower(F.concat_ws("_", *w[:3])), F.lower(F.concat_ws("_", w[0], w[1], F.lit("for"), w[2], small, F.lit("of"), year)),
        F.concat(F.lower(w[0]), F.initcap(w[1]), F.initcap(w[2])), F.concat(F.initcap(w[0]), F.initcap(w[1]), small),
        F.lower(F.concat(F.lit("/"), F.concat_ws("/", w[0], w[1], F.concat(w[2], small, F.lit("-"), F.substring(digits, 1, 1)), w[3]))),
        F.lower(F.concat_ws("-", w[0], w[1], year, small)), F.upper(F.concat_ws("_", w[0], w[1], small)),
        F.substring(digits, 1, 16), F.concat_ws("-", year, F.substring(digits, 1, 2), F.substring(digits, 3, 2)), digits]


def _random(seed: Column) -> list[Column]:
    """Random strings over the alphabets of keys, from hashes."""
    many = F.base64(F.unhex(F.concat(F.sha2(seed, 512), F.md5(seed))))
    return [F.translate(many, "=", ""), F.translate(many, "+/=", "Zq"), F.md5(seed),
            F.regexp_replace(many, "[^A-Za-z]", ""), F.regexp_replace(many, "[^A-Z2-7]", "")]


def labelled_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE) -> DataFrame:
    """(value, is_random, n), written: random strings against ordinary ones and how often each occurs,
    from a sample of about ``most`` documents that a hash of the id draws (all where there are fewer).

    Random are the values of base matches, and hashes of the texts over the alphabets of keys;
    ordinary are the words beside base matches, and names, paths and numbers made of them.
    """
    text = F.col(f"`{text_col}`").cast("string")
    total = docs.count()
    drawn = docs.filter(F.pmod(F.xxhash64(F.lit("sample"), F.col(f"`{id_col}`")), F.lit(1 << 20))
                        < int((1 << 20) * min(1.0, most / max(total, 1)))).select(text.alias("text")).filter("text is not null")
    drawn = drawn.withColumn("spans", base_spans(F.col("text")))
    drawn = drawn.withColumn("words", F.regexp_extract_all(_blanked(F.col("text"), F.col("spans")), F.lit(WORD), F.lit(0)))

    def of_class(values: Column, is_random: bool) -> Column:
        return F.transform(values, lambda v: F.struct(v.alias("value"), F.lit(is_random).alias("is_random")))

    found = F.transform("spans", lambda s: F.when(
        s["kind"] == "assign", F.regexp_extract(s["value"], ASSIGNED, 1)).otherwise(s["value"]))
    last_words = F.slice("words", F.size("words") - 3, 4)
    made = F.when(F.size("words") >= 4, F.concat(
        of_class(F.array(*_identifiers(last_words, F.xxhash64("text"))), False),
        of_class(F.array(*_random(F.col("text"))), True))).otherwise(F.array())
    # All samples of a text in one array, so that each text is searched once.
    together = drawn.select(F.explode(F.concat(of_class(found, True), of_class(F.col("words"), False), made)).alias("s")).select("s.*")
    return written(together.groupBy("value", "is_random").agg(F.count(F.lit(1)).alias("n")), "labelled")


def _blanked(text: Column, spans: Column) -> Column:
    """``text`` with blanks in place of its ``spans``, every other character where it was."""
    marked = F.transform(spans, lambda s: F.struct(
        F.repeat(F.lit(" "), (s["end"] - s["start"]).cast("int")).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return replaced(text, marked, lambda blanks: blanks)


def _code(char: Column) -> Column:
    return F.least(F.greatest(F.ascii(char) - BEFORE_FIRST, F.lit(0)), F.lit(CODES - 1))


def train(labelled: DataFrame, smoothing: float = SMOOTHING) -> list[float]:
    """Log-likelihood ratios, random over ordinary, at place before * CODES + code.

    Transitions are smoothed with ``smoothing`` pseudo-counts of each class's single
    characters, and those with half a count each; a class without samples is uniform. A column
    ``n`` of ``labelled`` tells how often a string occurs, once by default.
    """
    often = F.col("n") if "n" in labelled.columns else F.lit(1)
    codes = F.transform(F.split("value", ""), _code)
    pairs = (labelled.filter("value <> ''").select("is_random", codes.alias("codes"), often.alias("often"))
             .select("is_random", "often", F.explode(F.arrays_zip(
                 F.concat(F.array(F.lit(0)), F.slice("codes", F.lit(1), F.size("codes") - 1)).alias("before"),
                 F.col("codes").alias("code"))).alias("p"))
             .groupBy("is_random", "p.before", "p.code").agg(F.sum("often").alias("count")).collect())
    ratio = [0.0] * (CODES * CODES)
    for is_random, sign in ((True, 1), (False, -1)):
        seen = {(r["before"], r["code"]): r["count"] for r in pairs if r["is_random"] is is_random}
        after, alone = [0] * CODES, [0.5] * CODES
        for (a, b), n in seen.items():
            after[a] += n
            alone[b] += n
        whole = sum(alone)
        for a in range(CODES):
            for b in range(CODES):
                p = (seen.get((a, b), 0) + smoothing * alone[b] / whole) / (after[a] + smoothing)
                ratio[a * CODES + b] += sign * math.log(p)
    return ratio


def log_ratio(value: Column, model: list[float]) -> Column:
    """The log-likelihood ratio of ``value``: positive if it looks random."""
    table = F.split(F.lit(",".join(f"{x:.4f}" for x in model)), ",").cast("array<double>")
    start = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum"))

    def step(s: Column, c: Column) -> Column:
        code = _code(c)
        return F.struct(code.alias("before"), (s["sum"] + F.get(table, s["before"] * CODES + code)).alias("sum"))

    return F.aggregate(F.split(value, ""), start, step, lambda s: s["sum"])


def thresholds(labelled: DataFrame, model: list[float]) -> list[float]:
    """For each of ``LENGTHS`` the log-likelihood ratio that all but ``MISSED`` of the random strings
    reach within that length, or if it is more, the one that ``BELOW`` of the ordinary strings of
    at least that length do not pass, but no more than ``RAISED`` times the former, as ordinary
    samples hold unknown secrets; ``THRESHOLD`` without samples."""
    reached = F.size(F.filter(F.lit(list(LENGTHS)), lambda x: x <= F.length("value")))
    classes = F.sequence(F.when(F.col("is_random"), F.lit(1)).otherwise(reached), reached)
    long = labelled.filter(F.length("value") >= LEAST_LENGTH).select("value", "is_random", F.explode(classes).alias("of"))
    begun = F.when(F.col("is_random"), F.expr(f"substring(value, 1, element_at(array({', '.join(map(str, LENGTHS))}), of))")
                   ).otherwise(F.col("value"))
    scored = long.select((F.col("of") - 1).alias("of"), "is_random", begun.alias("begun")).select(
        "of", "is_random", log_ratio(F.col("begun"), model).alias("ratio"))
    at = scored.groupBy("of").agg(
        F.percentile_approx(F.when(F.col("is_random"), F.col("ratio")), MISSED, 10_000).alias("random"),
        F.percentile_approx(F.when(~F.col("is_random"), F.col("ratio")), BELOW, 10_000).alias("ordinary")).collect()
    known = {r["of"]: r for r in at}

    def chosen(random: float | None, ordinary: float | None) -> float:
        if random is None or random <= 0:
            return THRESHOLD
        return max(random, min(ordinary or 0.0, RAISED * random))

    return [chosen(known[k]["random"], known[k]["ordinary"]) if k in known else THRESHOLD for k in range(len(LENGTHS))]


def scan(docs: DataFrame, model: list[float], text_col: str = "text", threshold: float | list[float] = THRESHOLD) -> DataFrame:
    """``docs`` plus ``base`` and ``spans``: arrays of (kind, start, end, value) by start.

    ``spans`` holds the base spans and, of kind "random", runs beside them whose log-likelihood
    ratio exceeds ``threshold``, one number or one for each of ``LENGTHS``. Null and empty texts
    have none, an empty table gives an empty result. Columns of ``docs`` named like the two new
    ones are replaced.
    """
    kept = [c for c in docs.columns if c not in ("base", "spans")]
    text = F.coalesce(F.col("_row")[text_col].cast("string"), F.lit(""))
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row")).withColumn("_base", base_spans(text))
    # What a base span leaves of a run is a run of its own.
    found = found.withColumn("_rest", _blanked(text, F.col("_base")))
    by_length = F.lit([float(t) for t in (threshold if isinstance(threshold, list) else [threshold] * len(LENGTHS))])

    def most(length: Column) -> Column:
        return F.element_at(by_length, F.size(F.filter(F.lit(list(LENGTHS)), lambda x: x <= length)))

    added = matches(F.col("_rest"), RUN, LEARNED, F.col("_rest").rlike("[A-Za-z0-9+/_=-]{12}"),
                    lambda m: log_ratio(m, model) > most(F.length(m)))
    found = found.withColumn("_added", added)
    spans = F.when(F.size("_added") > 0, by_start(F.concat("_base", "_added"), (*KINDS, LEARNED))).otherwise(F.col("_base"))
    return found.select("_row.*", F.col("_base").alias("base"), spans.alias("spans"))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row of ``scan``: counts of the base kinds, their hash, and all spans as text."""
    counts = [count_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS]
    return scanned.select(id_col, *counts, F.sha2(told(F.col("base")), 256).alias("base_sha256"),
                          told(F.col("spans")).alias("spans"))


def redact(scanned: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``text_col`` of ``scan``'s rows with every span exchanged for ``mark``, other columns as
    they are, ``base`` and ``spans`` gone. Texts without spans, null ones too, stay as they are."""
    text = F.col(f"`{text_col}`")
    new = F.when(F.size("spans") > 0, replaced(text, F.col("spans"), lambda kind: F.lit(mark))).otherwise(text)
    return scanned.withColumn(text_col, new).drop("base", "spans")
