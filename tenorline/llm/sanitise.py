"""Personal data, and the terms that would give it away.

Base patterns find protected entities (mail addresses, IP addresses, card and phone numbers).
Masking those is not enough where a term left beside them points to one entity alone. How
strongly a term t reveals an entity e is estimated from the corpus: the share

    disclosure(e, t) = PMI(e; t) / IC(e) = log(N df(e, t) / (df(e) df(t))) / log(N / df(e))

of the entity's information content that t gives away, over N distinct texts, where df(e, t)
counts whole texts that hold both, wherever in them. It is 1 if t occurs in no text without e,
and 0 if both are independent. In texts that hold e, terms whose disclosure reaches a threshold
are generalised to a placeholder, and those that reveal all but nothing else are removed.

Exact copies of a text count once, so copies do not pose as evidence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tenorline.llm.shared import broadcast_if_small, gathered, written
from tenorline.llm.spans import count_of, matches, no_spans, replaced, told

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# The base patterns. A start inside a run of the first class never matches where
# the run's start does not, so it is not tried; repetitions of groups are possessive.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_PARTS = r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)(?:\.|$)){4}$"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A term: a word of at least four letters.
WORD = r"(?<!\p{L})\p{L}{4,}+"
#: Least texts with entity and term together, disclosure that generalises, and that removes.
SUPPORT, GENERALISE, REMOVE = 3, 0.8, 0.95
#: Hashes of copied texts, terms, and documents with terms to treat, are broadcast up to this many.
MOST_BROADCAST = 1_000_000


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def base_spans(text: Column) -> Column:
    """Spans of the base kinds, by kind as listed, then start; null text has none."""
    given = F.coalesce(text, F.lit(""))

    def card(m: Column) -> Column:
        return F.length(_digits(m)).between(16, 19) & F.call_function("luhn_check", _digits(m))

    return F.concat(
        matches(given, EMAIL, "email", F.contains(given, F.lit("@")), lambda m: F.lit(True)),
        matches(given, IP, "ip", given.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), lambda m: m.rlike(IP_PARTS)),
        matches(given, CARD, "card", given.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), card),
        matches(given, PHONE, "phone", F.contains(given, F.lit("+")), lambda m: F.length(_digits(m)).between(8, 15)))


def _entity(span: Column) -> Column:
    value = F.when(span["kind"] == "email", F.lower(span["value"])).when(
        span["kind"] == "ip", span["value"]).otherwise(_digits(span["value"]))
    return F.concat_ws(":", span["kind"], value)


def _most(df_e: Column, n: float, threshold: float) -> Column:
    """The most texts a term may be in that reaches the threshold with an entity, rounding included."""
    return df_e * F.pow(n / df_e, F.lit(1.0 - threshold)) * (1 + 1e-9)


def disclosures(docs: DataFrame, text_col: str = "text", support: int = SUPPORT,
                threshold: float = GENERALISE) -> tuple[DataFrame, DataFrame]:
    """(entity, term, disclosure) for all pairs that reach ``threshold`` with at least
    ``support`` distinct texts, and (id, entities, terms) for every row that holds an entity.

    ``docs`` has an ``id`` column besides the text. As df(e, t) is at most df(e), a pair reaches
    the threshold only if df(t) is at most df(e) (N / df(e))^(1 - threshold). Terms beyond that for
    the most frequent entity never meet entities, nor do others those entities they are too frequent for.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    given = docs.select("id", text.alias("text"))
    words = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lower))
    holding = written(given.withColumn("spans", base_spans(F.col("text"))).filter(F.size("spans") > 0).select(
        "id", F.xxhash64("text").alias("copy"), F.array_distinct(F.transform("spans", _entity)).alias("entities"),
        words.alias("terms")), "holding")

    rows = given.count()
    copies = gathered(given.groupBy(F.xxhash64("text").alias("copy")).count(), "copies", rows)
    total = copies.count()
    n = float(max(total, 1))
    held = holding.select("copy", F.explode("entities").alias("entity")).distinct()
    df_e = gathered(held.groupBy("entity").agg(F.count(F.lit(1)).alias("df_e"))
                    .filter(F.col("df_e").between(support, total - 1)), "df_e", rows)
    most = df_e.agg(F.max(_most(F.col("df_e"), n, threshold))).first()[0] or 0.0
    # Every distinct text once: those without copies as they are, of the others one each.
    copied = broadcast_if_small(gathered(copies.filter("count > 1").select("copy"), "copied", rows), MOST_BROADCAST)
    hashed = given.select(F.xxhash64("text").alias("copy"), "text")
    once = (hashed.join(copied, "copy", "left_anti").select("text").unionByName(
        hashed.join(copied, "copy", "left_semi").groupBy("copy").agg(F.first("text").alias("text")).select("text")))
    df_t = gathered(once.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df_t"))
                    .filter(F.col("df_t") >= support), "df_t", rows)

    frequent = broadcast_if_small(gathered(df_t.filter(F.col("df_t") > most).select("term"), "frequent", rows), MOST_BROADCAST)
    supported = gathered(held.join(df_e, "entity"), "supported", rows)
    bearing = holding.join(supported.select("copy").distinct(), "copy", "left_semi")
    beside = (bearing.select("copy", F.explode("terms").alias("term")).join(frequent, "term", "left_anti").distinct()
              .join(df_t.filter(F.col("df_t") <= most), "term"))
    pairs = (supported.join(beside, "copy").filter(F.col("df_t") <= _most(F.col("df_e"), n, threshold))
             .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("df_et"), F.first("df_e").alias("df_e"),
                                            F.first("df_t").alias("df_t"))
             .filter(F.col("df_et") >= support))
    share = F.ln(n * F.col("df_et") / (F.col("df_e") * F.col("df_t"))) / F.ln(n / F.col("df_e"))
    strong = (pairs.withColumn("disclosure", share)
              .filter(F.col("disclosure") >= threshold).select("entity", "term", "disclosure"))
    return strong, holding.select("id", "entities", "terms")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       support: int = SUPPORT, threshold: float = GENERALISE) -> DataFrame:
    """``docs`` plus ``base``, ``spans``, both arrays of (kind, start, end, value), and ``disclosing``.

    ``spans`` holds the base spans and then, of kind "term", the words that disclose an entity
    of the same document; a disclosing word inside a base span is covered already. A document
    without entities has no spans at all. Null and empty texts have none. Rows that repeat a
    doc_id share the terms of all its texts; rows without one get base spans only. ``disclosing``
    maps those terms to their disclosure. Columns of ``docs`` named like the three new ones are
    replaced. An empty table gives an empty result.
    """
    strong, holding = disclosures(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`")), text_col,
                                  support, threshold)
    rows = docs.count()
    strong = gathered(strong, "strong", rows)
    # Only what a document holds itself meets its entities, so a frequent entity's terms are not multiplied by its texts.
    some = broadcast_if_small(gathered(strong.select("term").distinct(), "strong-terms", rows), MOST_BROADCAST)
    owned = holding.filter("id is not null")
    present = owned.select("id", F.explode("terms").alias("term")).join(some, "term", "left_semi").distinct()
    per_doc = broadcast_if_small(gathered(
        owned.select("id", F.explode("entities").alias("entity")).distinct().join(present, "id")
        .join(strong, ["entity", "term"]).groupBy("id", "term").agg(F.max("disclosure").alias("disclosure"))
        .groupBy(F.col("id").alias("_id")).agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("_terms")),
        "disclosed", rows), MOST_BROADCAST)
    kept = [c for c in docs.columns if c not in ("base", "spans", "disclosing")]
    rows = (docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"))
            .join(per_doc, F.col("_row")[id_col] == F.col("_id"), "left"))
    text = F.coalesce(F.col("_row")[text_col].cast("string"), F.lit(""))
    rows = rows.withColumn("_base", base_spans(text))
    words = matches(text, WORD, TERM, F.col("_terms").isNotNull(),
                    lambda m: F.map_contains_key(F.col("_terms"), F.lower(m)))
    free = F.filter(words, lambda w: ~F.exists(
        F.col("_base"), lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    added = F.when(F.col("_terms").isNotNull() & (F.size("_base") > 0), free).otherwise(no_spans())
    return rows.select("_row.*", F.col("_base").alias("base"), F.concat("_base", added).alias("spans"),
                       F.col("_terms").alias("disclosing"))


def sanitise(found: DataFrame, text_col: str = "text", remove: float = REMOVE) -> DataFrame:
    """The rows of ``find_personal_data`` with a safe text: entities become their kind in
    brackets, disclosing terms "[TERM]", and terms of at least ``remove`` nothing."""
    marked = F.transform("spans", lambda s: F.struct(
        F.when(s["kind"] != TERM, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        .when(F.element_at("disclosing", F.lower(s["value"])) >= remove, "").otherwise("[TERM]").alias("kind"),
        s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    text = F.col(f"`{text_col}`")
    return (found.withColumn("_marked", marked)
            .withColumn(text_col, F.when(F.size("_marked") > 0, replaced(text, F.col("_marked"), lambda mark: mark)).otherwise(text))
            .drop("base", "spans", "disclosing", "_marked"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row of ``find_personal_data``: counts of the base kinds, their hash, all spans as text."""
    counts = [count_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS]
    return found.select(id_col, *counts, F.sha2(told(F.col("base")), 256).alias("base_sha256"),
                        told(F.col("spans")).alias("spans"))
