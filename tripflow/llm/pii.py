"""Personal data: patterns, and the terms that give it away.

Base spans (email, ip, card, phone) are found by pattern. What they hold are
the protected entities. A term discloses an entity as far as the corpus ties them
together: with probabilities from counts over all documents,

    PMI(c; t) = log p(c, t) / (p(c) p(t)),    IC(c) = -log p(c),

a term whose PMI reaches ``alpha`` times the entity's information content is a
span of kind ``term`` in every document that holds the entity: once the entity is
blanked, the term would still give it away. PMI equals IC where the term occurs
only beside the entity: such terms are removed, others above the threshold are
generalised to a placeholder. A pair must also be no chance: the first text that
holds it proves nothing, and the probability that the term stands in as many of the
entity's other different texts, if it knew nothing of the entity, must stay below
``risk`` for all the terms beside the entity together (Chernoff's bound of the binomial
tail, at ``p(t)``). So two texts can do for a rare term; one text, however often copied, never does.

All counts are sums over all documents, pre-aggregated per task. Only documents
with base spans are paired with terms. Texts are known by their md5: rows with
equal or null keys stay apart. Null texts count as empty and have no spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import staged
from tripflow.llm.spans import count_of, joined, masked, matches, replaced

ALPHA = 0.8
RISK = 0.05
REMOVE, GENERALISE = "remove", "generalise"

#: The kinds in their order.
KINDS = ("email", "ip", "card", "phone")
#: The stated patterns in forms that match the same spans but start only where a
#: run starts and give nothing back, so that long runs cost linear time. A card's
#: run of 13 to 19 digits is matched whole or not at all.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"\p{L}{3,}+"
_BYTE = "0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
SPAN = "struct<rule:int,start:int,end:int,kind:string,value:string>"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        double = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when((n - i) % 2 == 1, double).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """All base spans by kind, then start."""
    def of(i: int, kind: str) -> Column:
        kept = F.filter(matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["value"]))
        return F.transform(kept, lambda m: F.struct(
            F.lit(i).alias("rule"), m["start"].alias("start"), m["end"].alias("end"),
            F.lit(kind).alias("kind"), m["value"].alias("value")))
    return F.concat(*[of(i, k) for i, k in enumerate(KINDS)]).cast(f"array<{SPAN}>")


def _entity(span: Column) -> Column:
    bare = F.regexp_replace(span["value"], F.when(span["kind"] == "ip", F.lit("[^0-9.]")).otherwise(F.lit("[^0-9]")), F.lit(""))
    plain = F.when(span["kind"] == "email", F.lower(span["value"])).otherwise(bare)
    return F.concat_ws(":", span["kind"], plain)


def disclosures(texts: DataFrame, entities: DataFrame, term_counts: DataFrame, documents: DataFrame,
                alpha: float, risk: float) -> DataFrame:
    """``entity``, ``term``, ``pmi``, ``ic``, ``action`` of all pairs above the threshold.

    ``texts``: key, terms; ``entities``: key, copies, entity, n_entity, n_held (different texts);
    ``term_counts``: term, n_term; ``documents``: one row, n."""
    pairs = entities.join(texts.select("key", "terms"), "key").select(
        "entity", "n_entity", "n_held", "copies", F.explode("terms").alias("term"))
    joint = (pairs.groupBy("entity", "term").agg(
        F.first("n_entity").alias("n_entity"), F.first("n_held").alias("n_held"), F.sum("copies").alias("n_pair"), F.count("*").alias("n_texts")))
    tests = joint.groupBy("entity").agg(F.count("*").alias("n_tests"))
    joint = joint.filter(F.col("n_texts") > 1).join(tests, "entity")
    n = F.col("n").cast("double")
    share, p = (F.col("n_texts") - 1) / (F.col("n_held") - 1), F.col("n_term") / n
    miss = F.when(share < 1, (1 - share) * (F.log(1 - share) - F.log(1 - p))).otherwise(0.0)
    chance = F.when(share > p, -(F.col("n_held") - 1) * (share * F.log(share / p) + miss)).otherwise(0.0)
    return (joint.join(term_counts, "term").join(F.broadcast(documents))  # one row: the number of documents
            .withColumn("pmi", F.log(F.col("n_pair") * n / (F.col("n_entity") * F.col("n_term"))))
            .withColumn("ic", F.log(n / F.col("n_entity")))
            .filter((F.col("pmi") >= alpha * F.col("ic")) & (F.col("ic") > 0))
            .filter(chance + F.log(F.col("n_tests").cast("double")) <= F.log(F.lit(risk)))
            .withColumn("action", F.when(F.col("n_pair") >= F.col("n_term"), REMOVE).otherwise(GENERALISE))
            .select("entity", "term", "pmi", "ic", "action"))


def detect(docs: DataFrame, alpha: float = ALPHA, risk: float = RISK) -> DataFrame:
    """One row per text with spans: ``key`` (md5 of the text) and ``found``, its
    spans by kind, then start; a span of kind ``term`` has its action as value."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hinted = F.greatest(*[text.rlike(p) for p in PATTERNS.values()])
    spans = docs.filter(hinted).select(F.md5(text).alias("key"), text.alias("text"))
    tokens = F.transform(matches(masked(F.col("text"), PATTERNS["email"]), TERM), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), F.lower(m["value"]).alias("term")))
    held = staged(spans.select("key", base_spans(F.col("text")).alias("spans"), tokens.alias("tokens"))
                  .groupBy("key").agg(F.first("spans").alias("spans"), F.first("tokens").alias("tokens"),
                                      F.count("*").alias("copies")).filter(F.size("spans") > 0), "pii")

    known = held.select("key", "copies", F.explode(F.array_distinct(F.transform("spans", _entity))).alias("entity"))
    support = known.groupBy("entity").agg(F.count("*").alias("n_texts"), F.sum("copies").alias("n_entity"))
    entities = known.join(support.filter("n_texts > 1"), "entity").select(  # one text has no other to tell by
        "key", "copies", "entity", "n_entity", F.col("n_texts").alias("n_held"))
    texts = held.select("key", F.array_distinct(F.transform("tokens", lambda t: t["term"])).alias("terms"))
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))
    term_counts = docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    told = staged(disclosures(texts, entities, term_counts, docs.agg(F.count("*").alias("n")), alpha, risk), "disclosures")

    flagged = (entities.join(texts, "key").select("key", "entity", F.explode("terms").alias("term"))
               .join(told.select("entity", "term", "action"), ["entity", "term"])
               .groupBy("key", "term").agg(F.max("action").alias("action"))  # remove goes before generalise
               .groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("terms")))
    term = F.transform(F.filter("tokens", lambda t: F.map_contains_key("terms", t["term"])), lambda t: F.struct(
        F.lit(len(KINDS)).alias("rule"), t["start"].alias("start"), t["end"].alias("end"), F.lit("term").alias("kind"),
        F.element_at("terms", t["term"]).alias("value"))).cast(f"array<{SPAN}>")
    return held.join(flagged, "key", "left").select(
        "key", F.concat("spans", F.coalesce(term, F.array().cast(f"array<{SPAN}>"))).alias("found"))


def find(docs: DataFrame, alpha: float = ALPHA, risk: float = RISK) -> DataFrame:
    """``docs`` plus ``found``, the spans of its text (none: an empty array)."""
    docs = docs.drop("found", "_key", "_found")
    found = detect(docs, alpha, risk).withColumnsRenamed({"key": "_key", "found": "_found"})
    keyed = docs.withColumn("_key", F.md5(F.coalesce(F.col("text"), F.lit(""))))
    return (keyed.join(found, "_key", "left")
            .withColumn("found", F.coalesce("_found", F.array().cast(f"array<{SPAN}>"))).drop("_key", "_found"))


def sanitise(docs: DataFrame, alpha: float = ALPHA, risk: float = RISK) -> DataFrame:
    """``docs`` with entities generalised to their kind and disclosing terms
    generalised or removed. A text without spans, null too, stays as it is."""
    found = find(docs.select(F.struct("*").alias("_docs"), "text"), alpha, risk)
    label = lambda s: F.when(s["kind"] != "term", F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).when(
        s["value"] == GENERALISE, F.lit("[TERM]")).otherwise(F.lit(""))
    labelled = F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), label(s).alias("label")))
    clean = F.col("_docs").withField("text", replaced(F.col("text"), labelled))
    return found.select(clean.alias("_docs")).select("_docs.*")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text of ``documents``."""
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("text")
    count = {f"n_{k}": count_of("found", k) for k in KINDS}
    base = F.filter("found", lambda s: s["kind"] != "term")
    return found.select("doc_id", *[c.alias(k) for k, c in count.items()],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))
