"""Secret scans over a trigram inverted index.

Every rule is a regular expression. Its Boolean trigram query is read off the
expression: an OR of ANDs of trigrams that any match must contain. The index
holds, for each trigram that some rule's query names, the texts that contain
it; the query's postings are intersected, and only texts that come out are
searched with the expression. A rule whose query is empty (some match needs no
certain trigram) searches every text. Trigrams are those of the lower-cased text,
so the candidates are a superset whatever the rule's case.

Texts are known by the md5 of their content: rows with equal or null keys stay
apart, and copies share their postings. Null texts count as empty and have no
spans. Rows, ties and other columns of the input are left alone, but
that the result's column replaces one of its name.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.spans import count_of, joined, matches


@dataclass(frozen=True)
class Rule:
    """``pattern`` as stated; ``search``: the same matches for Java's engine
    without backtracking over long runs; ``keep``: which matches count."""

    kind: str
    pattern: str
    search: str
    keep: Callable[[Column], Column] = lambda m: F.lit(True)


_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kinds, patterns and least lengths of the base rules.
BASE = (
    Rule("assign", "(?i:" + _ASSIGN + ")", r"(?i)" + _ASSIGN,
         lambda m: F.length(F.regexp_extract(m, r"(?i)" + _ASSIGN, 2)) >= 8),
    Rule("access", r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]++", lambda m: F.length(m) >= 16),
    Rule("hex", r"[0-9a-f]+", r"(?<![0-9a-f])[0-9a-f]{32,}+"),
)
#: What the method adds: forms that can hardly be anything but a credential.
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", r"xox[abprs]-[A-Za-z0-9-]{10,}+"),
)

_GAP = None
_MOST = 512


def _runs(nodes) -> list[tuple]:
    """The alternatives of a parsed expression: literals in a row, gaps between."""
    from re import _constants as c

    out = [()]
    for op, arg in nodes:
        if op is c.LITERAL:
            options = [(chr(arg).lower(),)]
        elif op is c.IN and all(k is c.LITERAL for k, _ in arg):
            options = [(x,) for x in sorted({chr(v).lower() for _, v in arg})]
        elif op is c.SUBPATTERN:
            options = _runs(arg[-1])
        elif op is c.BRANCH:
            options = [r for branch in arg[1] for r in _runs(branch)]
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT, c.POSSESSIVE_REPEAT):
            low, high, body = arg
            options = _runs(body) if high == 1 else [(*r, _GAP) for r in _runs(body)] if low else [(_GAP,)]
            options = options + [()] if low == 0 and high == 1 else options
        elif op in (c.AT, c.ASSERT, c.ASSERT_NOT):
            options = [()]
        else:
            options = [(_GAP,)]
        if len(out) * len(options) > _MOST:  # a weaker query, but a true one
            options = [(_GAP,)]
        out = [a + b for a, b in itertools.product(out, options)]
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """An OR of sets of trigrams, one of which any match holds whole; None where
    no trigram is certain."""
    from re import _parser

    wanted = set()
    for run in _runs(_parser.parse(pattern)):
        words = "".join("\0" if x is _GAP else x for x in run).split("\0")
        wanted.add(frozenset(w[i:i + 3] for w in words for i in range(len(w) - 2)))
    if frozenset() in wanted:
        return None
    return sorted((w for w in wanted if not any(v < w for v in wanted)), key=sorted)


def index(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings: ``trigram``, ``key``. ``texts`` has ``key`` and ``text``."""
    low = texts.select("key", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select(F.explode(held).alias("trigram"), "key").distinct()


def candidates(postings: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``key`` and the ``kinds`` of the rules whose query its postings satisfy."""
    spark = postings.sparkSession
    wanted = [(r.kind, i, t, len(ands)) for r in rules
              for i, ands in enumerate(trigram_query(r.pattern) or []) for t in sorted(ands)]
    # One row per trigram of a rule's query: as many as the rules spell out.
    terms = spark.createDataFrame(wanted, "kind string, clause int, trigram string, needed int")
    hits = postings.join(F.broadcast(terms), "trigram").groupBy("key", "kind", "clause").agg(
        F.count("*").alias("n"), F.first("needed").alias("needed"))
    return hits.filter("n = needed").groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED) -> DataFrame:
    """``docs`` plus ``found``: spans (``start``, ``end``, ``kind``, ``value``) by
    start, then by the rules' order."""
    docs = docs.drop("found", "_key", "_kinds")
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumn("_key", F.md5(text))
    full = [r for r in rules if trigram_query(r.pattern) is None]
    indexed = tuple(r for r in rules if r not in full)
    trigrams = sorted({t for r in indexed for ands in trigram_query(r.pattern) for t in ands})
    if indexed:
        postings = index(docs.select(F.md5(text).alias("key"), text.alias("text")), trigrams)
        chosen = candidates(postings, indexed).withColumnsRenamed({"key": "_key", "kinds": "_kinds"})
        keyed = keyed.join(chosen, "_key", "left")
    else:
        keyed = keyed.withColumn("_kinds", F.array().cast("array<string>"))

    def spans(i: int, r: Rule) -> Column:
        kept = F.filter(matches(text, r.search), lambda m: r.keep(m["value"]))
        tagged = F.transform(kept, lambda m: F.struct(
            m["start"].alias("start"), F.lit(i).alias("rule"), m["end"].alias("end"),
            F.lit(r.kind).alias("kind"), m["value"].alias("value")))
        if r in full:
            return tagged
        none = F.array().cast("array<struct<start:int,rule:int,end:int,kind:string,value:string>>")
        return F.when(F.array_contains("_kinds", r.kind), tagged).otherwise(none)

    found = F.array_sort(F.concat(*[spans(i, r) for i, r in enumerate(rules)]))
    return keyed.withColumn("found", found).drop("_key", "_kinds")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text of ``documents``."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("text")
    base = [r.kind for r in BASE]
    count = {f"n_{k}": count_of("found", k) for k in base}
    kept = F.filter("found", lambda s: s["kind"].isin(base))
    return found.select("doc_id", *[c.alias(k) for k, c in count.items()],
                        F.sha2(joined(kept), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))
