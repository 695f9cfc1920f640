"""Phrase collocations by best-first branch and bound.

A phrase's score is the least over its cuts of ``1000*a*n / (l*r)`` (rounded down), with
``a`` the count of the phrase, ``l`` and ``r`` those of its two parts and ``n`` all words of
its language. As ``r >= a``, no phrase that begins with word ``w`` scores more than
``1000*n / f(w)``: an admissible bound known from the count of a prefix. The frontier
holds the first words of all phrases; the rarest, whose bounds are highest, are grown first,
a share of the corpus at a time, through pairs (their exact last cut bounds them
again) to longer phrases. A language is settled when its 2000th surviving score is above
the bound of all first words left, so that no tie is missing.

How it runs: texts become blocks of some hundred thousand words of one language, each
with its own dictionary (``blocks``). Word counts are summed from the dictionaries; words
counted at least ``least`` times get ids and are sent back to the blocks that have them
(``encoded``). Phrases are counted per block before any shuffle. Phrases to look for are sent
to the blocks that have their rarest word (``_sent``). A phrase whose occurrences all have one
same frequent word before or after them lies in a longer phrase of equal count: as counts
only fall while phrases grow, one word more is all that need be looked at.

Arithmetic is exact (decimals of 38 digits). Null and empty texts have no words, null
languages are ``und``; repeated rows count again; ties are settled by count and phrase
(bytes); a very long text is cut into blocks that overlap by the longest phrase, each place
counted once; an empty table gives no rows. Only text and language are read, so other columns
may have any name.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.llm.common import staged
from tripflow.llm.mixing import ranked

LEAST = 100
LONGEST = 5
MOST = 2000
UNKNOWN = "und"
BLOCK = 1 << 18  # words
#: Parts of a language's words whose first words are grown in a round, as long as its
#: 2000th score isn't known; then that score alone says how far to go.
SHARES = (1 / 8, 1.0)
#: Codes in blocks: the end of a piece, and a word that is too rare for any phrase.
END, RARE = 0, 1

_BREAK = b"\xff"  # no byte of UTF-8
_FOLDED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + _BREAK * 10)
_FOUND = "p array<bigint>, c bigint, before_min bigint, before_max bigint"


def pieces(text: str | None) -> list[bytes]:
    """The folded words of a text, with a break at the end of every piece."""
    return ((text or "").encode().translate(_FOLDED) + _BREAK).replace(_BREAK, b" " + _BREAK + b" ").split()


class _Block:
    """Words of one language, as numbers of a dictionary of its own (0: a break)."""

    def __init__(self):
        self.number = defaultdict(count(1).__next__, {_BREAK: 0})
        self.parts, self.size = [], 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def row(self, lang: str, first: int, own: int | None = None) -> dict:
        """``first``: where the places that this block counts begin; the rest is context."""
        tokens = np.concatenate(self.parts)
        own = len(tokens) if own is None else own
        counts = np.bincount(tokens[first:first + own], minlength=len(self.number))[1:]
        words = [w.decode() for w in self.number if w != _BREAK]
        return {"lang": lang, "words": words, "counts": counts, "tokens": tokens, "first": first, "own": own}


def _rows(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"lang": pa.string(), "words": pa.list_(pa.string()), "counts": pa.list_(pa.int64()),
             "tokens": pa.list_(pa.int32()), "first": pa.int32(), "own": pa.int32()}
    return pa.RecordBatch.from_pydict({k: pa.array([r[k] for r in rows], t) for k, t in kinds.items()})


def blocks(docs: DataFrame, text: str, lang: str, size: int = BLOCK, longest: int = LONGEST) -> DataFrame:
    """The folded words of all texts in blocks of one language."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, _Block] = defaultdict(_Block)
        held = 0
        for batch in batches:
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = pieces(t)
                if len(words) > size:  # blocks of its own
                    for at in range(0, len(words), size):
                        b, before = _Block(), min(at, 1)
                        b.add(words[at - before:at + size + longest - 1])
                        yield _rows([b.row(name, before, len(words[at:at + size]))])
                    continue
                open_[name].add(words)
                held += len(words)
                if open_[name].size >= size:
                    b = open_.pop(name)
                    held -= b.size
                    yield _rows([b.row(name, 0)])
                if held > 4 * size:  # many languages at once
                    yield _rows([b.row(k, 0) for k, b in open_.items()])
                    open_.clear()
                    held = 0
        if open_:
            yield _rows([b.row(k, 0) for k, b in open_.items()])

    found = docs.select(F.coalesce(lang, F.lit(UNKNOWN)), text).mapInArrow(
        cut, "lang string, words array<string>, counts array<bigint>, tokens array<int>, first int, own int")
    return found.withColumn("block", F.monotonically_increasing_id())


def encoded(raw: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of ``blocks``: them with ids and counts of their frequent words, those words, and
    the languages with their number of words. Smaller ids are rarer words."""
    each = raw.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w"))
    each = each.select("block", "lang", "at", F.col("w.words").alias("word"), F.col("w.counts").alias("c"))
    counts = staged(each.groupBy("lang", "word").agg(F.sum("c").alias("f")), "words")
    langs = staged(counts.groupBy("lang").agg(F.sum("f").alias("n")), "langs")
    order = F.struct("f", "lang", "word")
    words = staged(ranked(counts.filter(F.col("f") >= least), order, "at").select(
        (F.col("at") + RARE + 1).alias("id"), "lang", "word", "f"), "frequent")
    ids = (each.drop("c").join(words, ["lang", "word"]).groupBy("block")
           .agg(F.collect_list(F.struct("at", "id", "f")).alias("known")))
    known = F.col("known")
    held = raw.drop("words", "counts").join(ids, "block").select(
        "block", "lang", "tokens", "first", "own", *[known[x].alias(x) for x in ("at", "id", "f")])
    return staged(held, "blocks"), words, langs


def _read(row: dict, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's ids, with ends around it, and their counts."""
    tokens = row["tokens"]
    ids = np.full(int(tokens.max(initial=0)) + 1, RARE, np.int64)
    f = np.zeros(len(ids), np.int64)
    ids[0] = END
    at = row["at"] + 1
    seen = at < len(ids)
    ids[at[seen]], f[at[seen]] = row["id"][seen], row["f"][seen]
    ends = (1, longest)
    return np.pad(ids[tokens], ends), np.pad(f[tokens], ends)


def _ranks(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For rows given by columns: the first row like it, and its class, by pairs of columns at a time."""
    first, klass = np.unique(columns[0], return_index=True, return_inverse=True)[1:]
    for column in columns[1:]:
        values, code = np.unique(column, return_inverse=True)
        first, klass = np.unique(klass * len(values) + code, return_index=True, return_inverse=True)[1:]
    return first, klass


def _counted(t: np.ndarray, at: np.ndarray, width: int, shortest: int) -> pa.RecordBatch:
    """The different phrases of up to ``width`` words at places ``at``, if they have ``shortest``,
    with their count and the least and greatest word before them."""
    phrases = np.stack([t[at + i] for i in range(width)])
    phrases *= np.logical_and.accumulate(phrases > RARE, axis=0)
    long = phrases[shortest - 1] > 0
    phrases, at = phrases[:, long], at[long]
    first, klass = _ranks(list(phrases))
    before = t[at - 1]
    least = np.full(len(first), np.iinfo(np.int64).max)
    most = np.zeros(len(first), np.int64)
    np.minimum.at(least, klass, before)
    np.maximum.at(most, klass, before)
    kept = phrases[:, first].T
    ends = np.concatenate([[0], np.cumsum((kept > 0).sum(1))]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(pa.array(ends), pa.array(kept[kept > 0])),
         pa.array(np.bincount(klass, minlength=len(first)).astype(np.int64)), pa.array(least), pa.array(most)],
        names=["p", "c", "before_min", "before_max"])


def _places(t: np.ndarray, at: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Those of ``at`` where one of the rows of ``targets`` begins."""
    words, codes = np.unique(t, return_inverse=True)
    spot = np.searchsorted(words, targets)
    spot[spot == len(words)] = 0
    spot = spot[(words[spot] == targets).all(1)]
    if not len(spot):
        return at[:0]
    node, here = np.zeros(len(spot), np.int64), np.zeros(len(at), np.int64)
    for i in range(targets.shape[1]):  # a trie, a level at a time
        level, node = np.unique(node * len(words) + spot[:, i], return_inverse=True)
        wanted = here * len(words) + codes[at + i]
        here = np.searchsorted(level, wanted)
        here[here == len(level)] = 0
        hit = level[here] == wanted
        at, here = at[hit], here[hit]
    return at


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(j)[i] for j, n in enumerate(batch.schema.names)}
            yield {n: x.values.to_numpy(zero_copy_only=False) if n in ("tokens", "at", "id", "f") else x for n, x in row.items()}


def _own(row: dict) -> np.ndarray:
    first = row["first"].as_py()
    return np.arange(first, first + row["own"].as_py()) + 1


def _pairs(held: DataFrame, frontier: DataFrame, longest: int) -> DataFrame:
    """Pairs whose first word's count is above ``low`` and at most ``high``, counted per block."""
    def count_pairs(batches):
        for row in _blocks_of(batches):
            t, f = _read(row, longest)
            at = _own(row)
            at = at[(f[at] > row["low"].as_py()) & (f[at] <= row["high"].as_py())]
            if (found := _counted(t, at, 2, 2)).num_rows:
                yield found

    return held.join(frontier.select("lang", "low", "high"), "lang").drop("lang").mapInArrow(count_pairs, _FOUND)


def _sent(held: DataFrame, targets: DataFrame, longest: int, width: int | None) -> DataFrame:
    """Phrases ``p`` looked up in the blocks that have their rarest word. ``width``: they are
    counted with what follows, up to so many words and at least one; without: as they are."""
    spread = held.select("block", F.explode("id").alias("rarest"))
    lists = (targets.select("p", F.array_min("p").alias("rarest")).join(spread, "rarest")
             .groupBy("block").agg(F.collect_list("p").alias("wanted")))

    def look_up(batches):
        for row in _blocks_of(batches):
            t, _ = _read(row, longest)
            wanted, by = row["wanted"].values, defaultdict(list)
            lengths, values = np.diff(wanted.offsets.to_numpy()), wanted.flatten().to_numpy()
            starts = np.concatenate([[0], np.cumsum(lengths)])
            for n in np.unique(lengths).tolist():
                rows = starts[:-1][lengths == n]
                by[n] = values[rows[:, None] + np.arange(n)]
            for n, some in by.items():
                at = _places(t, _own(row), some)
                found = _counted(t, at, width or n, n + 1 if width else n)
                if found.num_rows:
                    yield found

    return held.join(lists, "block").drop("lang").mapInArrow(look_up, _FOUND)


def _summed(found: DataFrame, least: int) -> DataFrame:
    return found.groupBy("p").agg(F.sum("c").alias("f"), F.min("before_min").alias("before_min"),
                                  F.max("before_max").alias("before_max")).filter(F.col("f") >= least)


def _grown(held: DataFrame, frontier: DataFrame, least: int, longest: int) -> DataFrame:
    """All frequent phrases that begin with a word of the frontier's range."""
    pairs = staged(_summed(_pairs(held, frontier, longest), least), "pairs")
    if longest < 3:
        return pairs
    longer = _sent(held, pairs, longest, longest)
    prefix = F.explode(F.sequence(F.lit(3), F.size("p"))).alias("k")
    longer = longer.select("*", prefix).withColumn("p", F.slice("p", 1, F.col("k"))).drop("k")
    return staged(pairs.unionByName(_summed(longer, least)), "grown")


def _quotient(a: str, n: str, parts: str) -> F.Column:
    wide = "decimal(19,0)"
    return F.expr(f"(cast(1000 * {a} as {wide}) * cast({n} as {wide})) div ({parts})")


def _scored(phrases: DataFrame, known: DataFrame) -> DataFrame:
    """Each phrase's lowest-scoring cut, ties to the shortest first part. A cut whose parts
    ``known`` doesn't all have is passed over."""
    cuts = phrases.select("p", "f", "n", F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.slice("p", 1, F.col("k")), "right": F.slice("p", F.col("k") + 1, F.size("p") - F.col("k"))})
    for part, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select(F.col("p").alias(part), F.col("f").alias(name)), part)
    score = _quotient("f", "n", "cast(l as decimal(19,0)) * cast(r as decimal(19,0))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return cuts.groupBy("p").agg(best.alias("best"))


def _reach(words: DataFrame, frontier: DataFrame, share: float) -> DataFrame:
    """``frontier`` with the next ``high``: where the 2000th score is known, the count of the
    most frequent first word that can still reach it; else up to a share of all words."""
    octave = F.ceil(F.log2("f")).cast("int")
    sums = words.groupBy("lang", octave.alias("octave")).agg(F.sum("f").alias("sum"))  # at most 63 rows a language
    upto = Window.partitionBy("lang").orderBy("octave")
    ends = (sums.withColumn("upto", F.sum("sum").over(upto)).join(frontier.select("lang", "n"), "lang")
            .filter(F.col("upto") >= F.col("n") * share).groupBy("lang").agg(F.min("octave").alias("octave")))
    by_share = F.coalesce(F.expr("cast(shiftleft(1L, octave) as bigint)"), F.col("n")) if share < 1 else F.col("n")
    high = F.when(F.col("least_score") > 0, F.least(F.col("n"), F.expr("1000 * n div least_score"))).otherwise(by_share)
    return frontier.join(ends, "lang", "left").withColumn("low", F.col("high")).withColumn("high", F.greatest("high", high)).drop("octave")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
         most: int = MOST, block: int = BLOCK, shares: tuple[float, ...] = SHARES) -> DataFrame:
    """The ``most`` best-scoring phrases of two to ``longest`` words of each language."""
    held, words, langs = encoded(staged(blocks(docs, text, lang, block, longest), "raw_blocks"), least)
    singles = words.select(F.array("id").alias("p"), "f")
    frontier = langs.select("lang", "n", F.lit(0).cast("long").alias("high"), F.lit(None).cast("long").alias("least_score"))
    grown: DataFrame | None = None
    counted = scored = None
    for share in (*shares, 1.0):
        frontier = staged(_reach(words, frontier, share), "frontier")
        if grown is not None and frontier.filter("high > low").isEmpty():
            break
        new = _grown(held, frontier.filter("high > low"), least, longest)
        grown = new if grown is None else staged(grown.unionByName(new), "all_grown")
        of = words.select(F.col("id"), "lang").join(frontier.select("lang", "n", "least_score"), "lang")
        wanted = (new.withColumn("id", F.col("p")[0]).join(of, "id")
                  .join(singles.select(F.col("p")[0].alias("last"), F.col("f").alias("last_f")), F.element_at("p", -1) == F.col("last")))
        # The bound of the last cut, its first part being at least as frequent as the phrase.
        wanted = staged(wanted.filter(F.expr("1000 * n div last_f >= coalesce(least_score, 0)")).select("p", "f", "n", "lang", "before_min", "before_max"), "wanted")
        rests = wanted.select(F.explode(F.expr("transform(sequence(2, greatest(size(p) - 1, 2)), k -> slice(p, k, size(p)))")).alias("p"))
        rests = rests.filter(F.size("p") > 1).distinct().join(grown, "p", "left_anti")
        rests = rests if counted is None else rests.join(counted, "p", "left_anti")
        rests = staged(_summed(_sent(held, staged(rests, "rests"), longest, None), least).select("p", "f"), "rest_counts")
        counted = rests if counted is None else staged(counted.unionByName(rests), "all_counted")
        known = grown.select("p", "f").unionByName(counted).unionByName(singles)
        # One word more, before or after, and no occurrence less: such a phrase goes.
        after = new.filter(F.size("p") > 2).select(F.slice("p", 1, F.size("p") - 1).alias("p"), F.col("f").alias("longer")).groupBy("p").agg(F.max("longer").alias("longer"))
        same_before = (F.col("before_min") == F.col("before_max")) & (F.col("before_min") > RARE) & (F.size("p") < longest)
        alive = wanted.filter(~same_before).join(after, "p", "left").filter(F.coalesce(F.col("longer"), F.lit(0)) < F.col("f"))
        best = alive.select("p", "f", "n", "lang").join(_scored(alive.select("p", "f", "n"), known), "p").select(
            "p", F.col("f").alias("a"), "n", "lang", "best.*")
        scored = staged(best if scored is None else best.unionByName(scored), "scored")
        order = Window.partitionBy("lang").orderBy(F.desc("score"))
        ranks = scored.select("lang", "score", F.row_number().over(order).alias("rank")).filter(F.col("rank") <= most)
        floor = ranks.filter(F.col("rank") == most).select("lang", F.col("score").alias("least_score"))
        frontier = staged(frontier.drop("least_score", "low").join(floor, "lang", "left"), "frontier")
    return _ranked_phrases(scored.join(frontier.select("lang", "least_score"), "lang")
                           .filter(F.col("score") >= F.coalesce("least_score", F.lit(0))), words, most)


def _ranked_phrases(scored: DataFrame, words: DataFrame, most: int) -> DataFrame:
    """The phrases' words, and each language's first ``most``."""
    each = scored.select("p", F.posexplode("p").alias("at", "id")).join(words.select("id", "word"), "id")
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ")
    named = scored.join(each.groupBy("p").agg(phrase.alias("phrase")), "p")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of each language of ``documents``."""
    return mine(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (SELECT lang, list_slice(w, i, i + k - 1) AS p FROM places, range(1, 6) t(k) WHERE i + k - 1 <= len(w)),
counts AS (SELECT lang, p, len(p) AS k, count(*) AS f FROM grams GROUP BY lang, p HAVING count(*) >= 100),
cuts AS (
  SELECT c.lang, c.p, c.f AS a, t.n, x.f AS l, y.f AS r, x.k,
         CAST(CAST(1000 AS HUGEINT) * c.f * t.n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM counts c JOIN totals t ON t.lang = c.lang
  JOIN counts x ON x.lang = c.lang AND x.k < c.k AND x.p = list_slice(c.p, 1, x.k)
  JOIN counts y ON y.lang = c.lang AND y.p = list_slice(c.p, x.k + 1, c.k)
  WHERE c.k >= 2),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
alive AS (
  SELECT b.* FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM counts q WHERE q.lang = b.lang AND q.k = len(b.p) + 1 AND q.f >= b.a
      AND (list_slice(q.p, 1, q.k - 1) = b.p OR list_slice(q.p, 2, q.k) = b.p)))
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM alive)
WHERE rank <= 2000
"""
