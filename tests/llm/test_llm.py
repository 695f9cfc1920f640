"""Each operator against a plain version, and the awkward inputs: nulls, empty and
long texts, ties, repeated rows, empty tables, extra columns of clashing names."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from llm import brute
from tripflow.llm import common, language_model, minhash, neighbours, packing, pii, quality, secret_scan, segmentation, sharding, token_files, tokens
from tripflow.llm.components import components
from tripflow.llm.embedding_dedup import codewords, decode, deduplicate
from tripflow.session import work_path

SF = "/root/testdata/sf0.001"
LONG = "word " * 9000
AWKWARD = [(0, None), (1, ""), (2, " "), (3, "one"), (3, "one"), (4, LONG), (5, "é😀 a\n\tb\xa0c"), (None, "null key"),
           (None, None), (7, "x" * 3000), (8, " \x85 <|endoftext|> It's NOT.,! 3.14 ÀÉ")]


@pytest.fixture(autouse=True)
def prepared(spark):
    common.prepare(spark)


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.tokenizer_path())
    return lambda x: np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4")


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def clashing(df):
    """Columns of the names that the operators use for results and inside."""
    names = "_part _at _spread _shard _n _first _base part_ at n base spread body own other score trusted decoded row id vector first component others _own _label _vector key found kept class_id threshold shard slot _key _row _class n_links part ids cid n_symbols label source".split()
    return df.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names) if n not in df.columns])


def query(name, spark, sf=SF):
    return entry.queries()[name](spark, sf)


# ---------------------------------------------------------------- tokens

def test_encoder_is_the_library(plain, texts):
    e = tokens.Encoder(tokens.tokenizer_path(), memo_chars=2000)
    some = [t for _, t in AWKWARD] + list(texts.values())
    for at in range(0, len(some), 7):
        for t, got in zip(some[at:at + 7], e.encode(some[at:at + 7])):
            assert got == plain(t).astype(e.dtype).tobytes()


def test_op1_files_give_back_every_id(spark, texts, plain):
    rows = {r.doc_id: r for r in query("op1_token_files", spark).collect()}
    at = 0
    for k in sorted(texts):
        ids = plain(texts[k])
        assert (rows[k].start, rows[k].n_tokens, rows[k].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(rows) == len(texts)


def test_token_files_of_awkward_rows(spark, plain):
    root = work_path(spark, "files")
    token_files.write(clashing(frame(spark, AWKWARD)), root, shards=3)
    got = token_files.read_ids(spark, root).collect()
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.ids) for r in got), key=key) == sorted(((k, plain(t).tolist()) for k, t in AWKWARD), key=key)
    starts = sorted((r.start, r.n_tokens) for r in token_files.read(spark, root).collect())
    assert [a for a, _ in starts] == np.cumsum([0] + [n for _, n in starts])[:-1].tolist()


def test_token_files_of_an_empty_table(spark):
    root = work_path(spark, "files")
    token_files.write(frame(spark, []), root)
    assert token_files.read(spark, root).count() == 0


def packed_right(pieces, rows, plain, size):
    per, seqs = defaultdict(list), defaultdict(list)
    for p in pieces:
        per[p.doc_id].append(p)
        seqs[p.sequence_id].append((p.offset, p.length))
    for k, t in rows:
        ids, at = plain(t), 0
        for p in sorted(per[k], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    assert sorted(seqs) == list(range(len(seqs)))
    for k, v in seqs.items():
        ends = np.cumsum([n for _, n in sorted(v)])
        assert [o for o, _ in sorted(v)] == [0, *ends[:-1]] and (ends[-1] == size or k == len(seqs) - 1)


def test_op7_packs_every_id_once(spark, texts, plain):
    packed_right(query("op7_packing", spark).collect(), texts.items(), plain, 2048)


def test_packing_of_awkward_rows(spark, plain):
    rows = [(i, t) for i, (_, t) in enumerate(AWKWARD)]
    pieces = packing.pack(clashing(frame(spark, rows)).repartition(3), size=64)
    packed_right(pieces.collect(), rows, plain, 64)
    seqs = packing.sequences(pieces).collect()
    assert sum(len(s.ids) // 2 for s in seqs) == sum(len(plain(t)) for _, t in rows)
    assert packing.pack(frame(spark, [])).count() == 0
    again = packing.pack(frame(spark, AWKWARD), size=64).agg(F.sum("length")).first()[0]
    assert again == sum(len(plain(t)) for _, t in AWKWARD)


# ---------------------------------------------------------------- sharding

def jump(key, n):
    key, b, j = key % (1 << 64), -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % (1 << 64)
        j = int(float(b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash():
    keys = np.array([0, 1, -1, 2**63 - 1, -2**63, *np.random.default_rng(1).integers(-2**63, 2**63 - 1, 500)])
    for n in (1, 2, 40, 41, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [jump(int(k), n) for k in keys]


def test_op2_against_plain(spark, texts):
    rows = query("op2_jump_shards", spark).collect()
    by = defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert (r.shard, r.grown_shard) == (jump(r.doc_id, 40), jump(r.doc_id, 41))
        by[r.shard].append((r.slot, r.doc_id))
    assert len(rows) == len(texts)
    for v in by.values():
        assert [s for s, _ in sorted(v)] == list(range(len(v))) and [d for _, d in sorted(v)] == sorted(d for _, d in v)


def test_shards_of_awkward_rows(spark):
    df = clashing(frame(spark, AWKWARD + [(3, "one")] * 50)).drop("shard")
    out = sharding.slots(sharding.assign(df, "doc_id", 5), ["doc_id", "text"]).collect()
    assert len(out) == len(AWKWARD) + 50 and {r.shard for r in out if r.doc_id is None} == {jump(0, 5)}
    for s in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    assert sharding.slots(sharding.assign(frame(spark, []), "doc_id", 5), ["doc_id"]).count() == 0
    path = work_path(spark, "shards")
    sharding.write_shards(frame(spark, AWKWARD), "doc_id", 5, path)
    assert spark.read.parquet(path).count() == len(AWKWARD)


# ---------------------------------------------------------------- patterns

CASES = ["", None, "a@b.c+d@e.f x@y  a.b@c-d.e.f.g. @x.y", "1.2.3.4.5.6.7.8 256.1.1.1 000255.1.1.0001 1.2.3",
         "4111 1111 1111 1111 x 4111-1111-1111-1111-1 5--4111111111111111", "4111111111111111 4111111111111111",
         "+1 (658) 555-4270 4355709550244650 +49 123 4567 890) +1..2", "+1234567890+1234567890 " + "9" * 300,
         "é😀 a@b.co 😀 1.2.3.4 é +33 1 23 45 67 89", "a" * 3000, "1 " * 900, "1." * 900, "+1" + " 1" * 900,
         "a.b" * 300 + "@x.y " + "x@y.z " * 600, "Password: 'abcdefgh' API_KEY=\"12345678 token==x secret : short",
         "apikey:aaaaaaaaaaaa passwd=........", "AKIA" + "A" * 11 + " AKIA" + "B" * 12 + " xAKIA" + "0" * 400,
         "f" * 31 + " " + "0" * 32 + "g" + "ab" * 900, "token" + " " * 900 + "=abcdefghij",
         "tokentoken=abcdefghijk secretpassword:aaaaaaaa", "ſecret=abcdefghijkl toKen=abcdefghijkl"]


@pytest.mark.parametrize("name, kinds, by_start", [("op5_pii", brute.PII, False), ("op9_secret_scan", brute.SECRETS, True)])
def test_patterns_against_plain(spark, texts, name, kinds, by_start):
    path = work_path(spark, "patterns")
    rows = list(enumerate(CASES)) + [(1000 + k, t) for k, t in texts.items()]
    clashing(frame(spark, rows)).write.parquet(f"{path}/documents.parquet")
    out = {r.doc_id: r for r in query(name, spark, path).collect()}
    assert len(out) == len(rows)
    for k, t in rows:
        found = brute.spans(t, kinds, by_start)
        assert out[k].base_sha256 == brute.digest(found), t
        assert {kind: out[k][f"n_{kind}"] for kind, _, _ in kinds} == {kind: sum(f[0] == kind for f in found) for kind, _, _ in kinds}
        assert set(brute.joined(found).split(",")) <= set(out[k].spans.split(",")) or not found


@pytest.mark.parametrize("name", ["op5_pii", "op9_secret_scan"])
def test_patterns_repeated_and_empty(spark, name):
    path, other = work_path(spark, "patterns"), work_path(spark, "patterns")
    frame(spark, [(1, "a@b.co"), (1, "a@b.co"), (None, "a@b.co"), (None, None)]).write.parquet(f"{path}/documents.parquet")
    assert query(name, spark, path).count() == 4
    frame(spark, []).write.parquet(f"{other}/documents.parquet")
    assert query(name, spark, other).count() == 0


def test_trigram_queries_hold_for_every_match():
    q = secret_scan.trigram_query
    assert q(r"AKIA[A-Z0-9]+") == [{"aki", "kia"}]
    assert q("[0-9a-f]+") is None and q("(abcd)?x") is None and q("ab") is None
    assert q("abc(d|e)?") == [{"abc"}] and q("(abc|xyz)+") == [{"abc"}, {"xyz"}]
    for rule, kind in zip(secret_scan.BASE, brute.SECRETS):
        for text in filter(None, CASES):
            for m in kind[1].finditer(text):
                low = m[0].lower()
                assert q(rule.pattern) is None or any(all(t in low for t in ands) for ands in q(rule.pattern)), m[0]


def test_added_rules(spark):
    text = "-----BEGIN RSA " + "PRIVATE KEY----- gh" + "p_" + "a" * 40 + " xox" + "b-" + "1" * 12
    kinds = [s.kind for s in secret_scan.scan(frame(spark, [(1, text)])).first().found]
    assert {"pem", "github", "slack"} <= set(kinds)


def test_disclosing_terms(spark):
    """A term that stands only beside one entity is removed, a common one stays."""
    rows = [(i, f"alpha{'' if i else ''} common zebrafish {'abcdefghij'[i]}{'abcdefghij'[i]}{'abcdefghij'[i]} boss@corp.com") for i in range(6)]
    rows += [(100 + i, f"common words here {'klmnopqrstuvwxyz'[i % 16] * 4}") for i in range(200)]
    rows += [(500, "copy of hapaxword one@two.com")] * 50
    out = {r.doc_id: r.found for r in pii.find(frame(spark, rows)).collect()}
    text = dict(rows)
    terms = {i: {text[i][s.start:s.end] for s in out[i] if s.kind == "term"} for i in out}
    assert all("zebrafish" in terms[i] and "common" not in terms[i] for i in range(6))
    assert all(not terms[i] for i in out if i >= 100)
    clean = {r.doc_id: r.text for r in pii.sanitise(frame(spark, rows)).collect()}
    assert "zebrafish" not in clean[0] and "common" in clean[0] and clean[0].endswith("[EMAIL]")
    assert clean[100] == text[100] and clean[500] == "copy of hapaxword [EMAIL]"


@pytest.mark.parametrize("n", [2, 3, 4])
def test_few_consistent_texts_disclose(spark, n):
    """Two to four texts tell a rare name, chance pairs and words of one text nothing."""
    rows = [(i, f"common zebrafish {'abcd'[i] * 4} boss@corp.com") for i in range(n)]
    rows += [(10 + i, f"common lonely{'xyzw'[i]} rare solo{'xyzw'[i]}@corp.com") for i in range(2)]
    rows += [(20, "sometimes " + "mixed@corp.com"), (21, "never mixed@corp.com")]
    rows += [(100 + i, f"common words {'sometimes' if i % 9 == 0 else 'here'} {i}") for i in range(600)]
    text, out = dict(rows), {r.doc_id: r.found for r in pii.find(frame(spark, rows)).collect()}
    terms = {i: {text[i][s.start:s.end] for s in out[i] if s.kind == "term"} for i in out}
    assert all(terms[i] == ({"zebrafish"} if i < n else set()) for i in out)


def test_sanitise_overlaps_and_nulls(spark):
    rows = [(1, "é a@1.2.3.4.5.6 b +1 (658) 555-4270, 4111 1111 1111 1111"), (2, None), (3, "")]
    clean = {r.doc_id: r.text for r in pii.sanitise(clashing(frame(spark, rows))).collect()}
    assert clean == {1: "é [EMAIL] b [PHONE], [CARD]", 2: None, 3: ""}


# ---------------------------------------------------------------- graphs and vectors

def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(2)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 180)] + \
        [tuple(map(int, p)) for p in rng.integers(200, 400, (120, 2))] + [(7, 7)]
    want = roots({x for p in pairs if p[0] != p[1] for x in p}, pairs)
    got = components(frame(spark, pairs, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert components(frame(spark, [], "a long, b long")).count() == 0


def vector_rows():
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 16))
    rows = []
    for i in range(400):
        v = base[i % 60] + (rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.3]))
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(i % 3)))
    rows += [(400 + i, rows[0][1], 0) for i in range(30)]
    rows += [(500, None, 1), (501, [0.0] * 16, 1), (502, [float("nan")] + [1.0] * 15, 1), (503, [None] + [1.0] * 15, 1),
             (504, [float("inf")] + [1.0] * 15, 1), (505, rows[0][1], None), (506, [1.0, 2.0], 0), (507, [2.0, 4.0], 0)]
    return rows


VECTORS = "vec_id long, embedding array<float>, label int"


def as_matrix(rows):
    ok = {r[0]: np.array(r[1], float) for r in rows if r[1] and None not in r[1]}
    return {k: v for k, v in ok.items() if np.isfinite(v).all() and v.any()}


@pytest.mark.parametrize("chunk", [2000, 8])
def test_op8_against_brute_force(spark, chunk):
    rows = vector_rows()
    ok, label = as_matrix(rows), {r[0]: r[2] for r in rows}
    pairs = [(a, b) for a in ok for b in ok if a < b and label[a] is not None and label[a] == label[b] and len(ok[a]) == len(ok[b])
             and ok[a] @ ok[b] / np.linalg.norm(ok[a]) / np.linalg.norm(ok[b]) >= 0.98]
    n = Counter(x for p in pairs for x in p)
    want = roots([r[0] for r in rows], pairs)
    out = deduplicate(clashing(frame(spark, rows, VECTORS)), chunk=chunk).collect()
    assert len(out) == len(rows) and len(pairs) > 500
    for r in out:
        assert (r.n_links, r.component_id, r.kept) == (n[r.vec_id], want[r.vec_id], r.vec_id == want[r.vec_id])


def test_caps_of_vectors_at_the_threshold_meet():
    rng, codes = np.random.default_rng(1), codewords(64, 895)
    x, g = rng.standard_normal((2, 5000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g -= (g * x).sum(1, keepdims=True) * x
    g /= np.linalg.norm(g, axis=1, keepdims=True)
    own, other = decode(x, codes, 24), decode(0.98 * x + math.sqrt(1 - 0.98 ** 2) * g, codes, 24)
    assert all(len(set(a.tolist()) & set(b.tolist())) for a, b in zip(own, other))
    assert 23 < np.mean([len(c) for c in own]) < 28
    n, plain = len(codes[1]), (x[:50, :32] @ codes[0].T)[:, :, None] + (x[:50, 32:] @ codes[1].T)[:, None, :]
    for c, sums in zip(own, plain.reshape(50, -1)):  # all directions down to the height, and no other
        assert set(np.argsort(-sums)[:len(c)].tolist()) == set(c.tolist()) and n ** 2 == sums.size


def test_op8_on_the_table_and_empty(spark):
    from oracle_compare import compare, duck
    sql = entry.oracle_sql()["op8_cap_filters"]
    assert compare(query("op8_cap_filters", spark), duck(SF), sql)["exact"]
    assert deduplicate(frame(spark, [], VECTORS)).count() == 0
    assert deduplicate(frame(spark, [(1, [1.0, 0.0], 1)] * 3, VECTORS).union(frame(spark, [(None, [1.0, 0.0], 1)], VECTORS))).count() == 4


def test_op3_recall_and_order(spark):
    rows = vector_rows()
    ok = as_matrix(rows)
    out = defaultdict(list)
    for r in neighbours.nearest(clashing(frame(spark, rows, VECTORS)), F.col("vec_id") % 7 == 0, share=0.5, least=100).collect():
        out[r.query_id].append((r.rank, r.vec_id, r.score))
    hits = total = 0
    for q in ok:
        if q % 7:
            continue
        d = sorted((math.dist(ok[q], v), k) for k, v in ok.items() if k != q and len(v) == len(ok[q]))[:10]
        got = sorted(out[q])
        assert [x[0] for x in got] == list(range(1, len(d) + 1))
        assert [x[1:] for x in got] == sorted((x[1:] for x in got), key=lambda x: (x[1], x[0]))
        assert all(abs(s - math.dist(ok[q], ok[v])) < 1e-9 for _, v, s in got)
        hits += len({v for _, v, _ in got} & {k for _, k in d})
        total += len(d)
    assert hits >= 0.9 * total and set(out) <= set(ok)
    assert [x[1] for x in sorted(out[0])][:3] == [400, 401, 402]  # copies of the query, by id


def test_op3_on_the_table_and_empty(spark):
    assert query("op3_multi_index", spark).count() == 50
    assert neighbours.nearest(frame(spark, [], VECTORS), F.lit(True)).count() == 0


def test_walk_visits_cells_by_distance():
    rng = np.random.default_rng(0)
    near, far = rng.random(6), rng.random(5)
    sizes = {(i, j): 1 for i in range(6) for j in range(5)}
    cells = neighbours.walk(near, far, sizes, 30)
    d = [near[i] + far[j] for i, j in cells]
    assert len(set(cells)) == 30 and d == sorted(d)


# ---------------------------------------------------------------- near-duplicate texts

def shingle_set(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    n = min(5, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def text_classes(rows):
    sets = [shingle_set(t) for _, t in rows]
    pairs = []
    for i in range(len(rows)):
        for j in range(i):
            both, a, b = len(sets[i] & sets[j]), len(sets[i]), len(sets[j])
            if rows[i][1] and rows[i][1] == rows[j][1] or both and both >= 0.8 * (a + b - both) - 1e-9:
                pairs.append((i, j))
    return roots(range(len(rows)), pairs)


def test_dart_minhash_estimates_weighted_jaccard():
    rng = np.random.default_rng(1)
    e = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))
    a, b = rng.random(len(e)) * 6, rng.random(len(e)) * 6
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    got = np.mean([(minhash.dart_minhash(e, a, 64, s) == minhash.dart_minhash(e, b, 64, s)).mean() for s in range(60)])
    assert abs(want - got) < 0.03
    assert (minhash.dart_minhash(e[:1], np.ones(1), 64) == minhash.dart_minhash(e[:1], np.ones(1), 64)).all()


@pytest.mark.parametrize("chunk", [500, 4])
def test_near_classes_against_brute_force(spark, chunk):
    rng = np.random.default_rng(9)
    rows = [(i, t) for i, t in enumerate(t for _, t in AWKWARD)]
    for g in range(6):
        words = [f"w{x}" for x in rng.integers(0, 500, 120)]
        for c in range(9):
            own = list(words)
            for at in rng.integers(0, 120, int(rng.integers(0, 6))):
                own[at] = f"v{rng.integers(0, 10**6)}"
            rows.append((len(rows), " ".join(own)))
    want = text_classes(rows)
    out = {r.doc_id: r for r in minhash.deduplicate(clashing(frame(spark, rows)), chunk=chunk).collect()}
    assert {k: out[k].class_id for k in out} == want
    sizes = Counter(want.values())
    assert all(out[k].class_rows == sizes[want[k]] and out[k].kept == (k == want[k]) for k in out)


def test_op10_on_the_table(spark, texts):
    rows = list(texts.items())
    out = {r.doc_id: r.class_id for r in query("op10_dart_minhash", spark).collect()}
    near = text_classes(rows)
    want = {rows[i][0]: min(rows[j][0] for j in near if near[j] == near[i]) for i in near}
    assert out == want


def test_representatives(spark):
    rows = AWKWARD + [(20, LONG + "end"), (None, "null key")]
    got = minhash.representatives(clashing(frame(spark, rows)))
    assert got.columns == clashing(frame(spark, rows)).columns
    keys = Counter((r.doc_id, r.text) for r in got.collect())
    assert max(keys.values()) == 1 and sum(keys.values()) == len(AWKWARD)
    assert minhash.representatives(frame(spark, [])).count() == 0


# ---------------------------------------------------------------- quality

def discounts(n):
    """Chen and Goodman's discounts from the number of n-grams seen once to four times."""
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
    raw = [i - (i + 1) * y * n[i + 1] / n[i] if n[i] else y * i for i in (1, 2, 3)]
    return [min(max(d, 0.0), float(i)) for i, d in enumerate(raw, 1)]


def test_quality_on_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = query("op6_kneser_ney", spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and r.toxic == 0]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.35


def test_quality_of_awkward_rows(spark):
    docs = clashing(frame(spark, [(k, t, "en" if i % 2 else None) for i, (k, t) in enumerate(AWKWARD)], "doc_id long, text string, lang string"))
    labels = frame(spark, [(3, 1, 0), (None, 1, 0), (4, 1, None)], "doc_id long, quality int, toxic int")
    out = quality.classify(docs, labels).collect()
    assert len(out) == len(AWKWARD) and all(r.kept and r.log_perplexity is None for r in out if not r.text)
    assert all(r.kept for r in quality.classify(docs, labels.limit(0)).collect())
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_levels_differ_by_language(spark):
    """A quantile for each language, drawn to that of all by the weight of 1 / (1 - quantile) texts."""
    draw, rows = np.random.default_rng(8), []
    for lang, m, tail in (("en", 4000, 0.0), ("fr", 4000, 2.0)):  # fr: some trusted texts lie far off
        off = draw.normal(size=m) + tail * (draw.random(m) < 0.05) * 3
        rows += [(lang, 400, float(2.0 + x / 20)) for x in off]
    got = {r.lang: r for r in quality.limits(frame(spark, rows, "lang string, n_symbols long, log_perplexity double"), 0.99).collect()}
    units = {}
    for lang in ("en", "fr"):
        y = np.array([r[2] for r in rows if r[0] == lang])
        units[lang] = (y - np.median(y)) * 20 / np.median(abs(y - np.median(y)) * 20)
    whole = np.quantile(np.concatenate(list(units.values())), 0.99)
    for lang, u in units.items():
        want = (4000 * np.quantile(u, 0.99) + 100 * whole) / 4100
        assert abs(got[lang].level - want) < 0.25, lang
    assert abs(got[None].level - whole) < 0.25 and got["fr"].level - got["en"].level > 2


def open_kneser_ney(texts):
    """The probabilities of unfolded code points by dictionaries, of ``texts``."""
    order = language_model.ORDER
    counts = [Counter() for _ in range(order + 1)]
    for t in texts:
        s = [0] * (order - 1) + [ord(c) for c in t]
        counts[order].update(tuple(s[i - order + 1:i + 1]) for i in range(order - 1, len(s)))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut = [discounts(Counter(c.values())) for c in counts]
    context = [defaultdict(list) for _ in counts]
    for k, c in enumerate(counts):
        for g, n in c.items():
            context[k][g[:-1]].append(n)

    def p(g):
        if not g:
            return 1 / 0x110000
        k, seen = len(g), context[len(g)].get(g[:-1])
        if not seen:
            return p(g[1:])
        d, n = lambda n: cut[k][min(n, 3) - 1], counts[k].get(g, 0)
        return (n - d(n) if n else 0) / sum(seen) + sum(map(d, seen)) / sum(seen) * p(g[1:])

    def perplexity(t):
        s = [0] * (order - 1) + [ord(c) for c in t]
        return -sum(math.log(p(tuple(s[i - order + 1:i + 1]))) for i in range(order - 1, len(s))) / len(t)
    return perplexity


@pytest.mark.parametrize("piece", [1 << 20, 700])
def test_open_perplexity_against_plain(spark, texts, piece, monkeypatch):
    monkeypatch.setattr(language_model, "PIECE", piece)
    some = [*dict.fromkeys(t[:600] for t in list(texts.values())[:30] if t), "Ωμέγα και άλφα 日本語", "a"]
    some += some[:3]  # copies are in one fold
    keys = [hashlib.md5(t.encode()).hexdigest() for t in some]
    rows = [(k, i % 2 == 0, t) for i, (k, t) in enumerate(zip(keys, some))]
    got = {r.key: r.log_perplexity for r in language_model.scores(frame(spark, rows, "key string, trusted boolean, text string")).collect()}
    plain = [open_kneser_ney([t for k, good, t in rows if good and int(k[0], 16) % 2 != fold]) for fold in (0, 1)]
    assert set(got) == set(keys)
    for k, _, t in rows:
        assert abs(got[k] - plain[int(k[0], 16) % 2](t)) < 1e-5


def test_letter_noise_in_other_scripts_is_rejected(spark):
    draw, letters = np.random.default_rng(5), "абвгдежзиклмнопрст"
    words = ["".join(draw.choice(list(letters), n)) for n in draw.integers(3, 8, 60)]
    good = [" ".join(draw.choice(words, 80)) for _ in range(80)]
    noise = [" ".join("".join(draw.choice(list(letters), len(w))) for w in t.split()) for t in good[:40]]  # equal word lengths
    docs = frame(spark, [(i, t, "ru") for i, t in enumerate(good + noise)], "doc_id long, text string, lang string")
    labels = frame(spark, [(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in quality.classify(docs, labels).collect()}
    assert all(kept[i] for i in range(60)) and sum(kept[i] for i in range(60, 80)) >= 18
    assert not any(kept[i] for i in range(80, 120))


def test_one_rule_for_small_languages_and_classes(spark):
    draw, rows = np.random.default_rng(3), []
    for lang, m, middle in (("en", 3000, 1.5), ("fr", 60, 1.8)):
        n = draw.integers(100, 4000, m)
        rows += [(lang, int(k), float(middle + draw.normal() / math.sqrt(k))) for k in n]
    rows += [("fr", 4, 3.0)]  # a very short text with a large perplexity moves no other length
    got = {r.lang: r for r in quality.limits(frame(spark, rows, "lang string, n_symbols long, log_perplexity double")).collect()}
    assert set(got) == {"en", "fr", None}
    for lang, middle in (("en", 1.5), ("fr", 1.8)):
        r = got[lang]
        assert abs(r.middle - middle) < 0.02 and 2 < r.level * r.spread < 5


def test_quality_rejects_bad_of_all_languages(spark):
    sf = "/root/testdata/sf0.1"
    rows = query("op6_kneser_ney", spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and r.toxic == 0]
    assert np.mean(good) >= 0.998
    for langs in (["en"], ["de", "es", "fr"]):
        assert np.mean([r.kept for r in rows if r.quality == 0 and r.lang in langs]) <= 0.11


# ---------------------------------------------------------------- segmentation

def all_paths(own, text):
    def go(s):
        if not s:
            yield (), 0.0
            return
        for j in range(1, len(s) + 1):
            if w := own.weight.get(s[:j]):
                yield from (((w[0], *r), w[1] + p) for r, p in go(s[j:]))
        if s[0] not in own.weight:
            raw = s[0].encode()
            yield from (((*(own.bytes[x] for x in raw), *r), own.byte_weight * len(raw) + p) for r, p in go(s[1:]))
    found = list(go(segmentation.SPACE + text.replace(" ", segmentation.SPACE)))
    z = np.logaddexp.reduce([p for _, p in found])
    return {ids: p - z for ids, p in found}


@pytest.mark.parametrize("text", ["thinnt", "ab  c\n", "é😀"])
def test_samples_follow_the_model_without_replacement(text):
    own, n = segmentation.Lattice(segmentation.model_path()), 6000
    want = all_paths(own, text)
    out = segmentation.sample_texts([text] * n, minhash.mix(np.arange(n, dtype=np.uint64)), own, 3)
    first, pair = Counter(), Counter()
    for o in out:
        ids = [tuple(r[0].tolist()) for r in o]
        assert len(set(ids)) == len(ids) == min(3, len(want)) and [r[2] for r in o] == sorted((r[2] for r in o), reverse=True)
        assert all(abs(want[i] - r[1]) < 1e-4 and r[3] <= 0 for i, r in zip(ids, o))
        first[ids[0]] += 1
        if len(ids) > 1:
            pair[ids[0], ids[1]] += 1
    assert all(abs(first[s] / n - math.exp(p)) < 0.03 for s, p in want.items())
    assert all(abs(c / n - math.exp(want[a] + want[b]) / -math.expm1(want[a])) < 0.03 for (a, b), c in pair.items())


def test_unlikely_segmentations_are_not_lost():
    own = segmentation.Lattice(segmentation.model_path())
    want = all_paths(own, "t")
    out = segmentation.sample_texts(["t"] * 50, minhash.mix(np.arange(50, dtype=np.uint64)), own, 3)
    assert len(want) == 2 and min(want.values()) < math.log(1e-6)
    for o in out:
        assert {tuple(r[0].tolist()) for r in o} == set(want)
        assert all(abs(want[tuple(r[0].tolist())] - r[1]) < 1e-4 for r in o)


def test_op4_round_trip(spark, texts):
    rows = query("op4_sampled_pieces", spark).collect()
    assert len(rows) == 2 * len(texts)
    assert all(r.decoded_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    assert len({(r.doc_id, r.ids_crc32) for r in rows}) == len(rows)


def test_samples_of_awkward_rows(spark):
    got = segmentation.decode(segmentation.sample(clashing(frame(spark, AWKWARD)), k=3)).collect()
    assert Counter((r.doc_id, r.decoded) for r in got if r["sample"] == 1) == Counter((k, t or "") for k, t in AWKWARD)
    again = segmentation.sample(frame(spark, AWKWARD).repartition(3), k=3).collect()
    assert Counter((r.doc_id, r["sample"], bytes(r.ids)) for r in got) == Counter((r.doc_id, r["sample"], bytes(r.ids)) for r in again)
    assert segmentation.sample(frame(spark, [])).count() == 0


# ---------------------------------------------------------------- pipeline

def test_stages_of_awkward_rows(spark):
    sf = work_path(spark, "sf")
    labels = frame(spark, [(3, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{sf}/labels.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(k, t, "en", None, len(t or "")) for k, t in AWKWARD]
    for some in (rows, []):
        docs = clashing(spark.createDataFrame(some, schema)).drop("_row")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            if name != "packing":
                assert out.columns == docs.columns, name
                docs = common.staged(out, name)
                assert (docs.count() > 0) == bool(some)
            else:
                assert (out.count() > 0) == bool(some)


def test_pipeline_keeps_clean_documents(spark, plain):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = common.staged(stage(spark, docs, sf), name)
        kept[name] = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = list(kept["quality"].items())
    near = text_classes(rows) if len(rows) < 400 else None
    assert set(kept["near_dedup"]) <= set(kept["quality"]) and (near is None or len(kept["near_dedup"]) == len(set(near.values())))
    assert set(kept["pii"]) == set(kept["near_dedup"])
    for k, t in kept["near_dedup"].items():
        found = brute.spans(t, brute.PII)
        assert (kept["pii"][k] == t) if not found else all(t[a:b] not in kept["pii"][k] for _, a, b, _ in found)
    pieces = corpus_pipeline.STAGES[3][1](spark, docs, sf).collect()
    packed_right(pieces, kept["pii"].items(), plain, 2048)
    assert query("pipeline", spark, sf).count() == len(pieces)


def test_segmentation_branch_does_not_copy_the_lattice():
    import tracemalloc
    n = 2_000_000
    t = {"starts": np.arange(0, 2 * n, 2, dtype=np.int32), "logp": np.full(2 * n, -0.7, np.float32), "others": np.full(2 * n, -0.7, np.float32)}
    search = segmentation._Search(2, 7, t, np.zeros(3, np.int32))
    search.add(0.0, np.array([6, 2 * n - 10, 78], np.int32), np.arange(3), 0)
    tracemalloc.start()
    found = search.branch()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[3] in (7, 2 * n - 9, 79) and peak < 1_000_000


def test_segmentation_decodes_in_the_same_task(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["one two", "a  b", "", None, "é日本 ▁ x"])], "doc_id long, text string")
    both = segmentation.sample(docs, into="decoded")
    assert both._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    apart = segmentation.decode(segmentation.sample(docs))
    assert both.columns == apart.columns and sorted(both.collect()) == sorted(apart.collect())


def test_segmentation_chunks_are_those_of_the_words():
    texts = ["", None, " ", "a", " a b", "a  b ", "one two\nthree", "▁x y", "x ▁ y", "  ", "tail  ", "é日本 ok", "one two", "a\tb c"] * 3
    own = segmentation.Lattice(segmentation.model_path())
    found = segmentation._numbers(texts, own)
    name = {n: c for c, n in own.chunks.items()}
    assert [[name[n] for n in x.tolist()] for x in found] == [segmentation.chunks_of(t) for t in texts]


def test_segmentation_searches_texts_together(monkeypatch):
    own, calls, mix = segmentation.Lattice(segmentation.model_path()), [], segmentation.mix
    monkeypatch.setattr(segmentation, "mix", lambda x: calls.append(1) or mix(x))
    counts, found = [], []
    for n in (5, 200):
        calls.clear()
        found.append(segmentation.sample_texts(["one two, three"] * n, mix(np.arange(n, dtype=np.uint64)), own, 2))
        counts.append(len(calls))
    assert counts[1] < counts[0] + 20  # steps of the longest path, not texts
    plain = lambda rows: [(ids.tolist(), *x) for ids, *x in rows]
    assert [plain(x) for x in found[0]] == [plain(x) for x in found[1][:5]]
    alone = [segmentation.sample_texts(["one two, three"], mix(np.array([i], np.uint64)), own, 2)[0] for i in range(5)]
    assert [plain(x) for x in alone] == [plain(x) for x in found[0]]


def test_segmentation_looks_up_a_task_s_words_once(monkeypatch):
    asked, numbers = [], segmentation.Lattice.numbers
    monkeypatch.setattr(segmentation, "_CHARS", 100)
    monkeypatch.setattr(segmentation.Lattice, "numbers", lambda self, chunks: asked.extend(chunks) or numbers(self, chunks))
    texts = ["some words that repeat"] * 50
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(50), pa.int64()), "text": texts})
    rows = pa.Table.from_batches(segmentation._sampled(2, 7, 1.0, segmentation.model_path())(iter([batch])))
    assert rows.num_rows == 100 and sorted(asked) == sorted(segmentation.chunks_of(texts[0]))


def test_segmentation_units_built_apart_are_the_same(monkeypatch):
    texts, seeds = ["one two, thrée 日本 ▁ 😀x", "STTHRE  queenoioiré\n", ""] * 3, minhash.mix(np.arange(9, dtype=np.uint64))
    plain = lambda out: [[(ids.tolist(), *x) for ids, *x in rows] for rows in out]
    whole = segmentation.sample_texts(texts, seeds, segmentation.Lattice(segmentation.model_path()), 3)
    monkeypatch.setattr(segmentation, "_NODES", 3)
    apart = segmentation.sample_texts(texts, seeds, segmentation.Lattice(segmentation.model_path()), 3)
    assert plain(whole) == plain(apart)


def test_segmentation_edges_by_source_and_likelihood():
    rng = np.random.default_rng(5)
    for logp in (-rng.random(5000) * 40, -rng.integers(0, 3, 5000).astype(float), -rng.random(5000) * 1e-12, -rng.random(5000) * 4000, np.empty(0)):
        source = rng.integers(0, 900, len(logp))
        assert segmentation._by_source(source, logp).tolist() == np.lexsort((-logp, source)).tolist()


def test_segmentation_decodes_any_bytes():
    pieces, rng = segmentation.vocabulary(segmentation.model_path())[0], np.random.default_rng(6)
    for most in (300, len(pieces)):  # mostly single bytes, mostly pieces
        ids = [None if i % 9 == 0 else rng.integers(0, most, rng.integers(0, 7)).tolist() for i in range(300)]
        raw = pa.array([x if x is None else np.array(x, "<i4").tobytes() for x in ids], pa.binary())
        want = [x if x is None else b"".join(pieces[i] for i in x).decode("utf-8", "replace").replace("▁", " ")[1:] for x in ids]
        for a, n in ((0, 300), (0, 0), (0, 1), (17, 200)):
            batch = pa.RecordBatch.from_arrays([raw.slice(a, n)], names=["ids"])
            out, = segmentation._decoded(segmentation.model_path(), "ids", "text")(iter([batch]))
            assert out.column(1).to_pylist() == want[a:a + n]
    torn = pa.RecordBatch.from_arrays([pa.array([b"abc", b"defgh"], pa.binary())], names=["ids"])
    with pytest.raises(ValueError):
        next(segmentation._decoded(segmentation.model_path(), "ids", "text")(iter([torn])))
