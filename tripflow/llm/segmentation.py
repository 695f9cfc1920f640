"""SentencePiece segmentations sampled without replacement, and their decoding.

A text's segmentations are the paths of a lattice over its characters, an edge for
each piece of the vocabulary. The lattice falls apart at every place that no
piece spans: units between such places are built once per worker and met again
and again. For each node the edges' conditional probabilities come from the
backward sums over the unit's paths.

Gumbel top-k (Kool et al.) by a perturbed A* search: a search node is a path's
prefix with the set of edges that may not follow; its priority is the largest
perturbed log-probability of all segmentations below it, a Gumbel variable at the
node's exact log-probability, truncated at its parent's. The best segmentation
below a node is drawn edge by edge; what branches off the path goes into the queue,
of which at most the ``k`` best per path can ever come out. So the search yields
``k`` different segmentations, the largest perturbed first, and the next priority
``kappa`` gives each one's inclusion probability ``1 - exp(-exp(log_prob - kappa))``.
All random numbers are hashes of the row's key, so a row's samples are the same in
every run and on every executor.

A piece's weight is ``(2 + rank) ** -alpha``: a BPE vocabulary's scores are ranks, and
frequencies fall as a power of the rank. Characters without piece are spelled in
bytes. Null texts count as empty; an empty text has one segmentation, without
pieces. A null key counts as 0; rows with equal keys and texts get equal samples.
Texts with fewer than ``k`` segmentations give them all. An empty table gives no rows.
``sample`` returns its own columns alone; ``decode`` replaces a column of its result's name.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat
from math import exp, inf, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripflow.llm.minhash import mix, powers
from tripflow.llm.tokens import gathered

MODEL = "piece_bpe_32k.model"
K = 2
SPACE = "▁"
SAMPLES = ("doc_id long, sample int, n_pieces long, log_prob double, perturbed double, log_inclusion double, ids binary")
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_ODD = f"^$|^ |  | $|{SPACE}"  # in texts whose chunks aren't just a space and a word each
_CHARS = 500_000  # of texts that are sampled at once
_NODES = 100_000  # of units that are built at once
_ALL = (1 << 64) - 1
_GOLD, _STEP, _UNIT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53


def vocabulary(path: str) -> tuple[list[bytes], dict[int, int], dict[str, tuple[int, float]]]:
    """What each id spells, each byte's id, and the other pieces' ids and scores."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, of_byte, scores = [b""] * sp.get_piece_size(), {}, {}
    for i in range(len(pieces)):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            of_byte[int(piece[3:5], 16)] = i
            pieces[i] = bytes([int(piece[3:5], 16)])
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces[i] = piece.encode()
            scores[piece] = i, sp.get_score(i)
    return pieces, of_byte, scores


@lru_cache(maxsize=2)
def spelled(path: str) -> pa.Array:
    """What each id spells, for this process."""
    return pa.array(vocabulary(path)[0], pa.large_binary())


class Lattice:
    """The lattices of all units met so far: nodes, and edges by node, likeliest
    first. Emptied between batches when it has more than ``most`` edges."""

    def __init__(self, path: str, alpha: float = 1.0, most: int = 8_000_000):
        self.pieces, self.bytes, scores = vocabulary(path)
        size = len(self.pieces)
        self.byte_weight = -alpha * log(2 + size)
        self.weight = {p: (i, -alpha * log(2 + min(-score, size))) for p, (i, score) in scores.items()}
        self.kinds, self.inside = self._pairs()
        self.by_length = self._tables()
        self.most = most
        self._clear()

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Each character's kind, and which kinds some piece has side by side."""
        pairs = {p[n:n + 2] for p in self.weight for n in range(len(p) - 1)}
        kind = {c: n for n, c in enumerate(sorted(set("".join(pairs))), 1)}  # 0: all other characters
        kinds, inside = np.zeros(0x110000, np.uint16), np.zeros((len(kind) + 1,) * 2, bool)
        kinds[[ord(c) for c in kind]] = list(kind.values())
        for a, b in pairs:
            inside[kind[a], kind[b]] = True
        return kinds, inside

    def _tables(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each length the hashes of the pieces' beginnings, the piece that such
        a beginning is by itself (or -1) and its weight."""
        out = []
        for n in range(1, max(map(len, self.weight)) + 1):
            some = sorted({p[:n] for p in self.weight if len(p) >= n})
            own = [self.weight.get(p, (-1, 0.0)) for p in some]
            h = _hashes(_points("".join(some)))[np.arange(len(some)) * n, n]
            order = np.argsort(h)
            out.append((h[order], np.array([x[0] for x in own], np.int32)[order], np.array([x[1] for x in own])[order]))
        return out

    def _clear(self) -> None:
        self.chunks: dict[str, int] = {}
        self.units: dict[str, int] = {}
        self.roots, self.root_ends = array("i"), array("i", [0])
        self.starts = array("i", [0])
        self.piece, self.target, self.upto, self.logp = array("i"), array("i"), array("f"), array("f")
        self.others = array("f")  # log of the mass of the node's other edges

    def tidy(self) -> None:
        if len(self.piece) > self.most:
            self._clear()

    def numbers(self, chunks: list[str]) -> np.ndarray:
        """The chunks' numbers; new ones are learnt."""
        found = np.fromiter(map(self.chunks.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(found < 0).tolist()
        if new:
            new_ = [chunks[i] for i in new]
            self.learn(list(dict.fromkeys(new_)))
            found[new] = list(map(self.chunks.__getitem__, new_))
        return found

    def learn(self, chunks: list[str]) -> None:
        """Give new chunks numbers: cut them into units wherever no piece has the two
        characters side by side, and build the units that are new."""
        if not chunks:
            return
        text = "".join(chunks)
        points = _points(text)
        last = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
        kinds = self.kinds[points]
        cut = np.append(~self.inside[kinds[:-1], kinds[1:]], True)
        cut[last - 1] = True
        ends = np.flatnonzero(cut) + 1
        places = _places(points)[np.r_[0, ends]].astype(np.int32)
        parts = pa.StringArray.from_buffers(len(ends), pa.py_buffer(places), pa.py_buffer(text.encode())).dictionary_encode()
        names = _strings(parts.dictionary)
        self._build_all([u for u in names if u not in self.units])
        base = len(self.roots)
        own = np.fromiter(map(self.units.__getitem__, names), np.int32, len(names))
        self.roots.frombytes(own[parts.indices.to_numpy(zero_copy_only=False)].tobytes())
        self.root_ends.frombytes((base + np.searchsorted(ends, last, "right")).astype(np.int32).tobytes())
        n = len(self.chunks)
        self.chunks.update(zip(chunks, range(n, n + len(chunks))))

    def _build_all(self, units: list[str]) -> None:
        """Build units some at a time, as each node needs many numbers while it is built."""
        at, nodes = 0, 0
        for i, unit in enumerate(units):
            if nodes and nodes + len(unit) > _NODES:
                self._build(units[at:i])
                at, nodes = i, 0
            nodes += len(unit)
        self._build(units[at:])

    def _build(self, units: list[str]) -> None:
        """Nodes are the characters' places; a place's edges are the pieces that
        start there, or the bytes of a character that is no piece."""
        if not units:
            return
        points = _points("".join(units))
        size = np.array([len(u) for u in units])
        end = np.repeat(np.cumsum(size), size)
        h, at, found = _hashes(points), np.arange(len(points)), []
        bare = np.ones(len(points), bool)
        for n, (known, piece, weight) in enumerate(self.by_length, 1):
            at = at[at + n <= end[at]]
            own = h[at, n]
            i = np.minimum(np.searchsorted(known, own), len(known) - 1)
            hit = known[i] == own
            at, i = at[hit], i[hit]
            is_piece = piece[i] >= 0
            found.append((at[is_piece], at[is_piece] + n, piece[i[is_piece]], weight[i[is_piece]]))
            if n == 1:
                bare[at[is_piece]] = False
            if not len(at):
                break
        nodes, extra, chain = len(points), [], []
        for i in np.flatnonzero(bare).tolist():
            spelled = chr(points[i]).encode("utf-8", "surrogatepass")
            extra.append((i, i + 1, self.bytes[spelled[0]], self.byte_weight * len(spelled), nodes + len(chain) if spelled[1:] else -2))
            for k, byte in enumerate(spelled[1:], 2):  # -2: the edge goes where it ends
                chain.append((self.bytes[byte], nodes + len(chain) + 1 if k < len(spelled) else i + 1, i))
        source, to, piece, weight = (np.concatenate([f[k] for f in found] + [np.array([e[k] for e in extra], found[0][k].dtype)]) for k in range(4))
        target = np.concatenate([np.full(len(source) - len(extra), -2), np.array([e[4] for e in extra], np.int64)])
        target = np.where(target == -2, np.where(to == end[source], -1, to), target)
        beta = np.zeros(nodes + 1)
        far = end[source] - source
        order = np.argsort(far * (nodes + 1) + source, kind="stable")
        far = far[order]
        levels = np.concatenate((np.flatnonzero(np.r_[True, far[1:] != far[:-1]]), [len(order)]))
        for a, b in zip(levels[:-1].tolist(), levels[1:].tolist()):  # from the units' ends on
            e = order[a:b]
            s = source[e]
            first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
            value = weight[e] + np.where(to[e] == end[s], 0.0, beta[to[e]])
            beta[s[first]] = np.logaddexp.reduceat(value, first)
        logp = weight + np.where(to == end[source], 0.0, beta[to]) - beta[source]
        order = _by_source(source, logp)
        source, piece, target, logp = source[order], piece[order], target[order], logp[order]
        p = np.exp(logp)
        first = np.flatnonzero(np.r_[True, source[1:] != source[:-1]])
        count = np.diff(np.r_[first, len(source)])
        others = 1.0 - p  # exact enough but for the likeliest, whose others are added up
        beside = p.copy()
        beside[first] = 0.0
        others[first] = np.add.reduceat(beside, first)
        with np.errstate(divide="ignore"):
            others = np.log(others)
        total = np.cumsum(p)
        upto = total - np.repeat(total[first] - p[first], count)
        upto[first + count - 1] = 2.0  # the last one takes what rounding leaves
        base, ends = len(self.starts) - 1, len(self.piece)
        move = lambda x: np.where(x >= 0, x + base, x)
        tail = np.array([(c[0], -1 if c[1] == end[c[2]] else c[1]) for c in chain], np.int64).reshape(-1, 2)
        for own, value, kind in ((self.piece, np.r_[piece, tail[:, 0]], "i4"), (self.target, move(np.r_[target, tail[:, 1]]), "i4"),
                                 (self.upto, np.r_[upto, np.full(len(chain), 2.0)], "f4"), (self.logp, np.r_[logp, np.zeros(len(chain))], "f4"),
                                 (self.others, np.r_[others, np.full(len(chain), -inf)], "f4"),
                                 (self.starts, ends + np.cumsum(np.r_[count, np.ones(len(chain), np.int64)]), "i4")):
            own.frombytes(value.astype(kind).tobytes())
        self.units.update(zip(units, (base + np.cumsum(size) - size).tolist()))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _places(points: np.ndarray) -> np.ndarray:
    """Where each character starts in UTF-8, and where the last one ends."""
    size = np.ones(len(points) + 1, np.int64)
    size[0] = 0
    for most in (0x7F, 0x7FF, 0xFFFF):
        size[1:] += points > most
    return np.cumsum(size)


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _by_source(source: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """The order by ``source``, likeliest first; equal ones stay as they are."""
    if len(source) and source.max() < 1 << 20 and logp.min() > -1023:
        key = (source.astype(np.int64) << 43) + (logp * -(2.0 ** 33)).astype(np.int64)
        order = np.argsort(key)  # not stable: good if all keys differ
        if np.all(np.diff(key[order]) > 0):
            return order
    return np.lexsort((-logp, source))


class _hashes:
    """Hashes of substrings: ``h[at, n]`` is that of the ``n`` characters from ``at`` on."""

    def __init__(self, points: np.ndarray):
        power, self.inverse = powers(1 << max(12, len(points).bit_length()))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * power[:len(points)])))

    def __getitem__(self, key: tuple[np.ndarray, int]) -> np.ndarray:
        at, n = key
        return (self.sums[at + n] - self.sums[at]) * self.inverse[at]


def chunks_of(text: str | None) -> list[str]:
    """A text's runs of spaces with the word behind, spaces as the vocabulary has them."""
    return _WORDS.findall(SPACE + text.replace(" ", SPACE)) if text else []


def _numbers(texts: list[str | None] | pa.Array, own: Lattice) -> list[np.ndarray]:
    """The numbers of each text's chunks, which are learnt where they are new."""
    column = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
    odd = pc.match_substring_regex(column, _ODD)
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(column)
    which = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
    for i, text in zip(which, _strings(column.filter(odd))):
        out[i] = own.numbers(chunks_of(text))
    odd = pc.invert(odd)
    split = pc.split_pattern(column.filter(odd), " ")
    words = split.flatten().dictionary_encode()
    found = own.numbers(_strings(pc.binary_join_element_wise(SPACE, words.dictionary, "")))[words.indices.to_numpy(zero_copy_only=False)]
    ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False), dtype=np.int64).tolist()
    for i, a, b in zip(np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist(), [0, *ends], ends):
        out[i] = found[a:b]
    return out


@lru_cache(maxsize=2)
def lattice(path: str, alpha: float) -> Lattice:
    """This process's lattices; a worker keeps them from task to task."""
    return Lattice(path, alpha)


def _walk(t: dict, node: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Draw a path from each node to its unit's end: all edges, one unit after the
    other, and each unit's number of edges."""
    live, at, step = np.flatnonzero(node >= 0), node[node >= 0], 0
    own = seed[live]
    whose, edges = [], []
    while len(live):
        u = _uniform(mix(own + np.array([step], np.uint64) * _STEP))
        e = t["starts"][at]
        high = np.flatnonzero(t["upto"][e] < u)
        while len(high):
            e[high] += 1
            high = high[t["upto"][e[high]] < u[high]]
        whose.append(live)
        edges.append(e)
        to = t["target"][e]
        on = to >= 0
        live, at, own, step = live[on], to[on], own[on], step + 1
    n = np.zeros(len(node), np.int64)
    for w in whose:
        n[w] += 1
    first = np.cumsum(n) - n
    out = np.empty(int(n.sum()), np.int32)
    for step, (w, e) in enumerate(zip(whose, edges)):
        out[first[w] + step] = e
    return out, n


def _truncated(place: np.ndarray | float, top: float, e: np.ndarray | float):
    """Gumbel variables at ``place`` given that they are below ``top``."""
    return place - np.log(np.exp(place - top) + e)


class _Search:
    """One text's queue and paths."""

    def __init__(self, k: int, seed: int, t: dict, roots: np.ndarray):
        self.k, self.seed, self.t, self.roots, self.queue, self.paths, self.draws = k, seed, t, roots, [], [], 0

    def uniform(self) -> float:
        self.draws += 1
        x = self.seed + self.draws * 0x9E3779B97F4A7C15 & _ALL
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _ALL
        x = (x ^ x >> 27) * 0x94D049BB133111EB & _ALL
        return ((x ^ x >> 31) >> 11) * 2.0 ** -53 + 2.0 ** -54

    def add(self, top: float, edges: np.ndarray, units: np.ndarray, since: int) -> None:
        """A path with perturbed value ``top``; its branches from ``since`` on are new."""
        _add(self.t, [(self, top, edges, units, since)])

    def branch(self) -> tuple[float, int, int, int] | None:
        """The best branch: its value, path, place and first edge."""
        if not self.queue:
            return None
        value, path, at, barred = heapq.heappop(self.queue)
        _, edges, _, before, _ = self.paths[path]
        starts, logp = self.t["starts"], self.t["logp"]
        node = int(np.searchsorted(starts, edges[at], "right")) - 1  # of one type, or all starts are copied for it
        open_ = [e for e in range(int(starts[node]), int(starts[node + 1])) if e not in barred]
        p = [exp(float(logp[e])) for e in open_]
        u, edge = self.uniform() * sum(p), open_[-1]
        for e, w in zip(open_, p):
            u -= w
            if u < 0:
                edge = e
                break
        rest = sum(w for e, w in zip(open_, p) if e != edge)
        if len(open_) > 1 and rest > 0:
            place = float(before[at]) + log(rest)
            heapq.heappush(self.queue, (-float(_truncated(place, -value, -log(self.uniform()))), path, at, (*barred, edge)))
        return -value, path, at, edge


def _add(t: dict, new: list[tuple[_Search, float, np.ndarray, np.ndarray, int]]) -> None:
    """Add a path each to some texts' searches; all their new branches are valued at once."""
    edges = np.concatenate([x[2] for x in new])
    size, since = np.array([len(x[2]) for x in new]), np.array([x[4] for x in new])
    end = np.cumsum(size)
    logp, before = t["logp"][edges].astype(float), np.empty(len(edges))
    for (s, top, own, units, _), b, n in zip(new, end.tolist(), size.tolist()):
        mine, place = logp[b - n:b], before[b - n:b]
        np.subtract(np.cumsum(mine), mine, out=place)
        s.paths.append((top, own, units, place, float(mine.sum())))
    count = size - since
    at = np.arange(count.sum()) + np.repeat(end - np.cumsum(count), count)
    left = t["others"][edges[at]]
    some = np.flatnonzero(left > -inf)
    at, left, of = at[some], left[some], np.repeat(np.arange(len(new)), count)[some]
    bounds = np.searchsorted(of, np.arange(len(new) + 1)).tolist()
    first = end - size
    h = mix(np.array([x[0].seed for x in new], np.uint64)[of] ^ mix((at - first[of]).astype(np.uint64) * _UNIT
                                                                    + np.array([len(x[0].paths) for x in new], np.uint64)[of]))
    value = _truncated(before[at] + left, np.array([x[1] for x in new])[of], -np.log(_uniform(h)))
    for (s, _, own, _, _), a, b, start in zip(new, bounds, bounds[1:], first.tolist()):
        wanted = s.k + 1 - len(s.paths)
        if wanted < 1 or a == b:
            continue
        best = np.argpartition(-value[a:b], wanted - 1)[:wanted] if b - a > wanted else np.arange(b - a)
        for i in (a + best).tolist():
            place = int(at[i]) - start
            heapq.heappush(s.queue, (-float(value[i]), len(s.paths) - 1, place, (int(own[place]),)))


def sample_texts(texts: list[str | None], seeds: np.ndarray, own: Lattice, k: int) -> list[list[tuple]]:
    """For each text its samples: ids, log-probability, perturbed value, log of the
    inclusion probability."""
    own.tidy()
    return _samples(_numbers(texts, own), seeds, own, k)


def _samples(numbers: list[np.ndarray], seeds: np.ndarray, own: Lattice, k: int) -> list[list[tuple]]:
    """``sample_texts`` of texts whose chunks have these numbers."""
    if not numbers:
        return []
    view = lambda a, kind: np.frombuffer(a, kind) if len(a) else np.empty(0, kind)
    t = {"starts": view(own.starts, np.int32), "target": view(own.target, np.int32), "piece": view(own.piece, np.int32),
         "upto": view(own.upto, np.float32), "logp": view(own.logp, np.float32),
         "others": view(own.others, np.float32)}
    chunks, ends = np.concatenate(numbers), view(own.root_ends, np.int32)
    first = ends[chunks].astype(np.int64)
    size = ends[chunks + 1] - first
    stop = np.r_[0, np.cumsum(size)]
    roots = view(own.roots, np.int32)[np.arange(stop[-1]) + np.repeat(first - stop[:-1], size)]
    cuts = stop[np.cumsum([0, *map(len, numbers)])].tolist()
    searches = [_Search(k, seed, t, roots[a:b]) for seed, a, b in zip(seeds.tolist(), cuts, cuts[1:])]
    todo = [(s, -log(-log(s.uniform())), None, np.empty(0, np.int32), 0, s.roots) for s in searches]
    for round_ in range(1, k + 1):
        if not todo:
            break
        nodes = np.concatenate([x[5] for x in todo])
        sizes, firsts = np.array([len(x[5]) for x in todo]), np.array([x[4] for x in todo], np.int64)
        unit = np.arange(len(nodes)) + np.repeat(firsts - np.cumsum(sizes) + sizes, sizes)
        own_seed = mix(np.array([x[0].seed for x in todo], np.uint64) + np.array([round_], np.uint64))
        edges, n = _walk(t, nodes, mix(np.repeat(own_seed, sizes) + unit.astype(np.uint64) * _UNIT))
        units = np.repeat(unit, n)
        cut = np.r_[0, np.cumsum(n)][np.r_[0, np.cumsum(sizes)]].tolist()
        new = []
        for (s, top, from_, prefix, _, _), a, b in zip(todo, cut, cut[1:]):
            mine, of = edges[a:b], units[a:b]
            if from_ is not None:
                mine, of = np.concatenate((prefix, mine)), np.concatenate((from_, of))
            new.append((s, top, mine, of, len(prefix)))
        _add(t, new)
        todo = []
        if round_ < k:
            for s in searches:
                if len(s.paths) == round_ and (b := s.branch()):
                    top, path, at, edge = b
                    _, old, of, _, _ = s.paths[path]
                    unit = int(of[at])
                    rest = np.concatenate((t["target"][edge:edge + 1], s.roots[unit + 1:]))
                    todo.append((s, top, of[:at + 1], np.concatenate((old[:at], np.array([edge], np.int32))), unit, rest))
    out = []
    for s in searches:
        kappa = -s.queue[0][0] if s.queue else -inf
        rows = []
        for top, edges, _, _, logp in s.paths:
            x = logp - kappa
            rows.append((t["piece"][edges], logp, top, 0.0 if x > 5 else x if x < -20 else log(-np.expm1(-exp(x)))))
        out.append(rows)
    return out


Batches = Iterator[pa.RecordBatch]


def _sampled(k: int, seed: int, alpha: float, model: str) -> Callable[[Batches], Batches]:
    """What ``sample`` does to a task's rows."""
    def run(batches: Batches) -> Batches:
        own = lattice(model, alpha)
        for b in gathered(batches):
            keys, texts = b.column(0).to_pylist(), b.column(1).cast(pa.string())
            chars = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
            own.tidy()
            numbers = _numbers(texts, own)
            at = 0
            while at < len(keys):
                end, total = at + 1, chars[at]
                while end < len(keys) and total + chars[end] <= _CHARS:
                    total += chars[end]
                    end += 1
                of = mix(np.array([x or 0 for x in keys[at:end]], np.int64).view(np.uint64) * _GOLD + np.array([seed], np.uint64))
                rows = [(key, i, ids, *x) for key, found in zip(keys[at:end], _samples(numbers[at:end], of, own, k))
                        for i, (ids, *x) in enumerate(found, 1)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([r[0] for r in rows], pa.int64()), "sample": pa.array([r[1] for r in rows], pa.int32()),
                    "n_pieces": pa.array([len(r[2]) for r in rows], pa.int64()), "log_prob": pa.array([r[3] for r in rows], pa.float64()),
                    "perturbed": pa.array([r[4] for r in rows], pa.float64()),
                    "log_inclusion": pa.array([float(r[5]) for r in rows], pa.float64()),
                    "ids": pa.array([r[2].astype("<i4").tobytes() for r in rows], pa.binary())})
                at = end

    return run


def _spelled(rows: pa.Array, pieces: pa.Array) -> pa.Array:
    """The text that each row's ids spell: the pieces of all rows are taken at once, one after the other."""
    raw = pc.fill_null(rows.cast(pa.large_binary()), b"")
    size = pc.binary_length(raw).to_numpy(zero_copy_only=False)
    if (size % 4).any():
        raise ValueError("ids take 4 bytes each")
    ends = np.r_[0, np.cumsum(size, dtype=np.int64)]
    ids = np.empty(0, "<i4")
    if ends[-1]:
        first = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset]
        ids = np.frombuffer(raw.buffers()[2].slice(first, ends[-1]), "<i4")
    found = pieces.take(pa.array(ids))
    places = np.frombuffer(found.buffers()[1], np.int64)[ends // 4] if len(ids) else ends
    buffers = [None, pa.py_buffer(places), found.buffers()[2] or pa.py_buffer(b"")]
    bytes_ = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), buffers)
    try:
        texts = bytes_.cast(pa.large_string())
    except pa.ArrowInvalid:  # some row's bytes are no text
        texts = pa.array([x.decode("utf-8", "replace") for x in bytes_.to_pylist()], pa.large_string())
    texts = pc.utf8_slice_codeunits(pc.replace_substring(texts, SPACE, " "), 1)
    return pc.if_else(rows.is_valid(), texts, pa.scalar(None, pa.large_string())).cast(pa.string())


def _decoded(model: str, ids: str, into: str) -> Callable[[Batches], Batches]:
    """What ``decode`` does to a task's rows."""
    def run(batches: Batches) -> Batches:
        pieces = spelled(model)
        for b in batches:
            texts = _spelled(b.column(b.schema.get_field_index(ids)), pieces)
            yield pa.RecordBatch.from_arrays([*b.columns, texts], names=[*b.schema.names, into])

    return run


def sample(docs: DataFrame, k: int = K, seed: int = 7, alpha: float = 1.0, model: str | None = None,
           into: str | None = None) -> DataFrame:
    """Up to ``k`` different segmentations of each text of ``docs`` (``doc_id``,
    ``text``), the largest perturbed first: ``ids`` (little-endian, 32 bits each),
    ``log_prob``, ``perturbed``, ``log_inclusion``. With ``into`` they are decoded, as by
    ``decode``, in the same task: its worker alone holds lattices, and ids go out once."""
    model = model or model_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sampled = _sampled(k, seed, alpha, model)
    if into is None:
        return rows.mapInArrow(sampled, SAMPLES)
    decoded = _decoded(model, "ids", into)
    return rows.mapInArrow(lambda batches: decoded(sampled(batches)), f"{SAMPLES}, `{into}` string")


def decode(rows: DataFrame, model: str | None = None, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the text that their ``ids`` spell; null ids give null. A text's own
    U+2581 comes back as a space, and bytes that are no text as U+FFFD."""
    model = model or model_path()
    rows = rows.drop(into) if into != ids else rows
    return rows.mapInArrow(_decoded(model, ids, into), StructType([*rows.schema.fields, StructField(into, StringType())]))


def op4_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentations of all ``documents``, and what their ids decode to."""
    rows = sample(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), into="decoded")
    return rows.withColumns({"ids_crc32": F.crc32("ids"), "decoded_crc32": F.crc32(F.col("decoded").cast("binary"))}).drop("ids", "decoded")
