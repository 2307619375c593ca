"""SentencePiece encoding, decoding, and sampling of segmentations without replacement.

A text is cut into units that no piece crosses; a unit's encoding and its lattice of
pieces are made once per task. A segmentation of the text is a path through the lattices,
its probability the product of Zipf weights of its pieces, normalised. Each task perturbs
path probabilities with Gumbel noise seeded by the row key and searches the paths best
first: the best path of a set of paths splits it into that path and one set for every
node where another edge is taken, and the perturbed maximum of each set, conditioned on
being below the path just found, is drawn without listing its paths. The first k paths
are a sample without replacement.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from waymeter.llm.common import mix, row_chunks, texts as text_bounds

SPACE = "▁"
#: Units end where no piece can cross: before a space mark after another character, at a line feed,
_UNITS = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
#: and, if no piece of the model has both, between Latin letters and other characters.
_LATIN = "A-Za-z\u00c0-\u024f"
_SHORT_UNITS = re.compile(f"\n|{SPACE}*(?:[{_LATIN}]+|[^{_LATIN}{SPACE}\n]+)|{SPACE}+")
_MIXED = re.compile(f"[{_LATIN}][^{_LATIN}{SPACE}]|[^{_LATIN}{SPACE}][{_LATIN}]")
_CROSSED = re.compile(f"[^{SPACE}]{SPACE}|\n.|.\n", re.DOTALL)
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text that are searched together.
CALL_BYTES = 1 << 20
#: A task forgets its units beyond so many and goes on with an empty memory.
MOST_UNITS = 100_000

SAMPLE = T.StructType(
    [
        T.StructField("n_pieces", T.LongType()),
        T.StructField("log_p", T.DoubleType()),
        T.StructField("perturbed", T.DoubleType()),
        T.StructField("log_inclusion", T.DoubleType()),
        T.StructField("digest", T.StringType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ]
)
RESULT = T.StructType(
    [
        T.StructField("n_pieces", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded_equal", T.BooleanType()),
        T.StructField("samples", T.ArrayType(SAMPLE)),
    ]
)


class Lattices:
    """Encodings and piece lattices of units, in flat arrays over all of them.

    Nodes are places between characters, numbered through; the edges of a node lie together,
    the likeliest first. ``c`` is an edge's probability given its node.
    """

    def __init__(self, model: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        size = self.model.get_piece_size()
        self.text = [self.model.id_to_piece(i) for i in range(size)]
        self.byte = [self.model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        usual = [i for i in range(size) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))]
        # scores of a BPE model are minus the rank of the merge; Zipf's law gives weights
        self.log_weight = np.zeros(size)
        self.log_weight[usual] = [-math.log(2.0 - self.model.get_score(i)) for i in usual]
        if any(_CROSSED.search(self.text[i]) for i in usual):
            raise ValueError("the model has pieces over several words")
        self.pattern = _UNITS if any(_MIXED.search(self.text[i]) for i in usual) else _SHORT_UNITS
        self.space = self.model.piece_to_id(SPACE)
        self.spelled: dict[int, list[int]] = {}
        self._prefixes(usual)
        self.clear()

    def units(self, text: str) -> list[str]:
        """The text with the leading space that the model adds, cut where no piece can cross."""
        return self.pattern.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def _prefixes(self, usual: list[int]) -> None:
        """For each length the sorted hashes of all beginnings of pieces, and the piece that is one itself, or -1."""
        lengths = np.array([len(self.text[i]) for i in usual])
        chars = np.zeros((len(usual), lengths.max()), np.uint64)
        for row, i in enumerate(usual):
            chars[row, : lengths[row]] = [ord(c) for c in self.text[i]]
        hashes, numbers = np.zeros(len(usual), np.uint64), np.array(usual)
        self.known: list[tuple[np.ndarray, np.ndarray]] = []
        for length in range(1, chars.shape[1] + 1):
            hashes = hashes * _BASE + chars[:, length - 1] + np.uint64(1)
            long_enough = lengths >= length
            whole = np.where(lengths == length, numbers, -1)[long_enough]
            order = np.lexsort((-whole, hashes[long_enough]))
            found, at = np.unique(hashes[long_enough][order], return_index=True)
            self.known.append((found, whole[order][at]))

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.ends = array("i"), array("q", [0])
        self.roots, self.first = array("q"), array("q", [0])
        self.c, self.log_c, self.log_other = array("f"), array("d"), array("f")
        self.next, self.piece = array("i"), array("i")

    def view(self, name: str) -> np.ndarray:
        own = getattr(self, name)
        return np.frombuffer(own, own.typecode)

    def add(self, new: list[str]) -> None:
        self.place.update(zip(new, range(len(self.roots), len(self.roots) + len(new))))
        # the model itself puts a space first; elsewhere a line feed keeps it from doing so
        coded = self.model.encode([u[1:] if u[0] == SPACE else "\n" + u for u in new], num_threads=1)
        ids = [ids if u[0] == SPACE and len(u) > 1 else [self.space] if u[0] == SPACE else ids[2:] for u, ids in zip(new, coded)]
        self.ids.extend(chain.from_iterable(ids))
        self.ends.frombytes((self.ends[-1] + np.cumsum([len(x) for x in ids], dtype=np.int64)).tobytes())
        self._lattices(new)

    def _lattices(self, new: list[str]) -> None:
        """Find all pieces in all new units, and from the ends backwards the total weight of all ways on from a node."""
        chars = np.frombuffer("".join(new).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        lengths = np.array([len(u) for u in new])
        ends = np.repeat(np.cumsum(lengths), lengths)
        hashes, at = np.zeros(len(chars), np.uint64), np.arange(len(chars))
        froms, tos, pieces, weights = [], [], [], []
        for length, (known, whole) in enumerate(self.known, 1):
            inside = at + length <= ends[at]
            at, hashes = at[inside], hashes[inside]
            if not len(at):
                break
            hashes = hashes * _BASE + chars[at + length - 1] + np.uint64(1)
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            begun = known[place] == hashes
            found = begun & (whole[place] >= 0)
            if length == 1:
                # a character without a piece is spelled in bytes
                spelled = at[~found]
                froms.append(spelled)
                tos.append(spelled + 1)
                code = chars[spelled].astype(np.int64)
                pieces.append(-1 - code)
                n_bytes = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
                weights.append(-math.log(len(self.text)) * n_bytes)
            froms.append(at[found])
            tos.append(at[found] + length)
            pieces.append(whole[place[found]])
            weights.append(self.log_weight[pieces[-1]])
            at, hashes = at[begun], hashes[begun]
        source, target, piece, weight = (np.concatenate(x) for x in (froms, tos, pieces, weights))
        distance = ends[source] - source
        order = np.argsort(distance * len(ends) + source)
        source, target, piece, weight, distance = (x[order] for x in (source, target, piece, weight, distance))
        last = target == ends[source]
        total = np.zeros(len(chars) + 1)
        value = weight
        cuts = np.flatnonzero(np.concatenate(([True], distance[1:] != distance[:-1], [True])))
        for a, b in zip(cuts[:-1], cuts[1:]):
            value[a:b] += np.where(last[a:b], 0.0, total[target[a:b]])
            heads = np.flatnonzero(np.concatenate(([True], source[a + 1 : b] != source[a : b - 1])))
            total[source[a:b][heads]] = np.logaddexp.reduceat(value[a:b], heads)
        log_c = np.minimum(value - total[source], 0.0)
        c = np.exp(log_c)
        # by source, then the likeliest first
        order = np.argsort(source - c / 2)
        target, piece, c, log_c, last = (x[order] for x in (target, piece, c, log_c, last))
        with np.errstate(divide="ignore"):
            log_other = np.log(-np.expm1(log_c))
        base, edges = len(self.first) - 1, len(self.c)
        self.first.frombytes((edges + np.cumsum(np.bincount(source, minlength=len(chars)))).astype(np.int64).tobytes())
        self.roots.frombytes((base + np.cumsum(lengths) - lengths).astype(np.int64).tobytes())
        onward = np.where(last, -1, base + target)
        for own, x in ((self.next, onward), (self.piece, piece), (self.c, c), (self.log_c, log_c), (self.log_other, log_other)):
            own.frombytes(x.astype(own.typecode).tobytes())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Places of the units of each text."""
        parts = [self.units(t) for t in texts]
        place = self.place
        every = set().union(*parts)
        new = [u for u in every if u not in place]
        if new and len(self.roots) + len(new) > MOST_UNITS and self.roots:
            self.clear()
            place, new = self.place, list(every)
        if new:
            self.add(new)
        return [np.fromiter(map(place.__getitem__, p), np.int64, len(p)) for p in parts]

    def count(self, at: np.ndarray) -> int:
        """Ids of the units at these places."""
        return len(self.text_ids(at))

    def text_ids(self, at: np.ndarray) -> np.ndarray:
        """Ids of a text with units at these places."""
        ends = self.view("ends")
        starts, sizes = ends[at], ends[at + 1] - ends[at]
        return self.view("ids")[np.repeat(starts, sizes) + _within(sizes)]

    def decodes(self, text: str, at: np.ndarray) -> bool:
        """Whether the model decodes the ids of the units at these places to ``text``."""
        return self.model.decode(self.text_ids(at)) == text

    def piece_ids(self, pieces: np.ndarray) -> np.ndarray:
        """Ids of pieces, those of its bytes for a character without a piece."""
        ids = pieces.astype(np.int32)
        bare = np.flatnonzero(ids < 0)
        if not len(bare):
            return ids
        spelled = [self._spelled(c) for c in ids[bare].tolist()]
        counts = np.ones(len(ids), np.int64)
        counts[bare] = [len(x) for x in spelled]
        out = np.repeat(ids, counts)
        out[np.repeat(ids < 0, counts)] = [b for x in spelled for b in x]
        return out

    def _spelled(self, piece: int) -> list[int]:
        if piece not in self.spelled:
            self.spelled[piece] = [self.byte[b] for b in chr(-1 - piece).encode("utf-8", "surrogatepass")]
        return self.spelled[piece]


def uniform(state: np.ndarray, purpose: int, number: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1) that depend on a row's state and on what they are for, not on the layout of the data."""
    raw = mix(state + np.uint64(purpose * 0xD6E8FEB86659FD93 & (2**64 - 1)) + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return ((raw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... in each of consecutive groups."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def walk(lattices: Lattices, starts: np.ndarray, state: np.ndarray, number: np.ndarray, purpose: int) -> tuple[np.ndarray, np.ndarray]:
    """A random path from each start node to the end of its unit: edges in order, and the start each belongs to."""
    first, c, following = lattices.view("first"), lattices.view("c"), lattices.view("next")
    own = mix(state + np.uint64(purpose) + (number.astype(np.uint64) << np.uint64(20)))
    taken, owner, nodes, who, step = [], [], starts, np.arange(len(starts)), 0
    while len(nodes):
        edges, ends = first[nodes], first[nodes + 1] - 1
        rest = uniform(own[who], 1, np.full(len(who), step)) - c[edges]
        # most draws end at the first edge, which is the likeliest
        open_ = np.flatnonzero((rest >= 0) & (edges < ends))
        while len(open_):
            edges[open_] += 1
            rest[open_] -= c[edges[open_]]
            open_ = open_[(rest[open_] >= 0) & (edges[open_] < ends[open_])]
        taken.append(edges)
        owner.append(who)
        nodes, step = following[edges], step + 1
        on = nodes >= 0
        nodes, who = nodes[on], who[on]
    if not taken:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(taken)[order], owner[order]


class Family:
    """A path of one row, and for each of its places the paths that leave it there by an edge not yet used.

    ``value`` has the perturbed maximum of each of those sets.
    """

    __slots__ = ("edges", "before", "value", "closed", "place", "log_p")

    def __init__(self, edges: np.ndarray, before: np.ndarray, value: np.ndarray, log_p: float, closed: set[int], place: int):
        self.edges, self.before, self.value, self.log_p, self.closed, self.place = edges, before, value, log_p, closed, place


def families(lattices: Lattices, paths: list[np.ndarray], begins: list[int], heads: list[float], bounds: list[float], closed: list[set[int]], state: np.ndarray, purpose: int) -> list[Family]:
    """One family for each path; the sets before place ``begin`` belong to other families, the one at it has probability ``head``."""
    counts = np.array([len(p) for p in paths])
    edges = np.concatenate(paths)
    log_c = lattices.view("log_c")[edges]
    stop = np.cumsum(counts)
    before = np.cumsum(log_c) - log_c
    before -= np.repeat(before[stop - counts], counts)
    mass = before + lattices.view("log_other")[edges]
    inner, begin = _within(counts), np.array(begins)
    mass[inner < np.repeat(begin, counts)] = -np.inf
    at = np.flatnonzero([bool(x) for x in closed])
    mass[(stop - counts + begin)[at]] = np.array(heads)[at]
    noise = -np.log(uniform(np.repeat(state, counts), purpose, inner))
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        # a Gumbel variable of this mass, given that it is below the bound
        value = -np.logaddexp(np.repeat(-np.array(bounds), counts), np.log(noise) - mass)
    value[mass == -np.inf] = -np.inf
    return [
        Family(edges[a:b], before[a:b], value[a:b], float(before[b - 1] + log_c[b - 1]), done, start)
        for a, b, done, start in zip(stop - counts, stop, closed, begins)
    ]


def sample(lattices: Lattices, ats: list[np.ndarray], keys: list[int], k: int) -> list[tuple[list[tuple[np.ndarray, float, float]], float]]:
    """For each row up to ``k`` distinct paths (pieces, log probability, perturbed value) in order, and the value of the next one."""
    rows = [i for i, at in enumerate(ats) if len(at)]
    results: list[tuple[list[tuple[np.ndarray, float, float]], float]] = [([], -math.inf) for _ in ats]
    if not rows:
        return results
    state = mix(np.array([keys[i] & (2**64 - 1) for i in rows], np.uint64))
    first, log_c = lattices.view("first"), lattices.view("log_c")
    following, piece = lattices.view("next"), lattices.view("piece")
    every = lattices.view("roots")[np.concatenate([ats[i] for i in rows])]
    roots = np.split(every, np.cumsum([len(ats[i]) for i in rows])[:-1])
    top = (-np.log(-np.log(uniform(state, 2, np.zeros(len(rows)))))).tolist()

    def walked(starts: list[np.ndarray], own: np.ndarray, skipped: list[int], purpose: int) -> list[np.ndarray]:
        counts = np.array([len(x) for x in starts])
        number = _within(counts) + np.repeat(np.array(skipped), counts)
        edges, owner = walk(lattices, np.concatenate(starts), np.repeat(own, counts), number, purpose)
        return np.split(edges, np.searchsorted(owner, np.cumsum(counts)[:-1]))

    begun = families(lattices, walked(roots, state, [0] * len(rows), 3), [0] * len(rows), [0.0] * len(rows), top, [set() for _ in rows], state, 4)
    found = [[f] for f in begun]
    queues: list[list[tuple[float, int]]] = [[] for _ in rows]

    def push(row: int, number: int) -> None:
        best = float(found[row][number].value.max())
        if best > -math.inf:
            heapq.heappush(queues[row], (-best, number))

    for row, i in enumerate(rows):
        push(row, 0)
        results[i][0].append((piece[begun[row].edges], begun[row].log_p, top[row]))
    for turn in range(1, k):
        active, heads_of, starts, skipped, begins, rests, bounds, closed = [], [], [], [], [], [], [], []
        draw = uniform(state, 5 + 4 * turn, np.zeros(len(rows)))
        for row in range(len(rows)):
            if not queues[row]:
                continue
            value, number = heapq.heappop(queues[row])
            family = found[row][number]
            place = int(family.value.argmax())
            edge = int(family.edges[place])
            node = int(np.searchsorted(first, edge, "right")) - 1
            used = {edge} | (family.closed if place == family.place else set())
            free = [e for e in range(first[node], first[node + 1]) if e not in used]
            upto = np.cumsum(np.exp(log_c[free]))
            chosen = free[min(int(np.searchsorted(upto, draw[row] * upto[-1], "right")), len(free) - 1)]
            # the rest of the unit, then the units after it
            ends = int(np.count_nonzero(following[family.edges[:place]] < 0))
            tail = roots[row][ends + 1 :]
            starts.append(tail if following[chosen] < 0 else np.concatenate(([following[chosen]], tail)))
            skipped.append(ends)
            active.append(row)
            heads_of.append(np.append(family.edges[:place], chosen))
            # what is left at this place goes with the new path
            left = [e for e in free if e != chosen]
            rests.append(float(family.before[place] + np.log(np.exp(log_c[left]).sum())) if left else -math.inf)
            used.add(int(chosen))
            closed.append(used)
            begins.append(place)
            bounds.append(-value)
            family.value[place] = -math.inf
            push(row, number)
        if not active:
            break
        own = state[active]
        paths = [np.concatenate(x) for x in zip(heads_of, walked(starts, own, skipped, 3 + 4 * turn))]
        for row, family, value in zip(active, families(lattices, paths, begins, rests, bounds, closed, own, 4 + 4 * turn), bounds):
            found[row].append(family)
            push(row, len(found[row]) - 1)
            results[rows[row]][0].append((piece[family.edges], family.log_p, value))
    return [(out, after) for (out, _), after in zip(results, _next_values(ats, queues))]


def _next_values(ats: list[np.ndarray], queues: list[list[tuple[float, int]]]) -> list[float]:
    left = iter(queues)
    return [(-q[0][0] if (q := next(left)) else -math.inf) if len(at) else -math.inf for at in ats]


def log_inclusion(log_p: float, threshold: float) -> float:
    """Log of the probability that a path's perturbed value exceeds the threshold: log(1 - exp(-exp(log_p - threshold)))."""
    gap = log_p - threshold
    if gap == math.inf or gap > 3.6:
        return 0.0
    return gap if gap < -37 else math.log(-math.expm1(-math.exp(gap)))


def _lists(values: np.ndarray, counts: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), values)


def encoder(model: str, k: int, with_ids: bool):
    no_ids = lambda rows: pa.nulls(rows, pa.list_(pa.int32()))

    def samples_of(lattices: Lattices, found: list[tuple[list[tuple[np.ndarray, float, float]], float]]) -> pa.Array:
        chosen = [lattices.piece_ids(pieces) for paths, _ in found for pieces, _, _ in paths]
        counts = [len(x) for x in chosen]
        values = {
            "n_pieces": pa.array(counts, pa.int64()),
            "log_p": pa.array([log_p for paths, _ in found for _, log_p, _ in paths], pa.float64()),
            "perturbed": pa.array([value for paths, _ in found for _, _, value in paths], pa.float64()),
            "log_inclusion": pa.array([log_inclusion(log_p, after) for paths, after in found for _, log_p, _ in paths], pa.float64()),
            "digest": pa.array([hashlib.blake2b(x.tobytes(), digest_size=8).hexdigest() for x in chosen], pa.string()),
            "ids": _lists(np.concatenate([np.empty(0, np.int32), *chosen]), counts) if with_ids else no_ids(len(chosen)),
        }
        return _lists(pa.StructArray.from_arrays(list(values.values()), list(values)), [len(paths) for paths, _ in found])

    @F.arrow_udf(RESULT)
    def encode(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        lattices = Lattices(model)
        for texts, keys in batches:
            # ids of one call are kept at a time
            for low, high in row_chunks(text_bounds(texts)[1], CALL_BYTES):
                own = [t or "" for t in texts.slice(low, high - low).to_pylist()]
                ats = lattices.encode(own)
                coded = [lattices.text_ids(at) for at in ats]
                counts = [len(ids) for ids in coded]
                values = {
                    "n_pieces": pa.array(counts, pa.int64()),
                    "ids": _lists(np.concatenate(coded), counts) if with_ids else no_ids(len(coded)),
                    "decoded_equal": pa.array([lattices.model.decode(ids) == text for ids, text in zip(coded, own)], pa.bool_()),
                    "samples": samples_of(lattices, sample(lattices, ats, keys.slice(low, high - low).to_pylist(), k)),
                }
                yield pa.StructArray.from_arrays(list(values.values()), list(values))

    return encode


def encode_documents(
    docs: DataFrame, model: str, text: str = "text", key: Column | str = "doc_id", k: int = 2, seed: int = 0, with_ids: bool = True
) -> DataFrame:
    """``docs`` with ``n_pieces``, ``ids``, ``decoded_equal`` and ``samples``, the last by falling perturbed value.

    ``decoded_equal`` tells whether the model decodes the ids to the text again; it is false only where
    a text holds the model's own space mark. A sample has ``n_pieces``, ``log_p`` (log probability), ``perturbed``,
    ``log_inclusion`` (log probability of being among the k, given the value of the next
    one; 0 where there is none), ``digest`` and ``ids``. A text with fewer than k segmentations
    gives all of them; a null or empty one gives none, no ids, and decodes equal. Rows with
    an equal key and text get equal samples. ``with_ids=False`` leaves all ids null.
    Columns of ``docs`` with the name of a result column are replaced. A model with pieces over several words
    raises a ValueError, because texts are cut between words.
    """
    row_key = F.xxhash64(F.col(f"`{key}`") if isinstance(key, str) else key, F.lit(seed))
    made = "_pieces"
    while made in docs.columns:
        made += "_"
    rows = docs.withColumn(made, encoder(model, k, with_ids)(F.col(f"`{text}`"), row_key))
    return rows.withColumns({f.name: F.col(f"{made}.{f.name}") for f in RESULT.fields}).drop(made)
