"""A byte-level lattice over the pieces of a SentencePiece vocabulary, computed for many strings at once.

Spaces are the byte 0xFF, which valid UTF-8 never holds, so a literal U+2581 in a text stays distinct
from a space and decoding is the plain concatenation of pieces. Bytes without a piece of their own use
the vocabulary's byte pieces; so every string has a segmentation. No piece has a space after its first
other byte, hence the lattice of a text is the chain of the lattices of its chunks (a run of spaces and
what follows it, or a newline), and equal chunks are worked out once.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cached_property

import numpy as np

SPACE = 0xFF
_ODD = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
_TO_LATTICE = bytes(SPACE if b == 0x20 else b for b in range(256))
_FROM_LATTICE = bytes(0x20 if b == SPACE else b for b in range(256))


@dataclass(frozen=True)
class Vocabulary:
    """Piece bytes by id (None where an id stands for no text) and the log-probability of each."""

    pieces: tuple
    logp: np.ndarray

    @cached_property
    def digest(self) -> bytes:
        """SHA-256 of all pieces and scores."""
        h = hashlib.sha256(np.ascontiguousarray(self.logp).tobytes())
        for p in self.pieces:
            h.update(b"-" if p is None else len(p).to_bytes(4, "little") + p)
        return h.digest()


def load_vocabulary(path: str) -> Vocabulary:
    """Pieces of a SentencePiece model file. Scores that are merge ranks become Zipf log-probabilities."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces: list = [None] * n
    score = np.array([sp.get_score(i) for i in range(n)])
    taken = set()
    for i in range(n):
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            b = b"".join(bytes([SPACE]) if c == "▁" else c.encode() for c in sp.id_to_piece(i))
            if bytes([SPACE]) not in b.lstrip(bytes([SPACE])) and b not in taken:
                pieces[i] = b
                taken.add(b)
    for i in range(n):
        if sp.is_byte(i) and (b := bytes([int(sp.id_to_piece(i)[3:5], 16)])) not in taken:
            pieces[i] = b
            taken.add(b)
    known = np.array([p is not None for p in pieces])
    merged = known & np.array([not sp.is_byte(i) for i in range(n)])
    if score[merged].min() < -1000:  # ranks, not log-probabilities
        rank = np.where(merged, -score, n)
        score = -np.log(rank + 10.0)
    else:
        score = np.where(merged, score, score[merged].min() - 5)
    score = np.where(known, score, -np.inf)
    return Vocabulary(tuple(pieces), score - np.logaddexp.reduce(score[known]))


class Table:
    """Hash table from every prefix of a piece to the piece's id, or -1 where the prefix is no piece."""

    def __init__(self, vocabulary: Vocabulary):
        self.pieces, self.logp = vocabulary.pieces, vocabulary.logp
        self.of_bytes = {p: i for i, p in enumerate(self.pieces) if p is not None}
        self.longest = max(map(len, self.of_bytes))
        prefixes = {p[:k]: -1 for p in self.of_bytes for k in range(1, len(p) + 1)} | self.of_bytes
        self.bits = max(12, int(np.ceil(np.log2(len(prefixes) * 4))))
        size = 1 << self.bits
        self.keys, self.ids, self.used = np.zeros(size, np.uint64), np.full(size, -1, np.int32), np.zeros(size, bool)
        self.probes = 1
        for prefix, i in prefixes.items():
            key = self._key(prefix)
            slot, k = key >> (64 - self.bits), 1
            while self.used[slot]:
                slot, k = (slot + 1) % size, k + 1
            self.keys[slot], self.ids[slot], self.used[slot] = key, i, True
            self.probes = max(self.probes, k)

    @staticmethod
    def _key(b: bytes) -> int:
        h, power = 0, 1
        for c in b:
            h = (h + (c + 1) * power) % (1 << 64)
            power = power * int(_ODD) % (1 << 64)
        return h * int(_MIX) % (1 << 64)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(is a prefix, piece id or -1) of each key."""
        slot = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        found = (self.keys[slot] == keys) & self.used[slot]
        ids = np.where(found, self.ids[slot], -1)
        left = np.flatnonzero(~found & self.used[slot])
        for k in range(1, self.probes):
            if not len(left):
                break
            s = (slot[left] + k) & ((1 << self.bits) - 1)
            hit = (self.keys[s] == keys[left]) & self.used[s]
            found[left[hit]] = True
            ids[left[hit]] = self.ids[s[hit]]
            left = left[~hit & self.used[s]]
        return found, ids


class Lattice:
    """All segmentations of n strings: `data` is their bytes, string c being data[starts[c]:starts[c + 1]].

    Nodes are numbered by position first, so that all strings advance together; the edges into a node are
    consecutive, shorter pieces first. alpha is the log-space forward sum.
    """

    def __init__(self, table: Table, data: np.ndarray, starts: np.ndarray, logp: np.ndarray | None = None):
        logp = table.logp if logp is None else logp
        lengths = np.diff(starts)
        self.n, total = len(lengths), len(data)
        self.rank = np.empty(self.n, np.int64)
        order = np.argsort(-lengths, kind="stable")
        self.rank[order] = np.arange(self.n)
        self.lengths = lengths
        longest = int(lengths.max(initial=0))
        # strings with at least t bytes, for t = 0..longest; node(c, t) = level[t] + rank[c]
        tall = np.cumsum(np.bincount(lengths, minlength=longest + 1)[::-1])[::-1]
        self.level = np.r_[0, np.cumsum(tall)]
        nodes = int(self.level[-1])
        string = np.repeat(np.arange(self.n), lengths)
        local = np.arange(total) - np.repeat(starts[:-1] - 0, lengths) if total else np.zeros(0, np.int64)
        powers = np.ones(total + 1, np.uint64)
        inverse = np.ones(total + 1, np.uint64)
        np.multiply.accumulate(np.r_[np.uint64(1), np.full(total, _ODD)], out=powers)
        np.multiply.accumulate(np.r_[np.uint64(1), np.full(total, _INVERSE)], out=inverse)
        sums = np.zeros(total + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
        room = lengths[string] - local
        at = np.arange(total)
        counts = np.zeros(nodes, np.int32)
        found = []
        for k in range(1, table.longest + 1):
            at = at[room[at] >= k]
            if not len(at):
                break
            prefix, ids = table.look_up((sums[at + k] - sums[at]) * inverse[at] * _MIX)
            hit = ids >= 0
            src = at[hit]
            c, t = string[src], local[src]
            a, b = self.level[t] + self.rank[c], self.level[t + k] + self.rank[c]
            counts[b] += 1
            found.append((a, b, ids[hit]))
            at = at[prefix]
        first = np.r_[0, np.cumsum(counts, dtype=np.int64)]
        self.first = first
        put = first[:-1].copy()
        edges = int(first[-1])
        self.source, self.piece = np.empty(edges, np.int64), np.empty(edges, np.int32)
        for a, b, ids in found:
            slot = put[b]
            self.source[slot], self.piece[slot] = a, ids
            put[b] += 1
        self.weight = logp[self.piece]
        self.alpha = np.full(nodes, -np.inf)
        self.alpha[: self.n] = 0.0
        for t in range(1, longest + 1):
            a, b = self.level[t], self.level[t + 1]
            e, f = first[a], first[b]
            self.weight[e:f] += self.alpha[self.source[e:f]]
            self.alpha[a:b] = np.logaddexp.reduceat(self.weight[e:f], first[a:b] - e)
        # from here on the log-probability of coming into a node by an edge
        self.weight -= np.repeat(self.alpha, counts)

    def ends(self) -> np.ndarray:
        return self.level[self.lengths] + self.rank

    def log_marginal(self) -> np.ndarray:
        """Natural log of the sum over all segmentations, by string."""
        return self.alpha[self.ends()]

    def expected(self, times: np.ndarray, size: int) -> np.ndarray:
        """Expected uses of each piece when string c occurs times[c] times."""
        mass = np.zeros(len(self.alpha))
        np.add.at(mass, self.ends(), times)
        share = np.exp(self.weight)
        out = np.zeros(size)
        for t in range(len(self.level) - 2, 0, -1):
            a, b = self.level[t], self.level[t + 1]
            e, f = self.first[a], self.first[b]
            got = share[e:f] * np.repeat(mass[a:b], np.diff(self.first[a : b + 1]))
            np.add.at(mass, self.source[e:f], got)
            out += np.bincount(self.piece[e:f], got, size)
        return out

    def thresholds(self) -> np.ndarray:
        """For each edge the probability of it and those before it into the same node, of 2**31, summed node by node."""
        total = np.exp(self.weight)
        nth = np.arange(len(total)) - np.repeat(self.first[:-1], np.diff(self.first))
        at, k = np.flatnonzero(nth), 1
        while len(at):
            here = at[nth[at] == k]
            total[here] += total[here - 1]
            at, k = at[nth[at] > k], k + 1
        out = np.rint(total * (1 << 31)).astype(np.uint32)
        out[self.first[1:][np.diff(self.first) > 0] - 1] = 1 << 31
        return out


class Draws:
    """Compact lattices of many strings, and draws of segmentations from them. More strings can be added."""

    def __init__(self):
        self.words = None
        self.end, self.first, self.local = np.zeros(0, np.int32), np.zeros(1, np.int32), np.zeros(0, np.int32)
        self.source, self.piece, self.within = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def add(self, words, lattice: Lattice) -> None:
        """`words`: the strings of the lattice, as an Arrow array."""
        import pyarrow as pa

        nodes, edges = len(self.local), len(self.source)
        self.words = words if self.words is None else pa.concat_arrays([self.words, words])
        joined = lambda old, new: np.concatenate([old, new.astype(old.dtype)])
        self.end = joined(self.end, lattice.ends() + nodes)
        self.first = joined(self.first, lattice.first[1:] + edges)
        self.local = joined(self.local, np.repeat(np.arange(len(lattice.level) - 1), np.diff(lattice.level)))
        self.source = joined(self.source, lattice.source + nodes)
        self.piece = joined(self.piece, lattice.piece)
        self.within = joined(self.within, lattice.thresholds())

    def draw(self, which: np.ndarray, place: np.ndarray, key: np.ndarray, out: np.ndarray) -> None:
        """Puts a drawn piece (its id plus one) where it begins: string which[i] begins at out[place[i]]; key[i] seeds it."""
        node = self.end[which]
        while len(node):
            with np.errstate(over="ignore"):
                u = (splitmix(key + self.local[node].astype(np.uint64) * STEP) >> np.uint64(33)).astype(np.uint32)
            edge = self.first[node]
            left = np.flatnonzero(self.within[edge] <= u)
            while len(left):
                edge[left] += 1
                left = left[self.within[edge[left]] <= u[left]]
            node = self.source[edge]
            at = self.local[node]
            out[place + at] = self.piece[edge] + 1
            more = np.flatnonzero(at)
            node, place, key = node[more], place[more], key[more]


#: What a position adds to a row's key.
STEP = np.uint64(0xA24BAED4963EE407)


def splitmix(x: np.ndarray) -> np.ndarray:
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def to_lattice(text: bytes) -> bytes:
    """Lattice bytes of UTF-8 text: spaces marked, with one in front."""
    return bytes([SPACE]) + text.translate(_TO_LATTICE)


def from_pieces(ids, pieces) -> bytes:
    return b"".join([pieces[i] for i in ids]).translate(_FROM_LATTICE)[1:]


def chunks(data: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Where chunks start in the concatenated lattice bytes of several documents."""
    space, newline = data == SPACE, data == 0x0A
    begin = space.copy()
    begin[1:] &= ~space[:-1]
    begin |= newline
    begin[1:] |= newline[:-1]
    begin[doc_starts[doc_starts < len(data)]] = True
    return np.flatnonzero(begin)


def distinct(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into the distinct strings, their bytes, their starts) of data cut at starts (with the end last)."""
    which, words = encoded(data, starts)
    return which, *bytes_of(words)


def encoded(data: np.ndarray, starts: np.ndarray):
    """(index into the distinct strings, the distinct strings as an Arrow array)."""
    import pyarrow as pa

    array = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
    code = array.dictionary_encode()
    return code.indices.to_numpy(), code.dictionary


def bytes_of(words) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, starts) of an Arrow binary array."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    body = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return body, offsets - offsets[0]
