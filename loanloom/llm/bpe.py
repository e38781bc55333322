"""Byte-level BPE: pre-tokenisation by array scans, cached pair merging, and decoding.

No regex runs.  Characters become classes (letter, number, blank, other, with one or two
characters of look-ahead folded in), and a transition function per class says how the
state of the splitter moves on.  Transition functions compose associatively, so a text is
cut into columns whose functions are composed side by side, a short scan over the columns
gives each one its start state, and a second sweep marks the boundaries.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.llm.text import Texts, binaries, ragged, steps, table

# The blanks of Unicode (property White_Space).
BLANKS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
          0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

LETTER, NUMBER, OTHER, MARK1, MARK2, INNER, SPACE, LONE = range(8)
IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_BLANKS, ONE_LEFT, TWO_LEFT, DONE = range(8)
CLASSES = 8

#: Rank of pairs that never join.
NEVER = np.iinfo(np.int32).max


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """``move[class, state]`` and ``cut[class, state]``: next state, and does a piece begin here.

    MARK1 and MARK2 are apostrophes followed by the one or two letters of a contraction,
    INNER a blank before another blank or the end, SPACE a space and LONE another blank
    before something else.  Classes from ``CLASSES`` on are the same at a text's first
    character, where the state before counts as DONE.
    """
    move = np.zeros((2 * CLASSES, 8), dtype=np.uint8)
    cut = np.ones((2 * CLASSES, 8), dtype=bool)
    for kind, state in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        move[kind] = state
        cut[kind, [state, AFTER_SPACE]] = False
    for left in (ONE_LEFT, TWO_LEFT):
        cut[LETTER, left] = False
    move[LETTER, ONE_LEFT], move[LETTER, TWO_LEFT] = DONE, ONE_LEFT
    for kind, state in ((MARK1, ONE_LEFT), (MARK2, TWO_LEFT)):
        move[kind] = state
        move[kind, [IN_OTHERS, AFTER_SPACE]] = IN_OTHERS
        cut[kind, [IN_OTHERS, AFTER_SPACE]] = False
    move[INNER], move[SPACE], move[LONE] = IN_BLANKS, AFTER_SPACE, DONE
    cut[INNER, IN_BLANKS] = False
    move[CLASSES:] = move[:CLASSES, [DONE]]
    return move, cut


MOVE, CUT = _transitions()


@functools.cache
def character_classes() -> np.ndarray:
    """Class of each code point; blanks are INNER, apostrophes OTHER until looked at."""
    kinds = np.full(0x110000, OTHER, dtype=np.uint8)
    for i in range(0x110000):
        first = unicodedata.category(chr(i))[0]
        if first == "L":
            kinds[i] = LETTER
        elif first == "N":
            kinds[i] = NUMBER
    kinds[BLANKS] = INNER
    return kinds


def _classes(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Classes with look-ahead; ``first`` marks the first character of each text."""
    n = len(points)
    kinds = character_classes()[points]
    last = np.ones(n, dtype=bool)
    last[:-1] = first[1:]
    blank = kinds == INNER
    before_other = np.zeros(n, dtype=bool)
    before_other[:-1] = blank[:-1] & ~blank[1:] & ~last[:-1]
    kinds[before_other] = np.where(points[before_other] == 0x20, SPACE, LONE)
    marks = np.flatnonzero((points == 0x27) & ~last)
    follow = points[marks + 1]
    one = np.isin(follow, [ord(c) for c in "stmd"])
    kinds[marks[one]] = MARK1
    rest = marks[~one]
    rest = rest[(rest + 2 < n)]
    rest = rest[~last[rest + 1]]
    a, b = points[rest + 1], points[rest + 2]
    two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    kinds[rest[two]] = MARK2
    kinds[first] += CLASSES
    return kinds


def scan(kinds: np.ndarray, width: int = 512) -> np.ndarray:
    """Does a piece begin at each character: composed transition functions, then one sweep."""
    n = len(kinds)
    columns = -(-n // width)
    grid = np.full(columns * width, CLASSES + INNER, dtype=np.uint8)
    grid[:n] = kinds
    grid = np.ascontiguousarray(grid.reshape(columns, width).T)
    flat = MOVE.ravel()
    # the function of a column: where each of the eight states ends up
    ends = np.tile(np.arange(8, dtype=np.uint8), (columns, 1))
    for row in grid:
        ends = flat[(row.astype(np.uint16) << 3)[:, None] + ends]
    # an exclusive scan of compositions: after doubling, ends[i] is the function of columns 0..i
    shift = 1
    while shift < columns:
        ends[shift:] = np.take_along_axis(ends[shift:], ends[:-shift].astype(np.intp), axis=1)
        shift *= 2
    state = np.full(columns, DONE, dtype=np.uint8)
    state[1:] = ends[:-1, DONE]
    cuts = np.empty((width, columns), dtype=bool)
    flat_cut = CUT.ravel()
    for i, row in enumerate(grid):
        at = (row.astype(np.uint16) << 3) + state
        cuts[i] = flat_cut[at]
        state = flat[at]
    return cuts.T.reshape(-1)[:n]


def pieces(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where pieces begin, and for each text the number of its first piece."""
    data = texts.data
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    first = np.zeros(len(points) + 1, dtype=bool)
    first[np.searchsorted(lead, texts.offsets)] = True
    begins = lead[scan(_classes(points, first[:-1]))] if len(points) else np.zeros(0, np.int64)
    return begins, np.searchsorted(begins, texts.offsets)


class Tokens:
    """Ids of some texts end to end; ``offsets`` by text.

    ``pieces`` has the place of each piece's first id, ``begins`` of its first byte, ``firsts``
    the number of each text's first piece.
    """

    def __init__(self, ids: np.ndarray, pieces: np.ndarray, begins: np.ndarray, firsts: np.ndarray):
        self.ids, self.pieces, self.begins, self.firsts = ids, pieces, begins, firsts
        self.offsets = pieces[firsts]

    def of(self, i: int) -> np.ndarray:
        return self.ids[self.offsets[i]:self.offsets[i + 1]]


class Memory(dict):
    """Pieces seen so far, numbered; asking for a new one numbers it and notes it in ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []
        self.ids, self.starts, self.counts = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def __missing__(self, piece: bytes) -> int:
        self.fresh.append(piece)
        self[piece] = number = len(self)
        return number

    def learn(self, ids: np.ndarray, counts: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids])
        self.fresh = []


class Coder:
    """Encode and decode with the ranks of ``token bytes -> id``.

    ``cache`` bounds the remembered pieces, not what can be encoded: a full memory starts anew.
    """

    WIDTH = 32  # bytes of pieces that merge side by side in a matrix

    def __init__(self, ranks: dict[bytes, int], cache: int = 600_000):
        self.ranks, self.limit = ranks, cache
        self.known = Memory()
        top = max(ranks.values()) + 1
        names = [b""] * top
        for token, i in ranks.items():
            names[i] = token
        self.names = names
        self.lengths = np.array([len(x) for x in names], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(names), np.uint8)
        pairs = sorted(
            ((ranks[t[:i]] << 32) + ranks[t[i:]], r) for t, r in ranks.items()
            for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.pair_keys = np.array([k for k, _ in pairs], dtype=np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], dtype=np.int32)
        self.single = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each joined pair, or NEVER; ids below 0 join with nothing."""
        keys = (left.astype(np.int64) << 32) + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = (self.pair_keys[at] == keys) & (right >= 0) & (left >= 0)
        return np.where(hit, self.pair_ranks[at], NEVER).astype(np.int32)

    def merge_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces end to end and their counts.

        Short pieces of like length lie in a matrix; in each round every one of them joins
        its neighbouring pair of lowest rank, the leftmost of equal ones.
        """
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        long = {i: self.merge(pieces[i]) for i in np.flatnonzero(lengths > self.WIDTH).tolist()}
        done = np.full((len(pieces), self.WIDTH), -1, dtype=np.int32)
        order = np.argsort(lengths, kind="stable")
        order = order[:len(order) - len(long)]
        for at in range(0, len(order), 4096):
            rows = order[at:at + 4096]
            width = int(lengths[rows[-1]])
            raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows.tolist()), np.uint8)
            ids = np.where(np.arange(width) < lengths[rows][:, None],
                           self.single[raw.reshape(-1, width)], -1)
            rank = self._ranks_of(ids[:, :-1], ids[:, 1:])
            while rank.shape[1]:
                best = rank.argmin(axis=1)
                low = rank[np.arange(len(rows)), best]
                live = low < NEVER
                done[rows[~live], :ids.shape[1]] = ids[~live]
                rows, ids, rank, best, low = rows[live], ids[live], rank[live], best[live], low[live]
                here, places = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
                move = places + (places > best[:, None])
                ids = np.take_along_axis(ids, move, axis=1)
                ids[here, best] = low
                rank = np.take_along_axis(rank, move[:, :-1], axis=1)
                right = best < rank.shape[1]
                rank[here[right], best[right]] = self._ranks_of(
                    low[right], ids[here[right], best[right] + 1])
                left = best > 0
                rank[here[left], best[left] - 1] = self._ranks_of(
                    ids[here[left], best[left] - 1], low[left])
            done[rows, :ids.shape[1]] = ids
        counts = (done >= 0).sum(axis=1)
        if not long:
            return done[done >= 0], counts
        parts = [done[i][:counts[i]] if i not in long else long[i] for i in range(len(pieces))]
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def merge(self, piece: bytes) -> list[int]:
        """The same for one piece of any length: a heap of pairs over a linked list, n log n steps."""
        ranks, n = self.ranks, len(piece)
        stop = list(range(1, n + 1))      # part i is piece[i:stop[i]], 0 once it has been joined
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1)
                if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i]
            if not stop[i] or j >= n or stop[j] != end:
                continue  # one of the two has changed since
            stop[i], stop[j], after[i] = end, 0, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get(piece[i:stop[after[i]]])) is not None:
                    heapq.heappush(heap, (r, i, stop[after[i]]))
            if before[i] >= 0 and (r := ranks.get(piece[before[i]:end])) is not None:
                heapq.heappush(heap, (r, before[i], end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:stop[i]]])
            i = after[i]
        return out

    def encode(self, texts: Texts) -> Tokens:
        begins, firsts = pieces(texts)
        raw = texts.data.tobytes()
        edges = begins.tolist()
        edges.append(len(raw))
        if len(self.known) > self.limit:
            self.known = Memory()
        known = self.known
        number = np.fromiter(map(known.__getitem__, map(raw.__getitem__, map(slice, edges, edges[1:]))),
                             np.int64, len(begins))
        if known.fresh:
            known.learn(*self.merge_all(known.fresh))
        counts = known.counts[number]
        ends = np.zeros(len(counts) + 1, dtype=np.int64)
        np.cumsum(counts, out=ends[1:])
        return Tokens(known.ids[ragged(known.starts[number], counts)], ends, begins, firsts)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of ids, end to end."""
        return self.letters[ragged(self.starts[ids], self.lengths[ids])]

    def part(self, ids: bytes, piece_ids: bytes, piece_bytes: bytes, start: int | None, stop: int | None) -> bytes:
        """Bytes ``start`` to ``stop`` of one text, from the ids of the pieces that touch them."""
        if not ids or start is None or stop is None or stop <= max(start, 0):
            return b""
        numbers, at, begins = (np.frombuffer(x, "<u4") for x in (ids, piece_ids, piece_bytes))
        start = max(start, 0)
        first = int(np.searchsorted(begins, start, "right")) - 1
        last = int(np.searchsorted(begins, stop, "left"))
        found = self.decode(numbers[at[first]:at[last] if last < len(at) else len(numbers)]).tobytes()
        return found[start - int(begins[first]):stop - int(begins[first])]


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """Ranks of a file with one ``base64 rank`` a line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


@functools.cache
def coder(path: str) -> Coder:
    """The coder of a rank file; once per Python worker."""
    with open(path, "rb") as file:
        return Coder(parse_ranks(file.read()))


#: What :func:`encode` adds with ``offsets``: where each piece begins among the ids and the bytes.
OFFSETS = ["piece_ids", "piece_bytes"]


def encode(docs: DataFrame, ranks: str, column: str = "text", offsets: bool = False) -> DataFrame:
    """``docs`` plus ``token_ids`` (little-endian unsigned 32-bit numbers) and ``n_tokens``.

    ``ranks`` is the path of the rank file on every machine (an installed package).  Null
    counts as empty text; empty text has no ids, an empty table gives an empty one.  A text of
    any length is encoded whole.  Each row stands for itself, so repeated rows and further
    columns are kept; columns of the new names are replaced.  With ``offsets``
    :data:`OFFSETS` are kept in the same form as the ids, for :func:`decode_part`.
    """
    new = ["token_ids", "n_tokens", *(OFFSETS if offsets else [])]
    rest = [c for c in docs.columns if c not in new]
    kept = docs.select(*rest)
    schema = T.StructType(list(kept.schema.fields)).add("token_ids", "binary").add("n_tokens", "long")
    for name in new[2:]:
        schema = schema.add(name, "binary")

    def run(batches):
        own = coder(ranks)
        for batch in batches:
            for part, texts in steps(batch, column, 1 << 20):
                tokens = own.encode(texts)
                counts = np.diff(tokens.offsets)
                columns = [binaries(tokens.ids.astype("<u4"), counts), pa.array(counts)]
                if offsets:
                    many = np.diff(tokens.firsts)
                    columns += [binaries((places - np.repeat(starts, many)).astype("<u4"), many) for places, starts in (
                        (tokens.pieces[:-1], tokens.offsets[:-1]), (tokens.begins, texts.offsets[:-1]))]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*rest, *new])

    return kept.mapInArrow(run, schema)


def decode_part(docs: DataFrame, ranks: str, start: str, stop: str, to: str = "part") -> DataFrame:
    """``docs`` of ``encode(offsets=True)`` plus the bytes ``start`` to ``stop`` (exclusive) of each text.

    Columns ``start`` and ``stop`` count bytes of the text.  The pieces around the part are found
    by their offsets, and only their ids are decoded.  Ends outside the text are moved to it;
    with a null end, no ids or an empty range the part is empty.  All rows and further columns
    are kept; a column named ``to`` is replaced.
    """
    rest = [c for c in docs.columns if c != to]
    kept = docs.select(*rest, F.col(start).cast("long").alias("__start"), F.col(stop).cast("long").alias("__stop"))
    schema = T.StructType(list(kept.schema.fields)[:-2]).add(to, "binary")
    needed = ["token_ids", *OFFSETS, "__start", "__stop"]

    def run(batches):
        own = coder(ranks)
        for batch in batches:
            parts = [own.part(*row) for row in zip(*(batch.column(c).to_pylist() for c in needed), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(parts, pa.binary())], names=[*rest, to])

    return kept.mapInArrow(run, schema)


def decode(docs: DataFrame, ranks: str, column: str = "token_ids", to: str = "decoded") -> DataFrame:
    """``docs`` plus the bytes that the ids of ``column`` stand for; null counts as no ids."""
    rest = [c for c in docs.columns if c != to]
    kept = docs.select(*rest)
    schema = T.StructType(list(kept.schema.fields)).add(to, "binary")

    def run(batches):
        own = coder(ranks)
        for batch in batches:
            decoded = [own.decode(np.frombuffer(x or b"", "<u4")).tobytes()
                       for x in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], names=[*rest, to])

    return kept.mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks: str) -> DataFrame:
    """Per document: number of ids, and hashes of the ids and of the bytes they decode to."""

    def run(batches):
        own = coder(ranks)
        for batch in batches:
            for part, texts in steps(batch, "text", 1 << 20):
                tokens = own.encode(texts)
                packed = [tokens.of(i).astype("<u4").tobytes() for i in range(len(texts))]
                back = [own.decode(np.frombuffer(x, "<u4")) for x in packed]
                yield table(
                    doc_id=part.column("doc_id"), n_tokens=np.diff(tokens.offsets),
                    ids_sha256=[hashlib.sha256(x).hexdigest() for x in packed],
                    decoded_sha256=[hashlib.sha256(x).hexdigest() for x in back])

    return docs.selectExpr("cast(doc_id AS long) doc_id", "cast(text AS string) text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
