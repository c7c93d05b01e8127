"""Token counts by a compiled finite-state transducer.

The transducer reads characters and keeps what can still matter: the longest suffix read that begins some piece, the
last piece of the encoding at each position of that suffix, and the token counts there relative to now.  That is a finite
set of states, found as texts need them.  Each transition is annotated with the tokens it emits, which is the change of
the prefix's token count (it may be negative, when a merge joins what was apart); the annotations of a
path add up to the count of the text.

A blank after a non-blank resets the state, since no piece reaches over it.  So the state map of a chunk
of text is short: what stands before its first reset (which depends on the state before), the count between its first and
last reset, and what follows the last.  Maps of neighbouring chunks compose, composition is
associative, and a text's chunks are composed by a prefix scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytescan import mix, slices
from .pieces import BLANK, START, UNKNOWN, PieceModel, compile_model

CHUNK = 1 << 16
MAX_STATES = 200_000
SLOTS = 1 << 20
WIDE = 32
MAX_UNITS = 250_000


class Transducer:
    """Lazily compiled states; ``MAX_STATES`` and ``MAX_UNITS`` bound the memory, what is dropped is compiled again."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.prefixes = {p[:k] for p in model.ids for k in range(1, len(p))}
        self._reset()

        class Units(dict):
            def __missing__(units, unit):  # noqa: N805
                if len(units) > MAX_UNITS:
                    units.clear()
                n = units[unit] = self.run(unit)
                return n

        self.units = Units()

    def _reset(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[str, tuple[int, int]]] = []
        # the same transitions as an open-addressing table, for many units at a time
        self.slot_key = np.full(SLOTS, -1, np.int64)
        self.slot_next = np.zeros(SLOTS, np.int32)
        self.slot_tokens = np.zeros(SLOTS, np.int16)
        self.filled = 0
        self._state(("", (START,), (0,)))

    def _state(self, state: tuple) -> int:
        n = self.numbers.get(state)
        if n is None:
            n = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        return n

    def _compile(self, at: int, char: str) -> tuple[int, int]:
        """The transition of one state on one character: (next state, emitted tokens)."""
        suffix, last, count = self.states[at]
        m = self.model
        if char not in m.ids:  # no piece reaches over it
            return self._state(("", (UNKNOWN,), (0,))), len(char.encode("utf-8", "surrogatepass"))
        read = suffix + char
        for begin in range(len(read)):
            piece = m.ids.get(read[begin:])
            if piece is not None and last[begin] is not None and m.may_follow(last[begin], piece):
                break
        now = count[begin] + 1
        # only where the text read since begins some piece can a later piece begin
        open_at = [k for k in range(len(read)) if read[k:] in self.prefixes]
        keep = open_at[0] if open_at else len(read)
        alive = {*open_at, len(read)}
        last, count = (*last, piece), (*count, now)
        return self._state((read[keep:], tuple(last[k] if k in alive else None for k in range(keep, len(read) + 1)),
                            tuple(count[k] - now if k in alive else None for k in range(keep, len(read) + 1)))), now

    def run(self, unit: str, at: int = 0) -> int:
        """Tokens emitted for one unit from the start state."""
        if len(self.states) > MAX_STATES:
            self._reset()
        total, moves = 0, self.moves
        for char in unit:
            move = moves[at].get(char)
            if move is None:
                move = moves[at][char] = self._compile(at, char)
            at, n = move
            total += n
        return total

    def _lookup(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each (state, character) key, -1 where it is not compiled yet."""
        slot = (mix(keys.astype(np.uint64)) & np.uint64(SLOTS - 1)).astype(np.int64)
        found = np.where(self.slot_key[slot] == keys, slot, -1)
        todo = np.flatnonzero((found < 0) & (self.slot_key[slot] >= 0))
        while len(todo):  # collisions: the next slots
            slot[todo] = (slot[todo] + 1) & (SLOTS - 1)
            here = self.slot_key[slot[todo]]
            found[todo[here == keys[todo]]] = slot[todo[here == keys[todo]]]
            todo = todo[(here >= 0) & (here != keys[todo])]
        return found

    def _insert(self, keys: np.ndarray) -> None:
        starts = (mix(keys.astype(np.uint64)) & np.uint64(SLOTS - 1)).tolist()
        for key, slot in zip(keys.tolist(), starts, strict=True):
            at, char = key >> 21, chr(key & 0x1FFFFF)
            move = self.moves[at].get(char)
            if move is None:
                move = self.moves[at][char] = self._compile(at, char)
            while self.slot_key[slot] >= 0:
                slot = (slot + 1) & (SLOTS - 1)
            self.slot_key[slot], self.slot_next[slot], self.slot_tokens[slot] = key, *move
            self.filled += 1

    def learn(self, units: set[str]) -> None:
        """Count many new units at once: they advance character by character together, the longest first."""
        if len(self.units) > MAX_UNITS:
            self.units.clear()
        new = sorted((u for u in units.difference(self.units) if len(u) <= WIDE), key=len, reverse=True)
        if not new:
            return
        if len(self.states) > MAX_STATES or self.filled > SLOTS * 3 // 5:
            self._reset()
        length = np.fromiter(map(len, new), np.int64, len(new))
        codes = np.zeros((len(new), int(length[0])), np.uint32)
        flat = np.frombuffer("".join(new).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes[np.arange(codes.shape[1]) < length[:, None]] = flat
        at, total = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        for t in range(codes.shape[1]):
            n = int(np.searchsorted(-length, -t, side="left"))  # units longer than t
            keys = at[:n] << 21 | codes[:n, t]
            slot = self._lookup(keys)
            if (slot < 0).any():
                self._insert(np.unique(keys[slot < 0]))
                slot = self._lookup(keys)
            at[:n], total[:n] = self.slot_next[slot], total[:n] + self.slot_tokens[slot]
        self.units.update(zip(new, total.tolist(), strict=True))

    def begins_blank(self, unit: str) -> bool:
        """Whether the unit's first piece is the blank alone: then it joins the blanks before it."""
        if len(unit) < 2 or unit[1] not in self.model.ids:
            return True
        return self.run(unit) == self.run(unit[1:]) + 1 and self._keeps_blank(unit)

    def _keeps_blank(self, unit: str) -> bool:
        """The first piece, read off the states along the unit."""
        at, seen = 0, []
        m = self.model
        last: list[int] = [START]
        for i, char in enumerate(unit):
            if char not in m.ids:
                break
            for begin in range(max(0, i + 1 - m.longest), i + 1):
                piece = m.ids.get(unit[begin:i + 1])
                if piece is not None and m.may_follow(last[begin], piece):
                    break
            last.append(piece)
            seen.append(begin)
        at = len(seen)
        while at > 0 and seen[at - 1] > 0:
            at = seen[at - 1]
        return at == 1

    def count(self, text: str) -> int:
        """Tokens of a stretch that begins at a reset (a leading blank stands for itself)."""
        return self.add_up(self.model.parts(text))

    def add_up(self, parts: list[str]) -> int:
        if BLANK not in parts:
            return sum(map(self.units.__getitem__, parts))
        total = run = 0
        for u in parts:
            if u == BLANK:
                run += 1
            elif u:
                if run:
                    joins = u[0] == BLANK and self.begins_blank(u)
                    total += len(self.model.blank_run(run + joins)) - joins
                    run = 0
                total += self.units[u]
        return total + (len(self.model.blank_run(run)) if run else 0)


@dataclass(frozen=True)
class ChunkMap:
    """State map of a chunk: text before its first reset, tokens between first and last reset, text after the last.
    Without a reset, ``head`` is the whole chunk and ``tail`` is None."""

    head: str
    tokens: int = 0
    tail: str | None = None


def chunk_map(t: Transducer, chunk: str) -> ChunkMap:
    """``chunk`` holds blanks as spaces.  A reset lies before a space that follows something else."""
    first = _next_reset(chunk, 1)
    if first < 0:
        return ChunkMap(chunk)
    last = len(chunk)
    while True:
        last = chunk.rfind(" ", 0, last)
        if chunk[last - 1] != " ":
            break
    return ChunkMap(chunk[:first], t.count(chunk[first:last]) if last > first else 0, chunk[last:])


def _next_reset(s: str, at: int) -> int:
    while True:
        at = s.find(" ", at)
        if at < 0 or s[at - 1] != " ":
            return at
        at += 1


def compose(t: Transducer, a: ChunkMap, b: ChunkMap) -> ChunkMap:
    """First a, then b; associative."""
    if a.tail is None and b.tail is None:
        whole = a.head + b.head
        cut = len(a.head)
        if cut and b.head[:1] == " " and whole[cut - 1] != " ":  # the border itself is a reset
            return ChunkMap(a.head, 0, b.head)
        return ChunkMap(whole)
    if a.tail is None:
        if b.head[:1] == " " and a.head and a.head[-1] != " ":
            return ChunkMap(a.head, t.count(b.head) + b.tokens, b.tail)
        return ChunkMap(a.head + b.head, b.tokens, b.tail)
    border = b.head[:1] == " " and a.tail[-1] != " "
    if b.tail is None:
        return ChunkMap(a.head, a.tokens + t.count(a.tail), b.head) if border else ChunkMap(a.head, a.tokens, a.tail + b.head)
    middle = t.count(a.tail) + t.count(b.head) if border else t.count(a.tail + b.head)
    return ChunkMap(a.head, a.tokens + middle + b.tokens, b.tail)


def prefix_scan(t: Transducer, maps: list[ChunkMap]) -> list[ChunkMap]:
    """Inclusive prefixes of composed maps, in log2(n) sweeps (up and down a balanced tree)."""
    if len(maps) <= 1:
        return list(maps)
    pairs = [compose(t, maps[i], maps[i + 1]) for i in range(0, len(maps) - 1, 2)]
    upper = prefix_scan(t, pairs)
    out = []
    for i, m in enumerate(maps):
        out.append(m if i == 0 else upper[i // 2] if i % 2 else compose(t, upper[i // 2 - 1], m))
    return out


def count_text(t: Transducer, text: str, chunk: int = CHUNK) -> int:
    """Tokens of a text, with the blank that the vocabulary puts before every text."""
    if not text:
        return 0
    if len(text) < chunk:
        return t.count(" " + text)
    s = " " + text.replace(BLANK, " ")
    whole = prefix_scan(t, [chunk_map(t, s[i:i + chunk]) for i in range(0, len(s), chunk)])[-1]
    return t.count(whole.head) + whole.tokens + (t.count(whole.tail) if whole.tail else 0)


def count_batch(t: Transducer, texts: pa.Array) -> list[int]:
    """``count_text`` of each text of a column; the column's distinct units are learned together first."""
    offsets, codes, distinct = t.model.column_parts(texts)
    t.learn(set(distinct))
    tokens = np.fromiter(map(t.units.__getitem__, distinct), np.int64, len(distinct))
    running = np.concatenate([[0], np.cumsum(tokens[codes])])
    counts = running[offsets[1:]] - running[offsets[:-1]]
    size = np.asarray(pc.fill_null(pc.utf8_length(texts), 0))
    # runs of blanks join their neighbours, so they are not the sum of their units
    code = {u: i for i, u in enumerate(distinct)}
    if BLANK in code:
        rows = np.repeat(np.arange(len(texts)), np.diff(offsets))
        solid = np.flatnonzero(codes != code.get("", -1))
        alone = codes[solid] == code[BLANK]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], alone.astype(np.int8), [0]])))
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            # a run may go on over several texts: each text closes its own
            for row, n, last in _by_row(rows, solid, begin, end):
                after = solid[last + 1] if last + 1 < len(solid) else -1
                unit = distinct[codes[after]] if after >= 0 and rows[after] == row else ""
                joins = unit[:1] == BLANK and t.begins_blank(unit)
                counts[row] += len(t.model.blank_run(n + joins)) - joins - n
    counts[size == 0] = 0
    for row in np.flatnonzero(size >= CHUNK).tolist():  # very long texts are counted in chunks
        counts[row] = count_text(t, texts[row].as_py())
    return counts.tolist()


def _by_row(rows: np.ndarray, solid: np.ndarray, begin: int, end: int):
    """Split the run solid[begin:end] where a new text starts: (row, length, last index)."""
    own = rows[solid[begin:end]]
    for row in np.unique(own).tolist():
        n = int((own == row).sum())
        yield row, n, begin + int(np.searchsorted(own, row, side="right")) - 1


_WORKER: dict[int, Transducer] = {}


def _counter(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _WORKER.get(shared.id if hasattr(shared, "id") else 0)
        if t is None:
            _WORKER.clear()
            t = _WORKER[getattr(shared, "id", 0)] = Transducer(shared.value)
        for whole in batches:
            for batch in slices(whole, "text", 8 << 20):
                texts = batch.column("text")
                sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
                counts = count_batch(t, texts)
                names = [n for n in batch.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), sizes, pa.array(counts, pa.int64())],
                                                 names=[*names, "n_bytes", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    Counts are those of the vocabulary's own library without special tokens.  A null text counts as empty (0 tokens);
    control strings inside texts are ordinary text; other columns are not read; repeated rows stay.
    """
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(compile_model(model_file))
    schema = T.StructType([narrow.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return narrow.mapInArrow(_counter(shared), schema).withColumn("over_limit", F.col("n_tokens") > limit)
