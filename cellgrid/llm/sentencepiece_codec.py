"""SentencePiece encoding and decoding with a batched Viterbi search in NumPy.

The distinct units of a whole column (a blank and what follows it, see ``pieces``) are encoded once.  Units of equal
length advance together, one character a step.  At each step the hashes of all substrings that end there probe the
sorted keys of the pieces; a hit may extend the best path that ends at its beginning if merging keeps the two pieces
apart, and the maximum over the candidates stores the back pointer.  For a merge vocabulary exactly one candidate
passes, so the best path is the library's own encoding, not an approximation.  Characters without a piece
become byte pieces.  The ids of the texts are gathered from those of their units.

Pairs of pieces are checked vectorised, too: all pairs undo their merges step by step together, and results are kept in a
table of fixed size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytescan import mix, slices
from .pieces import BLANK, START, UNKNOWN, PieceModel, compile_model, fallback, merged_arrays

MAX_UNITS = 250_000
PAIR_SLOTS = 1 << 20
WIDE = 48
#: units are padded to the longest of their class
WIDTHS = (0, 6, 10, 16, 28, WIDE)
PAD = 0x110000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Whether piece b may stand after piece a, for arrays of pairs; a direct-mapped table remembers the answers."""

    def __init__(self, model: PieceModel):
        self.keys, self.ranks = merged_arrays(model)
        self.rank = np.array(model.rank, np.int64)
        self.left, self.right = np.array(model.left, np.int64), np.array(model.right, np.int64)
        self.slot_key = np.full(PAIR_SLOTS, -1, np.int64)
        self.slot_ok = np.zeros(PAIR_SLOTS, bool)

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = a < 0  # the start and unknown characters keep everything apart
        known = np.flatnonzero(~out)
        if not len(known):
            return out
        key = a[known] << 32 | b[known]
        slot = (mix(key.astype(np.uint64)) & np.uint64(PAIR_SLOTS - 1)).astype(np.int64)
        miss = self.slot_key[slot] != key
        if miss.any():
            new = np.unique(key[miss])
            ok = self._undo(new >> 32, new & 0xFFFFFFFF)
            at = (mix(new.astype(np.uint64)) & np.uint64(PAIR_SLOTS - 1)).astype(np.int64)
            self.slot_key[at], self.slot_ok[at] = new, ok
            out[known[miss]] = ok[np.searchsorted(new, key[miss])]
        hit = ~miss
        # slots that the new answers took over are still right for the keys that were found before
        out[known[hit]] = self.slot_ok[slot[hit]] if not miss.any() else self._again(slot[hit], key[hit])
        return out

    def _again(self, slot: np.ndarray, key: np.ndarray) -> np.ndarray:
        ok, lost = self.slot_ok[slot], self.slot_key[slot] != key
        if lost.any():
            ok[lost] = self._undo(key[lost] >> 32, key[lost] & 0xFFFFFFFF)
        return ok

    def _undo(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = a.copy(), b.copy()
        before = np.full(len(a), 1 << 60, np.int64)
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            key = x << 32 | y
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            joined = (self.keys[at] == key) & (self.ranks[at] < before[live])
            ok[live[joined]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~joined & ((rx >= 0) | (ry >= 0))
            first = go & (rx > ry)
            second = go & ~first
            before[live[first]], a[live[first]] = rx[first], self.right[x[first]]
            before[live[second]], b[live[second]] = ry[second] + 1, self.left[y[second]]
            live = live[go]
        return ok


class Codec:
    """Encoder and decoder of one vocabulary; ``MAX_UNITS`` bounds the remembered units."""

    def __init__(self, model: PieceModel):
        self.model, self.pairs = model, PairTable(model)
        self.longest = model.longest
        powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(WIDE, self.longest) + 1, _FACTOR, np.uint64)]))
        self.powers = powers
        text = sorted(model.ids.items(), key=lambda x: x[1])
        width = max(len(p) for p, _ in text)
        self.codes = np.zeros((len(model.pieces), width), np.uint32)
        self.length = np.zeros(len(model.pieces), np.int64)
        for p, i in text:
            self.codes[i, :len(p)] = np.frombuffer(p.encode("utf-32-le"), np.uint32)
            self.length[i] = len(p)
        ids = np.array([i for _, i in text], np.int64)
        values = self.codes[ids].astype(np.uint64) + np.uint64(1)
        masked = np.where(np.arange(width) < self.length[ids][:, None], values, 0)
        hashes = np.array([self._hash(row[:n]) for row, n in zip(masked, self.length[ids], strict=True)], np.uint64)
        order = np.argsort(hashes)
        self.piece_key, self.piece_id = hashes[order], ids[order]
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two pieces share a hash")
        # a bit for the leading 18 bits of the keys of each length spares most searches
        self.maybe = np.zeros((self.longest + 1, 1 << 18), bool)
        self.maybe[self.length[self.piece_id], (self.piece_key >> np.uint64(46)).astype(np.int64)] = True
        self.units: dict[str, bytes] = {}
        spelled = [p.replace(BLANK, " ").encode() for p in model.pieces]
        for b, i in enumerate(model.byte_ids):
            spelled[i] = bytes([b])
        spelled[0] = " ⁇ ".encode()
        spelled[1] = spelled[2] = b""
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.byte_length = np.array([len(x) for x in spelled], np.int64)
        self.byte_start = np.cumsum(self.byte_length) - self.byte_length

    def _hash(self, values: np.ndarray) -> np.uint64:
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for v in values:
                h = h * _FACTOR + v
        return h

    def viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best piece that ends at each position, and its length, for words of equal length (the rows of ``codes``;
        shorter ones are padded behind their end)."""
        m, n = codes.shape
        running = np.zeros((n + 1, m), np.uint64)
        piece = np.full((n + 1, m), START, np.int64)
        back = np.ones((n + 1, m), np.int64)
        for i in range(1, n + 1):
            running[i] = running[i - 1] * _FACTOR + codes[:, i - 1].astype(np.uint64) + np.uint64(1)
            best = np.zeros(m, np.int64)
            piece[i] = UNKNOWN
            for size in range(1, min(i, self.longest) + 1):
                key = running[i] - running[i - size] * self.powers[size]
                word = np.flatnonzero(self.maybe[size, (key >> np.uint64(46)).astype(np.int64)])
                at = np.searchsorted(self.piece_key, key[word])
                at[at == len(self.piece_key)] = 0
                exact = self.piece_key[at] == key[word]
                word, found = word[exact], self.piece_id[at[exact]]
                if not len(word):
                    continue
                same = (self.length[found] == size) & (self.codes[found, :size] == codes[word, i - size:i]).all(axis=1)
                word, found = word[same], found[same]
                ok = self.pairs.apart(piece[i - size, word], found)
                score = np.where(ok, size, 0)
                better = score > best[word]
                word, found = word[better], found[better]
                best[word], piece[i, word], back[i, word] = size, found, size
        return piece, back

    def learn(self, distinct: list[str]) -> None:
        """Encode the units that are not remembered, equal lengths together."""
        if len(self.units) > MAX_UNITS:
            self.units.clear()
        new = sorted(set(distinct).difference(self.units), key=len)
        self.units.update((u, b"" if not u else self._one(u)) for u in new if not u or len(u) > WIDE)
        length = np.fromiter(map(len, new), np.int64, len(new))
        for low, high in zip(WIDTHS, WIDTHS[1:], strict=False):
            units = new[np.searchsorted(length, low, side="right"):np.searchsorted(length, high, side="right")]
            if units:
                size = np.fromiter(map(len, units), np.int64, len(units))
                codes = np.full((len(units), int(size[-1])), PAD, np.uint32)
                codes[np.arange(codes.shape[1]) < size[:, None]] = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
                self._follow(units, size, *self.viterbi(codes))

    def _follow(self, units, size, piece, back) -> None:
        m, n = len(units), int(size[-1])
        out = np.full((m, n), -1, np.int64)
        at = size.copy()
        rows = np.arange(m)
        step = n - 1
        while True:  # from the end, every word at its own position
            live = at > 0
            if not live.any():
                break
            out[rows[live], step] = piece[at[live], rows[live]]
            out[rows[~live], step] = -9
            at[live] -= back[at[live], rows[live]]
            step -= 1
        out[:, :step + 1] = -9
        odd = np.flatnonzero((out == UNKNOWN).any(axis=1))
        keep = out != -9
        ends = np.cumsum(keep.sum(axis=1)) * 4
        flat = out[keep].astype(np.int32).tobytes()
        starts = ends - keep.sum(axis=1) * 4
        self.units.update((u, flat[a:b]) for u, a, b in zip(units, starts.tolist(), ends.tolist(), strict=True))
        for r in odd.tolist():
            self.units[units[r]] = self._one(units[r])

    def _one(self, unit: str) -> bytes:
        """The same search for one unit, character by character, with byte pieces."""
        m = self.model
        piece, back = [START], [0]
        for i in range(1, len(unit) + 1):
            got, size = UNKNOWN, 1
            if unit[i - 1] in m.ids:
                for k in range(1, min(i, self.longest) + 1):
                    p = m.ids.get(unit[i - k:i])
                    if p is not None and m.may_follow(piece[i - k], p):
                        got, size = p, k
            piece.append(got)
            back.append(size)
        out: list[int] = []
        i = len(unit)
        while i:
            out += [piece[i]] if piece[i] != UNKNOWN else fallback(m, unit[i - 1])[::-1]
            i -= back[i]
        return np.array(out[::-1], np.int32).tobytes()

    def _with_blank_runs(self, parts: list[str]) -> bytes:
        """One text whose blanks stand in runs."""
        out, run = [], 0
        for u in [*parts, ""]:
            if u == BLANK:
                run += 1
                continue
            mine = self.units[u] if u in self.units else self._one(u)
            if run and (u or u is parts[-1:]):
                joins = u[:1] == BLANK and mine[:4] == np.int32(self.model.ids[BLANK]).tobytes()
                out.append(np.array(self.model.blank_run(run + joins), np.int32).tobytes())
                mine, run = (mine[4:] if joins else mine), 0
            out.append(mine)
        if run:
            out.append(np.array(self.model.blank_run(run), np.int32).tobytes())
        return b"".join(out)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text)."""
        offsets, codes, distinct = self.model.column_parts(texts)
        self.learn(distinct)
        unit = [self.units[u] for u in distinct]
        flat = np.frombuffer(b"".join(unit), np.int32)
        size = np.fromiter(map(len, unit), np.int64, len(unit)) // 4
        start = np.cumsum(size) - size
        count = size[codes] if len(codes) else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(count)])
        ids = flat[np.repeat(start[codes] - ends[:-1], count) + np.arange(ends[-1])] if len(codes) else np.zeros(0, np.int32)
        row = ends[offsets]
        special = {}
        empty = np.asarray(pc.fill_null(pc.utf8_length(texts), 0)) == 0
        special.update((r, b"") for r in np.flatnonzero(empty).tolist())
        if BLANK in (code := {u: i for i, u in enumerate(distinct)}):
            hit = np.searchsorted(offsets, np.flatnonzero(codes == code[BLANK]), side="right") - 1
            for r in np.unique(hit).tolist():
                if r not in special:
                    special[r] = self._with_blank_runs([distinct[c] for c in codes[offsets[r]:offsets[r + 1]]])
        if not special:
            return ids, row
        out = [np.frombuffer(special[r], np.int32) if r in special else ids[row[r]:row[r + 1]] for r in range(len(texts))]
        return np.concatenate(out) if out else ids, np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int64)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of id sequences; bytes that are no UTF-8 become U+FFFD, the blank that opens a text is dropped."""
        ids = ids.astype(np.int64)
        size = self.byte_length[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        data = self.bytes[np.repeat(self.byte_start[ids] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        cut = ends[offsets].tolist()
        return [data[a + (data[a:a + 1] == b" " and a < b):b].decode("utf-8", "replace") for a, b in zip(cut, cut[1:], strict=False)]


_WORKER: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    key = getattr(shared, "id", 0)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Codec(shared.value)
    return _WORKER[key]


def _share(df: DataFrame, model_file: str):
    return df.sparkSession.sparkContext.broadcast(compile_model(model_file))


def _int_lists(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))


def _with_ids(batches: Iterator[pa.RecordBatch], codec: Codec, text_col: str, ids_col: str) -> Iterator[pa.RecordBatch]:
    """The rows with their ids.  Workers live on after this, so little text is encoded at a time and Arrow gives back what it holds."""
    for whole in batches:
        for b in slices(whole, text_col):
            yield pa.RecordBatch.from_arrays([*b.columns, _int_lists(*codec.encode(b.column(text_col)))], names=[*b.schema.names, ids_col])
        pa.default_memory_pool().release_unused()


def encode(docs: DataFrame, model_file: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col`` (array of int, replacing a column of that name): the vocabulary's encoding of the whole
    text, without special tokens.  Null and empty texts have no ids."""
    docs = docs.drop(ids_col)
    shared = _share(docs, model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _with_ids(batches, _codec(shared), text_col, ids_col)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, model_file: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``text_col`` (replacing a column of that name): the text of each id list; null ids give an empty text."""
    encoded = encoded.drop(text_col)
    shared = _share(encoded, model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for b in batches:
            for i in range(0, b.num_rows, 1000):
                part = b.slice(i, 1000)
                lists = pc.if_else(pc.is_null(part.column(ids_col)), pa.scalar([], pa.list_(pa.int32())), part.column(ids_col))
                offsets = np.asarray(lists.offsets, dtype=np.int64)
                texts = codec.decode(np.asarray(lists.flatten()), offsets - offsets[0])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, text_col])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(text_col, T.StringType())]))


def digest(ids: np.ndarray) -> str:
    """Hex sha256 of the ids as little-endian 32-bit integers."""
    return hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest()


def report(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256 (see ``digest``), decoded_sha256, round_trip.

    Every whole text is encoded and its ids are decoded again; ``round_trip`` says whether that gave the text back (a literal
    U+2581 reads as a blank, so such texts alone differ).  Null texts count as empty; other columns are not read."""
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    shared = _share(docs, model_file)
    schema = T.StructType([narrow.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType()), T.StructField("round_trip", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for whole in batches:
            for b in slices(whole, "text", 8 << 20):
                ids, offsets = codec.encode(b.column("text"))
                back = codec.decode(ids, offsets)
                shas = [digest(ids[x:y]) for x, y in zip(offsets, offsets[1:], strict=False)]
                plain = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in back]
                same = pc.equal(pa.array(back, pa.string()), pc.fill_null(b.column("text"), ""))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(np.diff(offsets)), pa.array(shas), pa.array(plain), same],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])

    return narrow.mapInArrow(run, schema)
