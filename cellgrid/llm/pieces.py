"""Merge rules of a public SentencePiece BPE vocabulary, compiled once on the driver.

Merging always joins the adjacent pair whose union has the best score, the leftmost of equals.  Two facts let
a text be encoded from left to right without simulating that:

* The encoding of a prefix is the encoding of a shorter prefix plus its last piece, and exactly one last piece
  is possible at each position.
* A piece may follow another exactly if merging would leave the two apart, which is decided by undoing the merges at
  their border from the last to the first and looking for a pair across the border that would have merged earlier.

Pieces made of blanks only share one score, so the second fact does not cover them; no other piece has a blank after
its first character, so blanks are settled after all other merges and handled by themselves (``blank_run``).
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK = "▁"
START = -1
UNKNOWN = -2


@dataclass
class PieceModel:
    """``pieces`` by id; ``byte_ids``: the 256 fallback pieces; everything else is derived."""

    pieces: list[str]
    ids: dict[str, int]
    rank: list[int]
    left: list[int]
    right: list[int]
    merged_rank: dict[int, int]
    byte_ids: list[int]
    blank_runs: dict[int, int]
    longest: int
    newline_alone: bool
    _pairs: dict[int, bool] = field(default_factory=dict, repr=False)
    _runs: dict[int, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging keeps the pieces a, b apart when their texts stand side by side."""
        if a < 0 or b < 0:
            return True
        key = a << 32 | b
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) > 1 << 19:
                self._pairs.clear()
            known = self._pairs[key] = self._apart(a, b)
        return known

    def _apart(self, a: int, b: int) -> bool:
        far = 1 << 60
        before = far  # a merge across the border of a lower rank than this one would have come first
        while True:
            if self.merged_rank.get(a << 32 | b, far) < before:
                return False
            ra, rb = self.rank[a], self.rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                before, a = ra, self.right[a]
            else:  # of equal merges the left one, across the border, comes first
                before, b = rb + 1, self.left[b]

    def blank_run(self, n: int) -> tuple[int, ...]:
        """Ids of n blanks in a row that nothing else has merged with."""
        if n not in self._runs:
            if len(self._runs) > 1 << 12:
                self._runs.clear()
            self._runs[n] = self._merge_blanks(n)
        return self._runs[n]

    def _merge_blanks(self, n: int) -> tuple[int, ...]:
        size, after, before = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [i for i in range(n - 1) if 2 in self.blank_runs]
        while heap:
            i = heapq.heappop(heap)
            j = after[i] if size[i] else n
            if j >= n or size[i] + size[j] not in self.blank_runs:
                continue
            size[i], size[j] = size[i] + size[j], 0
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if size[i] + size[after[i]] in self.blank_runs:
                    heapq.heappush(heap, i)
            if before[i] >= 0 and size[before[i]] + size[i] in self.blank_runs:
                heapq.heappush(heap, before[i])
        return tuple(self.blank_runs[s] for s in size if s)

    def parts(self, text: str) -> list[str]:
        """Cut a text where nothing merges: before blanks, and around newlines if no piece holds one.

        A part that is a blank alone stands before another blank, a newline or the end; empty parts mean nothing."""
        s = text.replace(BLANK, " ").replace(" ", " " + BLANK)
        if self.newline_alone:
            s = s.replace("\n", " \n ")
        return s.split(" ")

    def column_parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """``parts`` of every text of a column, each with the blank that opens a text: (row offsets, codes, distinct
        parts).  Null texts have no parts."""
        s = pc.binary_join_element_wise(pa.scalar(" "), pc.fill_null(texts, ""), pa.scalar(""))
        s = pc.replace_substring(s, BLANK, " ") if pc.any(pc.match_substring(s, BLANK)).as_py() else s
        s = pc.replace_substring(s, " ", " " + BLANK)
        if self.newline_alone:
            s = pc.replace_substring(s, "\n", " \n ")
        cut = pc.split_pattern(s, " ")
        words = cut.flatten().dictionary_encode()
        offsets = np.asarray(cut.offsets, dtype=np.int64)
        return offsets - offsets[0], np.asarray(words.indices, dtype=np.int64), words.dictionary.to_pylist()


def _own_merges(chars: list[int], merged: dict[int, tuple[int, int]]) -> tuple[list[int], tuple[int, int] | None]:
    """Plain merging of one short sequence: (remaining ids, the last pair merged)."""
    ids, last = list(chars), None
    while len(ids) > 1:
        best = min(((merged[a << 32 | b][0], i) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if a << 32 | b in merged), default=None)
        if best is None:
            break
        i = best[1]
        last = (ids[i], ids[i + 1])
        ids[i:i + 2] = [merged[ids[i] << 32 | ids[i + 1]][1]]
    return ids, last


def compile_model(model_file: str) -> PieceModel:
    """Read the vocabulary's pieces and scores and derive the merge tables.  Raises on a vocabulary that is no
    BPE with byte fallback, identity normalisation and blanks only at the front of pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(size)]
    plain = [i for i in range(size) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
    byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(sp.is_byte(i) for i in byte_ids) or any(BLANK in pieces[i].lstrip(BLANK) for i in plain):
        raise ValueError("only byte-fallback vocabularies with blanks at the front of pieces are supported")
    ids = {pieces[i]: i for i in plain}
    blank_runs = {len(p): i for p, i in ids.items() if not p.strip(BLANK)}
    if any(p.startswith(BLANK * 2) and p.strip(BLANK) for p in ids):
        raise ValueError("a piece mixes several blanks with text")
    words = {p: i for p, i in ids.items() if p.strip(BLANK) or p == BLANK}
    multi = sorted((i for p, i in words.items() if len(p) > 1), key=lambda i: -sp.get_score(i))
    if len({sp.get_score(i) for i in multi}) != len(multi):
        raise ValueError("equal scores")
    rank = [-1] * size
    for r, i in enumerate(multi):
        rank[i] = r
    merged = {}
    for i in multi:
        p = pieces[i]
        for cut in range(1, len(p)):
            a, b = words.get(p[:cut]), words.get(p[cut:])
            if a is not None and b is not None:
                merged[a << 32 | b] = (rank[i], i)
    left, right = [-1] * size, [-1] * size
    reachable = {}
    for p, i in words.items():
        if len(p) == 1:
            reachable[p] = i
            continue
        chars = [words.get(c) for c in p]
        if None in chars:
            continue
        out, last = _own_merges(chars, merged)
        if out == [i]:
            left[i], right[i] = last
            if max(rank[last[0]], rank[last[1]]) >= rank[i]:
                raise ValueError("a merge precedes one of its parts")
            reachable[p] = i
    return PieceModel(pieces=pieces, ids=reachable, rank=rank, left=left, right=right,
                      merged_rank={k: v[0] for k, v in merged.items()}, byte_ids=byte_ids, blank_runs=blank_runs,
                      longest=max(map(len, reachable)), newline_alone=not any("\n" in p for p in words))


def fallback(model: PieceModel, char: str) -> list[int]:
    """Byte pieces of a character that is no piece itself."""
    return [model.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]


def merged_arrays(model: PieceModel) -> tuple[np.ndarray, np.ndarray]:
    """Sorted pair keys and their ranks."""
    keys = np.fromiter(model.merged_rank, np.int64, len(model.merged_rank))
    order = np.argsort(keys)
    return keys[order], np.fromiter(model.merged_rank.values(), np.int64, len(keys))[order]
