"""Benchmark decontamination with training suffix arrays.

Every slice of a document partition is a shard.  Its suffix array holds the word
positions where a test window could start (their first words all occur in the benchmark,
the first two as neighbours: any other suffix cannot match), sorted by their first
``window`` words.  Every test suffix is binary-searched in it; equal ranges give all
verbatim occurrences with their locations, and matches are followed along the text to
their full length.  No document leaves its task, nothing is shuffled.

The benchmark is cut into blocks of ``block_bytes`` by a hash of the item.  One block is on
the driver and broadcast at a time, so a benchmark of any size works; documents pass the
blocks one after another and keep what earlier blocks found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytescan import ALNUM, range_hashes, slices, utf8, words

WINDOW = 10
BLOCK_BYTES = 32 << 20
_STATE = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.LongType())),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("item_id", T.StringType()), T.StructField("doc_word", T.LongType()),
        T.StructField("item_word", T.LongType()), T.StructField("n_words", T.LongType())])))])
_ARROW = pa.struct([
    ("n_words", pa.int64()), ("hits", pa.list_(pa.int64())),
    ("matches", pa.list_(pa.struct([("item_id", pa.string()), ("doc_word", pa.int64()),
                                    ("item_word", pa.int64()), ("n_words", pa.int64())])))])


def _keys(ids: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Fixed-width byte keys of ids[at : at + width]; they sort as the word sequences do. Ids are 1 or more."""
    grid = ids[at[:, None] + np.arange(width)].astype(">u4")
    return np.ascontiguousarray(grid).view(f"S{4 * width}").ravel()


class TestSuffixes:
    """The distinct test windows of one block of benchmark items, ready to be searched."""

    __test__ = False

    def __init__(self, item_ids: list[str], texts: pa.Array, window: int):
        data, offsets = utf8(texts)
        low, starts, ends, first = words(data, offsets, ALNUM)
        hashes = range_hashes(low, starts, ends)
        self.window, self.item_ids = window, item_ids
        self.vocabulary = np.unique(hashes)
        ids = np.searchsorted(self.vocabulary, hashes).astype(np.int64) + 1
        self.spelling: dict[int, bytes] = {int(i): bytes(low[a:b]) for i, a, b in zip(ids, starts, ends, strict=True)}
        length = np.diff(first)
        self.shortest = int(min(window, length[length > 0].min())) if (length > 0).any() else 0
        inner = np.ones(max(len(ids) - 1, 0), bool)
        inner[first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(ids))] - 1] = False
        self.pairs = np.unique((ids[:-1] << 32 | ids[1:])[inner]) if len(ids) > 1 else np.zeros(0, np.int64)
        item = np.repeat(np.arange(len(item_ids)), length)
        word = np.arange(len(ids)) - np.repeat(first[:-1], length)
        left = np.repeat(length, length) - word
        padded = np.concatenate([ids, np.zeros(window, np.int64)])
        long_at = np.flatnonzero(left >= window)
        self.groups = [self._group(padded, long_at, window, item, word, window)]
        for size in range(1, window):  # an item shorter than the window is one window
            at = np.flatnonzero((left == size) & (word == 0))
            if len(at):
                self.groups.append(self._group(padded, at, size, item, word, window))

    @staticmethod
    def _group(ids, at, size, item, word, window):
        """Windows of one size: lower and upper search keys of the distinct ones and where items hold them."""
        keys, which = np.unique(_keys(ids, at, size), return_inverse=True)
        order = np.argsort(which, kind="stable")
        wide = np.zeros((len(keys), 4 * window), np.uint8)
        wide[:, :4 * size] = np.ascontiguousarray(keys).view(np.uint8).reshape(len(keys), 4 * size)
        top = wide.copy()
        top[:, 4 * size:] = 255
        as_key = lambda m: np.ascontiguousarray(m).view(f"S{4 * window}").ravel()
        item_window = np.full(len(ids) + 1, -1, np.int64)
        item_window[at] = which
        first = np.zeros(len(keys), np.int64)
        first[which[::-1]] = at[::-1]
        return {"size": size, "low": as_key(wide), "high": as_key(top), "window_at": item_window,
                "words": ids[first[:, None] + np.arange(size)] if len(keys) else np.zeros((0, size), np.int64),
                "at": at[order], "item": item[at[order]], "word": word[at[order]],
                "of": np.searchsorted(which[order], np.arange(len(keys) + 1))}


def _search(tests: TestSuffixes, low, starts, ends, first):
    """Hit word positions and, per (row, item), the longest verbatim match, for one slice of documents."""
    n = len(starts)
    hashes = range_hashes(low, starts, ends)
    at = np.searchsorted(tests.vocabulary, hashes)
    at[at == len(tests.vocabulary)] = 0
    ids = np.where(tests.vocabulary[at] == hashes, at + 1, 0).astype(np.int64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    # words known in a row up to each position: a suffix needs `shortest` known words from its start
    known = np.concatenate([[0], np.cumsum(ids > 0)])
    need = tests.shortest
    start_ok = np.zeros(n, bool)
    if n >= need:
        m = n - need + 1
        start_ok[:m] = (known[need:] - known[:m] == need) & (row[:m] == row[need - 1:])
        if need > 1:
            pair = ids[:-1] << 32 | ids[1:]
            j = np.searchsorted(tests.pairs, pair[:m])
            j[j == len(tests.pairs)] = 0
            start_ok[:m] &= tests.pairs[j] == pair[:m] if len(tests.pairs) else False
    suffix = np.flatnonzero(start_ok)
    hit = np.zeros(n + 1, np.int64)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    if len(suffix):
        w = tests.window
        # a suffix ends with its document: positions of later rows read as the absent word 0
        grid = suffix[:, None] + np.arange(w)
        values = np.where(grid < first[row[suffix] + 1][:, None], np.concatenate([ids, np.zeros(w, np.int64)])[grid], 0)
        keys = np.ascontiguousarray(values.astype(">u4")).view(f"S{4 * w}").ravel()
        order = np.argsort(keys, kind="stable")
        array, suffix = keys[order], suffix[order]
        for g in tests.groups:
            lo = np.searchsorted(array, g["low"], side="left")
            hi = np.searchsorted(array, g["high"], side="right")
            found = np.flatnonzero(hi > lo)
            if not len(found):
                continue
            count = (hi - lo)[found]
            window_of = np.repeat(found, count)
            pos = suffix[np.repeat(lo[found], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
            same = _equal_bytes(tests, g, low, starts, ends, pos, window_of)
            window_of, pos = window_of[same], pos[same]
            np.add.at(hit, pos, 1)
            np.add.at(hit, pos + g["size"], -1)
            _longest(tests, g, pos, window_of, row, first, n, best)
    return np.cumsum(hit[:-1]) > 0, best


def _equal_bytes(tests, g, low, starts, ends, pos, window_of) -> np.ndarray:
    """Compare the spelling of every word of a found window, so that equal hashes alone decide nothing."""
    same = np.ones(len(pos), bool)
    for k, (p, u) in enumerate(zip(pos, window_of, strict=True)):
        for d, word in enumerate(g["words"][u]):
            if tests.spelling[int(word)] != low[starts[p + d]:ends[p + d]].tobytes():
                same[k] = False
                break
    return same


def _longest(tests, g, pos, window_of, row, first, n, best, chunk: int = 1 << 18) -> None:
    """Follow every match along text and item; keep the longest of each (row, item), the first one of equals."""
    here = np.full(n + 1, -1, np.int64)
    here[pos] = window_of
    for a in range(0, len(pos), chunk):
        p, u = pos[a:a + chunk], window_of[a:a + chunk]
        count = (g["of"][u + 1] - g["of"][u])
        for b in range(0, int(count.max(initial=0))):  # the items that hold the window, one after another
            sel = count > b
            pp, k = p[sel], g["of"][u[sel]] + b
            q = g["at"][k]
            begins = (pp == first[row[pp]]) | (g["word"][k] == 0)
            begins |= here[pp - 1] != g["window_at"][q - 1]
            pp, k, q = pp[begins], k[begins], q[begins]
            extra, live = np.zeros(len(pp), np.int64), np.arange(len(pp))
            while len(live) and g["size"] == tests.window:
                np_, nq = pp[live] + extra[live] + 1, q[live] + extra[live] + 1
                inside = (np_ < first[row[pp[live]] + 1]) & (g["window_at"][nq] >= 0)
                inside &= here[np.minimum(np_, n)] == g["window_at"][nq]
                live = live[inside]
                extra[live] += 1
            for i in range(len(pp)):
                key = (int(row[pp[i]]), int(g["item"][k[i]]))
                value = (-(g["size"] + int(extra[i])), int(pp[i] - first[row[pp[i]]]), int(g["word"][k[i]]))
                if key not in best or value < best[key]:
                    best[key] = value


def _scan(tests: TestSuffixes, text_col: str, state_col: str, fresh: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text_col):
                low, starts, ends, first = words(*utf8(batch.column(text_col)), ALNUM)
                hit, best = _search(tests, low, starts, ends, first) if tests.shortest else (np.zeros(len(starts), bool), {})
                found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
                for (r, item), (size, at, word) in sorted(best.items()):
                    found[r].append({"item_id": tests.item_ids[item], "doc_word": at, "item_word": word, "n_words": -size})
                hits = np.flatnonzero(hit)
                cut = np.searchsorted(hits, first)
                states = []
                old = [None] * batch.num_rows if fresh else batch.column(state_col).to_pylist()
                for r in range(batch.num_rows):
                    mine = (hits[cut[r]:cut[r + 1]] - first[r]).tolist()
                    if old[r]:
                        mine = sorted({*mine, *old[r]["hits"]})
                        found[r] = old[r]["matches"] + found[r]
                    states.append({"n_words": int(first[r + 1] - first[r]), "hits": mine, "matches": found[r]})
                names = [c for c in batch.schema.names if c != state_col]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(states, _ARROW)],
                                                 names=names + [state_col])
    return run


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text", result: str = "contamination",
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` plus a struct ``result``: n_words, hits (covered word positions), matches (per item its longest
    verbatim match: item_id, doc_word, item_word, n_words; the first of equally long ones).

    Words are maximal runs of digits, letters and non-ASCII characters after lower-casing A-Z.  A window is
    ``window`` consecutive item words; a shorter item that has words is one window.  Null or empty texts have no
    words and hit nothing; items without words are ignored; a null item id reads as the empty string; equal
    rows of items count once, repeated documents are each treated as they stand.  A column of ``docs`` named like ``result`` is replaced;
    every other extra column passes through.
    """
    docs = docs.drop(result)
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"), F.col(item_text).alias("t")).distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // block_bytes))
    schema = T.StructType([*docs.schema.fields, T.StructField(result, _STATE)])
    out = docs
    for b in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        rows = part.orderBy("i", "t").toArrow()
        tests = TestSuffixes(rows.column("i").to_pylist(), rows.column("t").combine_chunks(), window)
        shared = docs.sparkSession.sparkContext.broadcast(tests)
        out = out.mapInArrow(_from(shared, text_col, result, b == 0), schema)
    return out


def _from(shared, text_col: str, result: str, fresh: bool):
    def run(batches):
        yield from _scan(shared.value, text_col, result, fresh)(batches)
    return run


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, result: str = "contamination", **options) -> DataFrame:
    """``docs`` without those that hold any benchmark window; the columns stay as they are."""
    found = matches(docs, benchmark, result=result, **options)
    return found.filter(F.size(F.col(f"`{result}`.hits")) == 0).select([F.col(f"`{c}`") for c in docs.columns if c != result])


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated, longest (words)."""
    found = matches(docs.select(F.col(id_col).alias("doc_id"), F.col(options.get("text_col", "text")).alias("text")),
                    benchmark, **{**options, "text_col": "text"})
    items = F.array_sort(F.array_distinct(F.col("contamination.matches.item_id")))
    hits = F.size("contamination.hits").cast("long")
    return found.select(
        "doc_id", F.col("contamination.n_words").alias("n_words"), hits.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.col("contamination.matches.n_words")), F.lit(0)).cast("long").alias("longest"))

