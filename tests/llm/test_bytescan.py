"""Vectorised scanning equals plain Python on random texts."""

import random
import re

import pyarrow as pa

from cellgrid.llm import bytescan as B

LOWER = {c: c + 32 for c in range(65, 91)}


def test_words_lines_and_hashes_equal_plain_python():
    rnd = random.Random(1)
    for _ in range(150):
        texts = ["".join(rnd.choice("aB9 \n\x00.é世\t_") for _ in range(rnd.choice([0, 1, 3, 10, 40]))) if rnd.random() > .1 else None
                 for _ in range(rnd.randrange(0, 8))]
        data, offsets = B.utf8(pa.array(texts, pa.string()))
        for lut, pattern in ((B.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (B.SPACED, r"[^\x20\x09-\x0D]+")):
            low, s, e, f = B.words(data, offsets, lut)
            for i, t in enumerate(texts):
                got = [bytes(low[a:b]) for a, b in zip(s[f[i]:f[i + 1]], e[f[i]:f[i + 1]])]
                assert got == [w.encode().replace(b"\0", b"\xff") for w in re.findall(pattern, (t or "").translate(LOWER))]
            seen = {}
            for a, b, h in zip(s, e, B.range_hashes(low, s, e)):
                assert seen.setdefault(bytes(low[a:b]), h) == h
            assert len(set(seen.values())) == len(seen)
        s, e, f = B.lines(data, offsets)
        for i, t in enumerate(texts):
            got = [bytes(data[a:b]).decode() for a, b in zip(s[f[i]:f[i + 1]], e[f[i]:f[i + 1]])]
            assert got == (t.split("\n") if t else [])


def test_slices_keep_rows_in_order_and_split_large_batches():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 50, None, "b" * 120, "c"])], names=["text"])
    parts = list(B.slices(batch, "text", 60))
    assert [p.num_rows for p in parts] == [2, 1, 1]
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()


def test_hash_over_several_blocks():
    data = pa.array(["x" * 200_000 + " tail", "tail"])
    low, s, e, f = B.words(*B.utf8(data), B.ALNUM)
    h = B.range_hashes(low, s, e)
    assert h[1] == h[2] != h[0]
