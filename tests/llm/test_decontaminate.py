import random

import pyarrow as pa
from plain import tokens

from cellgrid.llm import decontaminate as D

def test_search_equals_brute_force():
    rnd = random.Random(3)
    for _ in range(300):
        n, letters = rnd.choice([2, 3, 4]), "a b c é".split()[:rnd.choice([1, 2, 4])]
        make = lambda m: None if rnd.random() < .1 else " ".join(rnd.choice(letters) for _ in range(rnd.randrange(0, m)))
        items, docs = [make(8) for _ in range(rnd.randrange(0, 5))], [make(20) for _ in range(rnd.randrange(0, 5))]
        tests = D.TestSuffixes([f"i{k}" for k in range(len(items))], pa.array(items, pa.string()), n)
        batch = pa.RecordBatch.from_arrays([pa.array(docs, pa.string())], names=["text"])
        out = [x for o in D._scan(tests, "text", "r", True)([batch]) for x in o.column("r").to_pylist()]
        assert len(out) == len(docs)
        for doc, got in zip(docs, out):
            w, hit, longest = tokens(doc), set(), {}
            for k, item in enumerate(items):
                iw = tokens(item)
                size = min(n, len(iw))
                for q in (range(len(iw) - n + 1) if len(iw) >= n else [0] if size else []):
                    for p in range(len(w) - size + 1):
                        if w[p:p + size] == iw[q:q + size]:
                            hit |= set(range(p, p + size))
                            m = size
                            while len(iw) >= n and p + m < len(w) and q + m < len(iw) and w[p + m] == iw[q + m]:
                                m += 1
                            longest[f"i{k}"] = max(longest.get(f"i{k}", 0), m)
            assert got["n_words"] == len(w) and got["hits"] == sorted(hit)
            assert {m["item_id"]: m["n_words"] for m in got["matches"]} == longest
            for m in got["matches"]:
                iw = tokens(items[int(m["item_id"][1:])])
                assert w[m["doc_word"]:m["doc_word"] + m["n_words"]] == iw[m["item_word"]:m["item_word"] + m["n_words"]]


def _benchmark(spark):
    rows = [(10, "one two three four five six seven eight nine ten eleven"), (9, "Short item"), (9, "Short item"), (None, None), (8, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_blocks_give_the_same_as_one_block(spark):
    docs = spark.createDataFrame([(1, "x ONE two, three four five six seven eight nine ten eleven y short item"), (2, "short-item"), (3, "nothing")],
                                 "doc_id long, text string")
    one = D.report(docs, _benchmark(spark)).orderBy("doc_id").collect()
    many = D.report(docs, _benchmark(spark), block_bytes=20).orderBy("doc_id").collect()
    assert one == many
    assert [(r.n_words, r.n_hit, r.n_items, r.contaminated, r.longest) for r in one] == [(15, 13, 2, True, 11), (2, 2, 1, True, 2), (1, 0, 0, False, 0)]


def test_odd_rows_and_removal(spark, odd_docs, no_docs):
    found = D.report(odd_docs, _benchmark(spark)).collect()
    assert len(found) == 9 and not any(r.contaminated for r in found)
    clean = D.remove_contaminated(odd_docs, _benchmark(spark))
    assert clean.columns == odd_docs.columns and clean.count() == 9
    assert D.report(no_docs, _benchmark(spark)).count() == 0
    assert D.report(odd_docs, _benchmark(spark).limit(0)).filter("contaminated").count() == 0


def test_equal_benchmark_rows_are_one_item(spark):
    bench = spark.createDataFrame([("i1", "one two three four")] * 300 + [("i2", "five six seven")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "x one two three four y five six seven")], "doc_id long, text string")
    found = D.matches(docs, bench, window=3, block_bytes=64).first().contamination
    assert [(m.item_id, m.n_words) for m in sorted(found.matches, key=lambda m: m.item_id)] == [("i1", 4), ("i2", 3)]
    assert list(found.hits) == [1, 2, 3, 4, 6, 7, 8]
