import hashlib
import random

import pytest
from plain import lines_without_repeats

from cellgrid.llm import line_dedup as L


def _line(k):
    return " ".join(f"w{k}x{i}" for i in range(15))


def test_shared_passage_goes_everywhere_but_first(spark):
    passage = [_line(f"p{i}") for i in range(4)]
    rows = [(d, "\n".join([_line(f"a{d}"), *passage, _line(f"b{d}")]), "x") for d in range(1, 6)]
    rows.append((9, "\n".join(_line(f"u{i}") for i in range(6)), "x"))
    out = {r.doc_id: r for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, n_lines string"), keep_counts=True).collect()}
    assert out[1].n_removed == 0 and out[9].n_removed == 0
    for d in range(2, 6):
        assert out[d].n_removed == 4 and out[d].text == "\n".join([_line(f"a{d}"), _line(f"b{d}")])


def test_short_chunks_and_single_short_lines_stay_long_lines_go(spark):
    long_line = " ".join(f"z{i}" for i in range(60))
    rows = [(1, "a b\nc d\n" + _line("q"), ""), (2, "a b\nc d\n" + _line("r"), ""), (3, _line("s") + "\n" + long_line, ""), (4, long_line + "\n" + _line("t"), "")]
    out = {r.doc_id: r for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, e string"), keep_counts=True).collect()}
    assert out[1].n_removed == out[2].n_removed == out[3].n_removed == 0
    assert out[4].text == _line("t")


def test_copies_keep_their_first_and_equal_rows_are_one_document(spark):
    text = "\n".join(_line(i) for i in range(30))
    rows = [(3, text), (3, text), (5, text), (None, text)]
    out = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), keep_counts=True).collect()
    gone = sorted((r.doc_id is not None, r.doc_id or 0, r.n_removed) for r in out)
    # null ids order first, so theirs is the first occurrence; cuts leave at most single lines behind
    assert gone[0] == (False, 0, 0)
    assert all(g[2] >= 26 for g in gone[1:]) and gone[1] == gone[2]


def test_odd_rows_and_empty_table(odd_docs, no_docs):
    rows = L.dedup_lines(odd_docs).collect()
    assert len(rows) == 9 and L.dedup_lines(odd_docs).columns == odd_docs.columns
    assert L.dedup_lines(no_docs).count() == 0
    assert hashlib.sha256(b"").hexdigest()


def _rest(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r.text.split("\n") for r in L.dedup_lines(docs).collect()}


def test_passages_of_short_lines_go_whole(spark):
    passage = {k: [f"p{k}l{i} a{k} b{i} c" for i in range(15)] for k in range(20)}
    rows = [(10 * k + d, "\n".join([_line(f"a{k}d{d}"), *lines, _line(f"b{k}d{d}")])) for k, lines in passage.items() for d in range(5)]
    rest = _rest(spark, rows)
    for k, lines in passage.items():
        assert rest[10 * k][1:-1] == lines
        assert all(rest[10 * k + d] == [_line(f"a{k}d{d}"), _line(f"b{k}d{d}")] for d in range(1, 5))


def test_passage_of_copied_documents_goes_from_the_other_one(spark):
    rows, others = [], []
    for k in range(20):
        passage = [f"p{k}l{i} " + " ".join(f"x{i}{j}" for j in range(11)) for i in range(6)]
        copy = "\n".join([_line(f"a{k}"), _line(f"b{k}"), *passage, _line(f"c{k}"), _line(f"d{k}")])
        rows += [(100 * k + d, copy) for d in range(2 + k % 3)]
        others.append((100 * k + 50, "\n".join([_line(f"e{k}"), *passage, _line(f"f{k}")])))
    rest = _rest(spark, rows + others)
    for k, (d, _) in enumerate(others):
        assert rest[d] == [_line(f"e{k}"), _line(f"f{k}")]
        assert len(rest[100 * k]) == 10 and all(rest[100 * k + c] == [""] for c in range(1, 2 + k % 3))


def test_repeats_inside_a_document_and_lines_where_passages_meet(spark):
    x, y, z = _line("x"), _line("y"), _line("z")
    rest = _rest(spark, [(1, "\n".join([x, y, z])), (2, "\n".join([_line("a"), x, y])), (3, "\n".join([y, z, _line("b")])), (4, "ab cd\n" * 30)])
    assert rest == {1: [x, y, z], 2: [_line("a")], 3: [_line("b")], 4: ["ab cd", "ab cd", ""]}


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_version(spark, seed):
    pick = random.Random(seed)
    stock = [" ".join(f"s{k}" for _ in range(pick.choice([1, 3, 6, 12, 60]))) + f" {k}" for k in range(60)]
    docs = []
    for d in range(60):
        lines = []
        while len(lines) < pick.randrange(1, 40):
            a = pick.randrange(60)
            lines += stock[a:a + pick.randrange(1, 12)] if pick.random() < 0.7 else [_line(f"{d}n{len(lines)}")]
        docs.append((d, "\n".join(lines)))
    docs += [(100 + k, docs[pick.randrange(60)][1]) for k in range(10)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.text.split("\n") if r.n_removed < r.n_lines else []) for r in L.dedup_lines(rows, keep_counts=True).collect()}
    assert got == lines_without_repeats(docs)
