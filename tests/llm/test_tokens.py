import random

import pyarrow as pa
import pytest

from cellgrid.llm import pieces, sentencepiece_codec, token_count

ALPHABETS = ["ab c", "the of and ing er st ▁ \n", "aaaa  b", "éüñ世界 \t\x00😀x", "</s> <unk>[INST] 0123456789.,  "]


@pytest.fixture(scope="module")
def library(model_file):
    return pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=model_file)


@pytest.fixture(scope="module")
def model(model_file):
    return pieces.compile_model(model_file)


def _texts(n, size=40):
    rnd = random.Random(7)
    return ["".join(rnd.choice(a) for _ in range(rnd.randrange(0, size))) for a in ALPHABETS for _ in range(n)]


def test_counts_equal_the_library_for_any_chunking(model, library):
    t, rnd = token_count.Transducer(model), random.Random(1)
    for s in _texts(1500, 30) + ["a" + " " * n + "b" for n in range(60)]:
        want = len(library.encode(s))
        assert token_count.count_text(t, s) == want
        assert token_count.count_text(t, s, chunk=rnd.choice([1, 2, 3, 5, 8])) == want


def test_chunk_maps_compose_associatively(model):
    t, rnd = token_count.Transducer(model), random.Random(2)
    for s in _texts(200):
        cut = sorted(rnd.randrange(0, len(s) + 2) for _ in range(2))
        a, b, c = (token_count.chunk_map(t, x) for x in ((" " + s)[:cut[0]], (" " + s)[cut[0]:cut[1]], (" " + s)[cut[1]:]))
        left = token_count.compose(t, token_count.compose(t, a, b), c)
        assert left == token_count.compose(t, a, token_count.compose(t, b, c))


def test_batches_and_dropped_states(model, library, monkeypatch):
    monkeypatch.setattr(token_count, "MAX_STATES", 50)
    monkeypatch.setattr(token_count, "MAX_UNITS", 20)
    monkeypatch.setattr(token_count, "CHUNK", 25)
    t = token_count.Transducer(model)
    texts = _texts(300) + [None, "", " ", "\n", "  ", "x" * 100]
    for i in range(0, len(texts), 97):
        part = texts[i:i + 97]
        assert token_count.count_batch(t, pa.array(part, pa.string())) == [len(library.encode(x or "")) for x in part]


def test_encode_and_decode_equal_the_library(model, library):
    codec = sentencepiece_codec.Codec(model)
    texts = _texts(1500, 60) + ["", None, "a" * 500, "x y" * 400, " ", "  "]
    ids, offsets = codec.encode(pa.array(texts))
    back = codec.decode(ids, offsets)
    for i, s in enumerate(texts):
        want = library.encode(s or "")
        assert ids[offsets[i]:offsets[i + 1]].tolist() == want
        assert back[i] == library.decode(want)


def test_encode_takes_little_text_at_a_time(model, library):
    codec, texts = sentencepiece_codec.Codec(model), ["the old ferry ran late " * 9000 for _ in range(15)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(15)), "text": texts})
    assert batch.column("text").nbytes > 3_000_000
    out = list(sentencepiece_codec._with_ids(iter([batch]), codec, "text", "ids"))
    assert max(sum(map(len, b.column("text").to_pylist())) for b in out) <= 2 << 20
    got = pa.Table.from_batches(out)
    assert got.column("doc_id").to_pylist() == list(range(15)) and got.column("text").to_pylist() == texts
    want = library.encode(texts[0])
    assert all(ids == want for ids in got.column("ids").to_pylist())


def test_pair_table_equals_plain_merging(model):
    table, rnd = sentencepiece_codec.PairTable(model), random.Random(4)
    import numpy as np
    words = [i for p, i in model.ids.items() if "▁" not in p]
    a, b = np.array(rnd.choices(words, k=3000)), np.array(rnd.choices(words, k=3000))
    assert table.apart(a, b).tolist() == [model.may_follow(int(x), int(y)) for x, y in zip(a, b)]


def test_queries_over_odd_rows(spark, odd_docs, no_docs, model_file, library):
    counts = token_count.count_tokens(odd_docs, model_file).collect()
    texts = [r.text for r in odd_docs.collect()]
    assert sorted(r.n_tokens for r in counts) == sorted(len(library.encode(x or "")) for x in texts)
    assert sum(r.over_limit for r in counts) == 1
    encoded = sentencepiece_codec.encode(odd_docs, model_file)
    decoded = sentencepiece_codec.decode(encoded, model_file).collect()
    assert all(r.decoded == (r.text or "") for r in decoded)
    assert all(r.round_trip for r in sentencepiece_codec.report(odd_docs, model_file).collect())
    assert token_count.count_tokens(no_docs, model_file).count() == 0 and sentencepiece_codec.encode(no_docs, model_file).count() == 0
