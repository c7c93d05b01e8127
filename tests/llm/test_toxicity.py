import random

import numpy as np
import pyarrow as pa
import pytest

from cellgrid.llm import toxicity as X


def _corpus(n=900):
    rnd = random.Random(3)
    plain, bad = [f"word{i}" for i in range(400)], ["nasty", "vile", "horrid"]
    rows, labels = [], []
    for d in range(n):
        toxic = d % 5 == 0
        w = rnd.choices(plain, k=rnd.choice([15, 60, 300]))
        for _ in range(max(1, len(w) // 30) if toxic else 0):
            w[rnd.randrange(len(w))] = rnd.choice(bad)
        rows.append((d, " ".join(w), "en"))
        labels.append((d, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = _corpus()
    return (spark.createDataFrame(rows, "doc_id long, text string, score string"),
            spark.createDataFrame(labels + [(5, 1, None), (None, 1, 1), (7, 0, 0)], "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(tables):
    docs, labels = tables
    out = X.report(docs, labels).toPandas().set_index("doc_id")
    truth = out.index % 5 == 0
    held = out.held_out.to_numpy()
    predicted = out.predicted.to_numpy() == 1
    assert held.sum() > 200
    assert (predicted & ~truth & held).sum() <= 2
    assert (predicted & truth & held).sum() >= 0.9 * (truth & held).sum()
    assert out.score.between(0, 1).all()


def test_evidence_ignores_what_either_class_does_not_know():
    m = X.KneserNey()
    x, n = X.evidence(m, pa.array(["a b c", "", None, "!!"]))
    assert not x.any() and n.tolist() == [3, 0, 0, 0]


def test_curve_rises_with_evidence():
    m = X.KneserNey()
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, .01, 400), rng.normal(.1, .02, 60)])
    X._fit_curve(m, X._features(np.column_stack([x, -x]), np.full(460, 50)), np.repeat([0.0, 1.0], [400, 60]))
    assert (m.curve[:-1] >= 0).all() and m.curve[[0, 2]].max() > 0 and not m.curve[[1, 3]].any()


def test_removal_odd_rows_and_missing_labels(spark, tables, odd_docs, no_docs):
    docs, labels = tables
    model = X.fit(docs, labels)
    left = X.remove_toxic(docs, model)
    assert left.columns == docs.columns and 700 <= left.count() <= 750
    assert X.remove_toxic(odd_docs, model).count() == 9
    assert X.report(no_docs, labels).count() == 0
    blank = X.report(odd_docs, labels.limit(0)).collect()
    assert len(blank) == 9 and {r.score for r in blank} == {0.5}


def test_expressions_of_ordinary_words_count(spark):
    rnd = random.Random(4)
    rows, labels = [], []
    for d in range(1500):
        toxic, w = d % 4 == 0, rnd.choices([f"word{i}" for i in range(60)], k=60)
        for _ in range(4):  # the two words stand together in toxic texts and apart in the others
            a, b = rnd.sample(range(58), 2)
            if toxic:
                w[a:a + 2] = ["blue", "garden"]
            else:
                w[a], w[b] = "blue", "garden"
        if not toxic:
            w = [x if (x, y) != ("blue", "garden") else "word0" for x, y in zip(w, [*w[1:], ""])]
        rows.append((d, " ".join(w)))
        labels.append((d, int(toxic)))
    docs, truth = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = X.report(docs, truth).filter("held_out").toPandas()
    toxic = out.doc_id % 4 == 0
    assert ((out.predicted == 1) == toxic).mean() > 0.95
    m = X.fit(docs, truth)
    x, n = X.evidence(m, pa.array([t for _, t in rows[:20]]))
    by_join = X._with_evidence(docs.limit(20), m).select("row.doc_id", "x0", "x1", "n").toPandas().sort_values("doc_id")
    assert np.allclose(x, by_join[["x0", "x1"]]) and n.tolist() == by_join.n.tolist()


def test_discount_does_not_grow_with_the_corpus(spark):
    common = spark.range(8_000_000).selectExpr("shiftleft(1000000L + id div 8000, 32) | (id % 8000) AS key", "1L AS k0", "1L AS k1")
    rare = spark.range(6).selectExpr("shiftleft(5L, 32) | (100000 + id) AS key", "0L AS k0", "1L AS k1")  # six predecessors in toxic texts
    m = X._of_pairs(common.unionByName(rare))
    assert m.entries.filter(f"key = {X.entry_keys(0, np.array([5]))[0]}").first().word > 0


def plain_model(rows):
    """The two interpolated models on Python counters: log ratio of word and pair parts by key, before and after the margin."""
    import math
    from collections import Counter

    from plain import tokens
    pairs = [Counter(), Counter()]
    for text, toxic in rows:
        w = tokens(text)
        pairs[toxic].update(set(zip(["", *w], w)))
    kinds = [Counter(w for _, w in p) for p in pairs]
    either = Counter(w for _, w in set(pairs[0]) | set(pairs[1]))
    size, seen = [sum(k.values()) for k in kinds], [sum(p.values()) for p in pairs]
    rate, least = X.RARE / min(size), X.RARE / min(seen)
    own = [{w: max(k - rate * size[c], 0) / size[c] for w, k in kinds[c].items()} for c in range(2)]
    rest = [1 - sum(o.values()) for o in own]
    p = {w: [own[c].get(w, 0) + rest[c] * e / sum(either.values()) for c in range(2)] for w, e in either.items()}
    follows = [Counter(), Counter()]
    for c in range(2):
        for (v, _), k in pairs[c].items():
            follows[c][v] += k
    often = {e for c in range(2) for e, k in pairs[c].items() if k > least * seen[c]}
    share = {e: [max(pairs[c][e] - least * seen[c], 0) / max(follows[c][e[0]], 1) for c in range(2)] for e in often}
    left = {v: [1 - sum(o[c] for e, o in share.items() if e[0] == v) for c in range(2)] for v, _ in often}
    beyond = lambda g: math.copysign(max(abs(g) - X.MARGIN, 0), g)
    word = {w: beyond(math.log(q[1] / q[0])) for w, q in p.items()}
    context = {v: beyond(math.log(r[1]) - math.log(r[0])) for v, r in left.items()}
    pair = {(v, w): beyond(math.log(o[1] / p[w][1] + left[v][1]) - math.log(o[0] / p[w][0] + left[v][0])) - context[v] for (v, w), o in share.items()}
    return word, context, pair


def test_evidence_equals_plain_kneser_ney(spark):
    from plain import tokens
    rnd = random.Random(9)
    rows = [(" ".join(rnd.choices([f"w{i}" for i in range(12)] + ["bad"] * (4 * y) + ["sad"], k=rnd.randint(0, 25))), y) for y in (0, 1) for _ in range(60)]
    table = spark.createDataFrame([(t, y) for t, y in rows], "text string, place byte")
    m = X._of_pairs(table.mapInArrow(X._pairs, "key long, k0 long, k1 long, k2 long, k3 long").groupBy("key").agg({"k0": "sum", "k1": "sum"})
                    .withColumnsRenamed({"sum(k0)": "k0", "sum(k1)": "k1"}))
    word, context, pair = plain_model(rows)
    texts = [t for t, _ in rows[::7]]
    x, n = X.evidence(m, pa.array(texts))
    for t, got in zip(texts, x, strict=True):
        w = tokens(t)
        want = [sum(word[a] for a in w), sum(context.get(v, 0) + pair.get((v, a), 0) for v, a in zip(["", *w], w))]
        assert got == pytest.approx(np.array(want) / max(len(w), 1), abs=1e-9)
    assert any(word.values()) and any(pair.values())


def test_columns_of_any_name_stay(spark, tables):
    docs, labels = tables
    model = X.fit(docs, labels)
    odd = docs.select("doc_id", "text", *[docs.score.alias(c) for c in ("a", "b", "n", "x0", "x1", "row", "_a", "_b", "_n", "_s", "_x", "_text", "toxicity")])
    out = X.score(odd, model)
    assert out.columns == [*[c for c in odd.columns if c != "toxicity"], "toxicity"]
    assert out.filter("row = 'en' AND _text = 'en' AND n = 'en'").count() == odd.count()
    assert X.remove_toxic(odd, X.KneserNey()).columns == odd.columns


def test_small_differences_of_many_words_count(spark):
    rnd, vocabulary = random.Random(5), [f"word{i}" for i in range(2000)]
    often = [[1 + (i + toxic) % 2 for i in range(2000)] for toxic in (0, 1)]  # each word is twice as frequent in one class
    rows = [(d, " ".join(rnd.choices(vocabulary, often[d % 4 == 0], k=80)), int(d % 4 == 0)) for d in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    m = X.fit(docs, docs)
    strong, _ = X.evidence(m, pa.array([t for _, t, _ in rows]))
    faint, n = X._faint(m.faint, pa.array([t for _, t, _ in rows]))
    assert np.abs(strong).sum() < 0.05 * np.abs(faint / n[:, None]).sum()
    out = X.report(docs, docs).filter("held_out").toPandas()
    assert ((out.predicted == 1) == (out.doc_id % 4 == 0)).mean() > 0.95
