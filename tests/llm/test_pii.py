import random
import re

import pytest

from cellgrid.llm import pii as P


def brute(t):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and P.luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_rules_equal_the_plain_patterns():
    rnd = random.Random(2)
    for _ in range(30_000):
        a = rnd.choice(["a@b.c-_ ", "0123.5 ", "012 -", "+01 ().-2", "12.@+a 300000255"])
        s = "".join(rnd.choice(a) for _ in range(rnd.randrange(0, 40)))
        assert P.base_spans(s) == brute(s)


def test_long_runs_stay_fast():
    for s in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "@" * 100_000, "+" * 100_000, "1 " * 100_000):
        P.base_spans(s)
        P.regions(s)


@pytest.fixture(scope="module")
def field():
    rnd, texts = random.Random(0), []
    for _ in range(250):
        d = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
        card = next(x for x in iter(lambda: "4" + d(15), None) if P.luhn(x))
        texts.append(rnd.choice([f"mail bob{d(2)}@mail{d(1)}.example.com now", f"from {rnd.randrange(256)}.{rnd.randrange(256)}.1.{rnd.randrange(256)} by",
                                 f"card {card} ok", f"call +1 ({d(3)}) 555-{d(4)} soon", f"order {d(8)} of {d(4)}", f"hash {d(4)}a{d(9)}f done"]))
    return P.fit_field(texts)


def test_field_adds_forms_that_the_rules_miss_and_keeps_the_base(field):
    s = "card 4111.1111.1111.1111 and +1 (555) 555-1234 ok"
    spans = P.all_spans(field, s)
    assert set(P.base_spans(s)) <= set(spans)
    assert (2, 5, 24) in spans
    assert P.all_spans(field, "in 1999 there were 12 of 300") == []


def test_best_segmentation_is_the_maximum_over_all(field):
    import itertools
    text = "call (555) 123-4567 or 4111.1111.1111.1111"
    chunks = [m.span() for m in re.finditer(r"\S+", text)]
    where, spans, f = field.table(text, chunks)
    s = {w: r for w, r in zip(where, field.scores(where, f))}

    def total(cuts):
        parts = list(zip([0, *cuts], [*cuts, len(chunks)]))
        best = -1e18
        for kinds in itertools.product(range(5), repeat=len(parts)):
            score, before = 0.0, P.NOTHING
            for p, k in zip(parts, kinds):
                score += field.step[before, k] + s[p][k]
                before = k
            best = max(best, score)
        return best
    n = len(chunks)
    top = max(total(c) for r in range(n) for c in itertools.combinations(range(1, n), r))
    got, at, before = 0.0, 0, P.NOTHING
    found = {(a, b): k for k, a, b in field.best(text, chunks)}
    by_span = {x: w for w, x in zip(where, spans)}
    used = {by_span[x]: k for x, k in found.items()}
    while at < n:
        part = next(((i, j) for i, j in used if i == at), (at, at + 1))
        k = used.get(part, P.NOTHING)
        got += field.step[before, k] + s[part][k]
        at, before = part[1], k
    assert got == pytest.approx(top)


def test_gradient_matches_differences():
    field, rng = P.Field(), __import__("numpy").random.default_rng(1)
    field.w, field.step = rng.normal(size=field.w.shape) / 5, rng.normal(size=field.step.shape) / 5
    text = "call +1 555 1234567 now"
    chunks = [m.span() for m in re.finditer(r"\S+", text)]
    where, _, f = field.table(text, chunks)
    truth = P.gold(text, chunks, P.base_spans(text))
    import numpy as np

    def likelihood():
        s = field.scores(where, f)
        ahead = np.full((len(chunks) + 1, 5), -np.inf)
        ahead[0, P.NOTHING] = 0
        for k, (i, j) in enumerate(where):
            ahead[j] = np.logaddexp(ahead[j], np.logaddexp.reduce(ahead[i][:, None] + field.step, axis=0) + s[k])
        score, before = 0.0, P.NOTHING
        for x in sorted(truth):
            score += field.step[before, truth[x]] + s[where.index(x), truth[x]]
            before = truth[x]
        return score - np.logaddexp.reduce(ahead[-1])
    gw, gs = field.gradient(where, f, truth, len(chunks))
    for table, grad, at in ((field.w, gw, (3, 0)), (field.w, gw, (4, 1)), (field.step, gs, (4, 3)), (field.step, gs, (4, 4))):
        table[at] += 1e-5
        up = likelihood()
        table[at] -= 2e-5
        down = likelihood()
        table[at] += 1e-5
        assert grad[at] == pytest.approx((up - down) / 2e-5, abs=1e-4)


def test_report_over_odd_rows(odd_docs, no_docs):
    out = P.report(odd_docs).collect()
    assert len(out) == 9 and all(r.n_email == 0 and r.spans == "" for r in out)
    assert P.report(no_docs).count() == 0


def test_report_counts_base_spans_by_kind(spark):
    import hashlib
    texts = {1: "a@b.co and c.d@e.org from 10.0.0.1", 2: "card 4111 1111 1111 1111, call +1 555 123 4567", 3: "none"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = {r.doc_id: r for r in P.report(docs).collect()}
    for i, t in texts.items():
        base = sorted(brute(t))
        assert [out[i][f"n_{k}"] for k in P.KINDS] == [sum(b[0] == j for b in base) for j in range(4)]
        joined = ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert out[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(out[i].spans.split(","))


def test_values_in_long_chunks_and_short_masked_addresses_are_scored(field):
    json = '{"id":"a1b2","name":"' + "x" * 50 + '","tel":"0031205551234","mail":"bob12(at)mail1.example.com"}'
    han = "\u4f60\u597d" * 40 + "bob12(at)mail1.example.com" + "\u4e16\u754c" * 40
    csv = ",".join(["field"] * 14 + ["4111.1111.1111.1111"] + ["other"] * 14)
    for text, value in ((json, "bob12(at)mail1.example.com"), (han, "bob12(at)mail1.example.com"), (csv, "4111.1111.1111.1111")):
        assert any(text[a:b] == value for r in P.regions(text) for a, b in r)
        assert value in [text[a:b] for _, a, b in P.all_spans(field, text)]
    assert P.all_spans(field, "to bob12(at)mail1.example.com now") == [(0, 3, 29)]
    for text in ("see 8[.]8[.]8[.]8 there", "see 1.1.1[.]1 there"):
        assert any(_ for _ in P.regions(text))
    assert not P.regions("in 2024 and 12.5 there")
