"""Personal data: fixed base rules, and a semi-Markov conditional random field that adds what the rules miss.

The field reads regions of blank-separated chunks around digits, ``@`` and bracketed ``at``.  A segment is up to ``LONGEST``
chunks; features of the whole segment (digit counts and groups, separators, checksum, leading and inner marks) score it
as one of the four kinds or, if it is a single chunk, as nothing.  Dynamic programming over all segmentations of a region
chooses boundaries and kinds jointly.  Its spans are added where they touch no base span.

The weights are the maximum of the conditional likelihood (forward-backward over segments, AdaGrad) on a bounded sample of
``FIT_ROWS`` documents, those with the smallest id hashes: base spans are the truth, and rewritten copies of them (other
separators and prefixes, ``(at)`` for ``@``) teach the field the forms that the rules do not know.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytescan import slices

KINDS = ("email", "ip", "card", "phone")
NOTHING = len(KINDS)
LONGEST = 6
LONGEST_CHUNK = 64
FIT_ROWS = 4000
FIT_REGIONS = 500
EPOCHS = 12

#: fixed values: the patterns of the base rules
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]++")
_TRIGGER = re.compile(r"[0-9@(\[]")
_BLANK = re.compile(r"\s")
_AT = re.compile(r"[(\[](?:at|AT)[)\]]")
_QUAD = re.compile(r"[0-9]++(?:\[?\.\]?[0-9]++){3}")
#: where an over-long chunk is split, each for what the one before leaves too long: quotes, fields and other scripts; paths and
#: operators; changes between digits and letters
_SPLITS = (re.compile(r"[^\s,;:\"'{}<>=|&\x80-\U0010ffff]++"), re.compile(r"[^/\\*#%!?$~^`]++"),
           re.compile(r"[0-9().\[\]+_-]++|[^0-9]++"))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str):
    at, free = text.find("@"), 0
    while at >= 0:
        start = free + len(text[free:at].rstrip(_LOCAL))
        host = _DOMAIN.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            free = host.end()
        at = text.find("@", max(at + 1, free))


def _addresses(text: str):
    """Four runs of digits joined by single dots; a run that begins no match cannot begin one further on."""
    run: list[tuple[int, int]] = []
    for m in _DIGITS.finditer(text):
        if run and (m.start() != run[-1][1] + 1 or text[run[-1][1]] != "."):
            run = []
        run.append(m.span())
        if len(run) == 4:
            if all(b - a <= 3 and int(text[a:b]) <= 255 or int(text[a:b].lstrip("0")[:4] or "0") <= 255 for a, b in run):
                yield run[0][0], run[3][1]
            run = []


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base rules: leftmost, non-overlapping in each kind, failing matches dropped."""
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, a, b) for a, b in _addresses(text)]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append((3, *m.span()))
    return out


def _pieces(text: str, a: int, b: int, level: int = 0):
    """A chunk, or what an over-long one is split into, where there is a trigger.  What has one class of characters
    and stays too long holds no value."""
    if b - a <= LONGEST_CHUNK:
        if _TRIGGER.search(text, a, b):
            yield a, b
    elif level < len(_SPLITS):
        for m in _SPLITS[level].finditer(text, a, b):
            yield from _pieces(text, *m.span(), level + 1)


def regions(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring chunks around triggers, with one chunk more on either side; over-long chunks are split."""
    out: list[list[tuple[int, int]]] = []
    pos, n = 0, len(text)
    while True:
        m = _TRIGGER.search(text, pos)
        if not m:
            break
        a = b = m.start()
        while a > pos and not text[a - 1].isspace():
            a -= 1
        end = _BLANK.search(text, b)
        b = end.start() if end else n
        pos = b
        for x, y in _pieces(text, a, b):
            if out and x - out[-1][-1][1] == 1 and text[x - 1].isspace():
                out[-1].append((x, y))
            else:
                out.append([(x, y)])
    full = []
    for r in out:
        whole = text[r[0][0]:r[-1][1]]
        if sum(map(str.isdecimal, whole)) < 7 and "@" not in whole and not _AT.search(whole) and not _QUAD.search(whole):
            continue
        left, right = r[0][0], r[-1][1]
        if left > 1 and text[left - 1].isspace() and not text[left - 2].isspace():
            a = left - 1
            while a > 0 and not text[a - 1].isspace() and left - a <= LONGEST_CHUNK:
                a -= 1
            r = [(a, left - 1), *r]
        if right + 1 < n and text[right].isspace() and not text[right + 1].isspace():
            end = _BLANK.search(text, right + 1, right + 1 + LONGEST_CHUNK)
            r = [*r, (right + 1, end.start() if end else min(n, right + 1 + LONGEST_CHUNK))]
        full.append(r)
    return full


def trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """A segment without the punctuation around it."""
    while b > a and text[b - 1] in ".,;:!?\"'":
        b -= 1
    while b > a and text[a] in ",;:!?\"'":
        a += 1
    if b > a and text[b - 1] in ")]" and text[b - 1] not in (")" if "(" in text[a:b] else "") + ("]" if "[" in text[a:b] else ""):
        b -= 1
    return a, b


_STEPS = (0, 3, 6, 8, 11, 12, 15, 16, 19)
N_FEATURES = 34


def features(s: str, chunks: int) -> np.ndarray:
    """What the whole segment looks like."""
    f = np.zeros(N_FEATURES)
    digits = "".join(c for c in s if "0" <= c <= "9")
    n = len(digits)
    f[0] = 1
    f[1 + sum(n > k for k in _STEPS)] = 1  # 1..10
    f[11 + min(chunks, 6) - 1] = 1  # 11..16
    groups = _DIGITS.findall(s)
    f[17 + min(len(groups), 5)] = 1  # 17..22
    rest = s.translate({i: None for i in range(48, 58)})
    letters = any(c.isalpha() for c in rest)
    f[23] = s[:1] == "+" or s[:2] == "00" or s[:1] == "("
    f[24] = s.count("@") == 1
    f[25] = bool(_AT.search(s))
    f[26] = letters and "." in s.replace("[.]", ".").split("@")[-1]
    f[27] = letters and n > 0
    f[28] = letters
    f[29] = n > 0 and not rest.strip(" -")
    f[30] = n > 0 and not rest.strip(" -().+")
    f[31] = 13 <= n <= 19 and luhn(digits)
    f[32] = len(groups) == 4 and rest.strip("[]") in ("...", ".][.][.") and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    f[33] = bool(s) and (s[-1].isalnum() and (s[0].isalnum() or s[0] in "+("))
    return f


class Field:
    """Weights (kinds and nothing, by feature) and the cost of a kind after another."""

    def __init__(self):
        self.w = np.zeros((NOTHING + 1, N_FEATURES))
        self.step = np.zeros((NOTHING + 1, NOTHING + 1))

    def table(self, text: str, chunks: list[tuple[int, int]]):
        """Segments as (first chunk, end chunk) and their features."""
        where = [(i, j) for j in range(1, len(chunks) + 1) for i in range(max(0, j - LONGEST), j)]
        spans = [trimmed(text, chunks[i][0], chunks[j - 1][1]) for i, j in where]
        return where, spans, np.array([features(text[a:b], j - i) for (i, j), (a, b) in zip(where, spans, strict=True)])

    def scores(self, where, f) -> np.ndarray:
        s = f @ self.w.T
        s[[j - i > 1 for i, j in where], NOTHING] = -np.inf
        return s

    def best(self, text: str, chunks: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """The most likely segmentation: its (kind, start, end)."""
        where, spans, f = self.table(text, chunks)
        s = self.scores(where, f)
        value = np.full((len(chunks) + 1, NOTHING + 1), -np.inf)
        value[0, NOTHING] = 0
        back = {}
        for k, (i, j) in enumerate(where):
            total = value[i][:, None] + self.step + s[k][None, :]
            before = total.argmax(axis=0)
            now = total[before, np.arange(NOTHING + 1)]
            for y in np.flatnonzero(now > value[j]).tolist():
                value[j, y] = now[y]
                back[j, y] = (k, int(before[y]))
        out, j, y = [], len(chunks), int(value[len(chunks)].argmax())
        while j:
            k, before = back[j, y]
            if y != NOTHING:
                out.append((y, *spans[k]))
            j, y = where[k][0], before
        return out[::-1]

    def gradient(self, where, f, truth: dict[tuple[int, int], int], n: int):
        """Of the log likelihood of one region, by forward and backward sums over segments."""
        s = self.scores(where, f)
        ahead = np.full((n + 1, NOTHING + 1), -np.inf)
        ahead[0, NOTHING] = 0
        behind = np.full((n + 1, NOTHING + 1), -np.inf)
        behind[n] = 0
        for k, (i, j) in enumerate(where):
            ahead[j] = np.logaddexp(ahead[j], np.logaddexp.reduce(ahead[i][:, None] + self.step, axis=0) + s[k])
        for k in range(len(where) - 1, -1, -1):
            i, j = where[k]
            behind[i] = np.logaddexp(behind[i], np.logaddexp.reduce(self.step + (s[k] + behind[j])[None, :], axis=1))
        z = np.logaddexp.reduce(ahead[n])
        gw, gs = np.zeros_like(self.w), np.zeros_like(self.step)
        for k, (i, j) in enumerate(where):
            p = np.exp(ahead[i][:, None] + self.step + (s[k] + behind[j])[None, :] - z)
            gw -= np.outer(p.sum(axis=0), f[k])
            gs -= p
            if (i, j) in truth:
                gw[truth[i, j]] += f[k]
        order = sorted(truth)
        for (_, before), (here, now) in zip([(None, NOTHING), *((x, truth[x]) for x in order)], [(x, truth[x]) for x in order], strict=False):
            gs[before, now] += 1
        return gw, gs


def gold(text: str, chunks: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> dict[tuple[int, int], int]:
    """The region's segmentation by the base spans; chunks outside them are nothing."""
    kind_of: dict[tuple[int, int], int] = {}
    used: set[int] = set()
    for kind, a, b in sorted(spans, key=lambda x: x[1]):
        own = [k for k, (x, y) in enumerate(chunks) if x < b and a < y]
        if own and len(own) <= LONGEST and not used & set(own):
            kind_of[own[0], own[-1] + 1] = kind
            used |= set(own)
    kind_of.update({(k, k + 1): NOTHING for k in range(len(chunks)) if k not in used})
    return kind_of


def rewritten(kind: int, s: str, pick: int) -> str:
    """The same value in a form the base rules do not know."""
    if kind == 0:
        return s.replace("@", ("(at)", " (at) ", "[at]", " @ ")[pick % 4])
    if kind == 1:
        return s.replace(".", "[.]")
    digits = "".join(c for c in s if c.isdigit())
    if kind == 2:
        return (".", "/", "_")[pick % 3].join(digits[i:i + 4] for i in range(0, len(digits), 4))
    return (f"00{digits[:2]} {digits[2:5]} {digits[5:]}", f"({digits[:3]}) {digits[3:6]}-{digits[6:]}", f"00{digits}")[pick % 3]


def examples(texts: list[str], limit: int = FIT_REGIONS):
    """(text, chunks, truth) of regions with base spans, their rewritten copies, and as many regions without."""
    good, plain = [], []
    for t in texts:
        spans = base_spans(t)
        for r in regions(t):
            a, b = r[0][0], r[-1][1]
            mine = [x for x in spans if x[1] >= a and x[2] <= b]
            if not mine:
                if len(plain) < limit:
                    plain.append((t[a:b], [(x - a, y - a) for x, y in r], []))
                continue
            if len(good) >= 2 * limit:
                continue
            local = [(k, x - a, y - a) for k, x, y in mine]
            good.append((t[a:b], [(x - a, y - a) for x, y in r], local))
            if len(mine) == 1:
                kind, x, y = local[0]
                new = rewritten(kind, t[a:b][x:y], len(good))
                text = t[a:b][:x] + new + t[a:b][y:]
                chunks = [m.span() for m in re.finditer(r"\S+", text)]
                good.append((text, chunks, [(kind, x, x + len(new))]))
    return [(t, c, gold(t, c, s)) for t, c, s in good + plain if len(c) <= 24]


def fit_field(texts: list[str], epochs: int = EPOCHS, rate: float = 0.5, ridge: float = 1e-4) -> Field:
    field = Field()
    data = []
    for t, c, truth in examples(texts):
        where, _, f = field.table(t, c)
        data.append((where, f, truth, len(c)))
    seen_w, seen_s = np.full_like(field.w, 1e-6), np.full_like(field.step, 1e-6)
    if not any(k != NOTHING for d in data for k in d[2].values()):
        field.w[NOTHING, 0] = 10.0  # nothing to learn from: nothing is added
        return field
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(data)):
            gw, gs = field.gradient(*data[k])
            gw -= ridge * field.w
            seen_w += gw ** 2
            seen_s += gs ** 2
            field.w += rate * gw / np.sqrt(seen_w)
            field.step += rate * gs / np.sqrt(seen_s)
    return field


def all_spans(field: Field, text: str, base: list[tuple[int, int, int]] | None = None) -> list[tuple[int, int, int]]:
    """Base spans and the field's spans that touch none of them, by kind and start."""
    base = base_spans(text) if base is None else base
    if not _TRIGGER.search(text):
        return base
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    reach = np.maximum.accumulate([b for _, b in taken]).tolist() if taken else []
    added = []
    for r in regions(text):
        for kind, a, b in field.best(text, r):
            k = np.searchsorted(starts, b)
            if b > a and (k == 0 or reach[k - 1] <= a):
                added.append((kind, a, b))
    return sorted(base + added)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                   T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = FIT_ROWS) -> Field:
    """Learn the field on the ``rows`` documents with the smallest id hashes among those with a digit or ``@``."""
    sample = (docs.filter(F.col(f"`{text_col}`").rlike("[0-9@]")).select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"))
              .orderBy(F.xxhash64("i"), F.xxhash64("t")).limit(rows)
              # only the stretches around triggers travel
              .mapInArrow(_snippets, "t string"))
    return fit_field(sorted(sample.toArrow()["t"].to_pylist()))


def _snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for t in b.column("t").to_pylist():
            out += [t[max(0, r[0][0] - 1):r[-1][1] + 1] for r in regions(t)[:50]]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["t"])


def find_spans(docs: DataFrame, field: Field, text_col: str = "text", result: str = "pii") -> DataFrame:
    """``docs`` with ``result`` (replacing a column of that name): an array of (kind, start, end, base), by kind as in KINDS, then
    start; code points, end exclusive.  Null and empty texts have no spans."""
    docs = docs.drop(result)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, text_col, 8 << 20):
                out = []
                for t in b.column(text_col).to_pylist():
                    base = base_spans(t) if t else []
                    sure = set(base)
                    out.append([{"kind": KINDS[k], "start": a, "end": e, "base": (k, a, e) in sure}
                                for k, a, e in (all_spans(shared.value, t, base) if t else [])])
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, kind)], names=[*b.schema.names, result])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(result, _SPANS)]))


def _of_kind(spans, kind: str):
    return F.filter(spans, lambda x: x["kind"] == kind)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all)."""
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = find_spans(narrow, fit(narrow, "doc_id")).select("doc_id", "pii")
    base = F.filter("pii", lambda x: x["base"])
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return found.select(
        "doc_id", *[F.size(_of_kind(base, k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("pii")).alias("spans"))
