"""Licence statements: identifier tags, notice phrases, and the licence expressions behind the tags.

One Aho-Corasick automaton over words finds every place of every phrase and tag in a single pass over a batch of texts.  Words
are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; the words of a batch are laid out in one buffer with single blanks
between them and a line break between texts, so a pattern ``" w1 w2 "`` stands exactly where these words are consecutive words of
one text.  Places may overlap.

Behind a tag (``SPDX-License-Identifier:``, ``License-Expression:``, ``License:`` and the like) the original text is read on as a
licence expression: identifiers, ``AND``, ``OR``, ``WITH`` and parentheses, in either case.  A shunting-yard parser
with an operator and a value stack (no recursion, so nesting may be as deep as the text allows) evaluates it: ``AND``
takes the stricter terms of the two sides, ``OR`` the milder (the recipient chooses), ``WITH`` softens copyleft if the
exception permits linking.  The expression ends where the grammar allows no further token, so prose after it is not part of it.  One
that does not parse gives the label ``invalid``; an identifier of no known family gives ``unknown``.  ``License:`` alone is
an everyday word, so what follows it counts only if it parses and all its identifiers are known.

Work is one narrow pass: no shuffle, nothing collected; a task holds one slice of a batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytescan import ALNUM, slices, utf8, words

#: The base phrases, as words, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notice phrases, as words, and their labels.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "apache license": "apache",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "permission to use copy modify and or distribute this software": "isc",
    "zlib license": "zlib",
    "boost software license": "bsl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc": "cc-by-nc",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons zero": "cc0",
    "cc0 1 0": "cc0",
    "this is free and unencumbered software": "unlicense",
    "dedicated to the public domain": "public-domain",
    "proprietary and confidential": "proprietary",
}

#: Tags, as words; True where the tag is an everyday word.
TAGS = {"spdx license identifier": False, "license expression": False, "license identifier": False, "license": True}

#: Terms from the mildest to the strictest.
TERMS = ("public", "permissive", "weak copyleft", "copyleft", "network copyleft", "no commerce", "reserved", "unknown")

#: Families of identifiers (the identifier, or its beginning before a dash) with label and terms.
FAMILIES = {
    "0bsd": ("bsd", 1), "afl": ("afl", 1), "agpl": ("agpl", 4), "apache": ("apache", 1), "artistic": ("artistic", 2),
    "bsd": ("bsd", 1), "bsl": ("bsl", 1), "busl": ("busl", 5), "cc-by": ("cc-by", 1), "cc-by-nc": ("cc-by-nc", 5),
    "cc-by-nd": ("cc-by-nd", 5), "cc-by-sa": ("cc-by-sa", 3), "cc0": ("cc0", 0), "cddl": ("cddl", 2), "ecl": ("ecl", 1),
    "epl": ("epl", 2), "eupl": ("eupl", 3), "gfdl": ("gfdl", 3), "gpl": ("gpl", 3), "isc": ("isc", 1), "lgpl": ("lgpl", 2),
    "mit": ("mit", 1), "mpl": ("mpl", 2), "ms-pl": ("ms-pl", 1), "ncsa": ("ncsa", 1), "ofl": ("ofl", 2),
    "osl": ("osl", 4), "postgresql": ("postgresql", 1), "python": ("python", 1), "sspl": ("sspl", 4), "unlicense": ("unlicense", 0),
    "upl": ("upl", 1), "wtfpl": ("wtfpl", 0), "x11": ("mit", 1), "zlib": ("zlib", 1), "licenseref": ("licenseref", 6),
}

#: Exceptions that permit linking, by their beginning.
LINKING = ("classpath-exception", "gcc-exception", "llvm-exception", "openssl-exception", "autoconf-exception", "bison-exception",
           "font-exception", "linking-exception", "u-boot-exception", "linux-syscall-note", "wxwindows-exception", "qt-gpl-exception")

#: Certainty of one label: from a tag, a notice, a base phrase.
WEIGHTS = {"tag": 0.95, "notice": 0.8, "base": 0.5}

_TOKEN = re.compile(rb"[ \t]*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+-]*(?::[A-Za-z0-9.-]+)?)")
_AFTER_TAG = re.compile(rb"[\"']?[ \t]*[:=][ \t]*[\"']?")
_POWER = {b"or": 1, b"and": 2, b"with": 3}
_STRICTEST = len(TERMS) - 1


def family(identifier: str) -> tuple[str, int]:
    """(label, index of terms) of a licence identifier: its longest known beginning that ends at a dash."""
    name = identifier.lower().removesuffix("+").split(":")[-1] if "licenseref" in identifier.lower() else identifier.lower().removesuffix("+")
    while name:
        if name in FAMILIES:
            return FAMILIES[name]
        name = name.rpartition("-")[0]
    return "unknown", _STRICTEST


def _apply(op: bytes, left, right):
    if op == b"with":
        label, terms = left[0], left[1]
        return label, (2 if terms == 3 and right.startswith(LINKING) else terms)
    return left[0] | right[0], (max if op == b"and" else min)(left[1], right[1])


def evaluate(text: bytes, at: int = 0, end: int | None = None):
    """(labels, terms, end position) of the licence expression at ``at``; labels ``{"invalid"}`` if it does not parse, None if there is none."""
    end = len(text) if end is None else end
    values: list = []
    ops: list[bytes] = []
    operand_next, bad, depth, seen = True, False, 0, False

    def reduce_to(power: int) -> None:
        while ops and ops[-1] != b"(" and _POWER[ops[-1]] >= power:
            op = ops.pop()
            right, left = values.pop(), values.pop()
            values.append(_apply(op, left, right))

    while not bad:
        m = _TOKEN.match(text, at, end)
        if m is None:
            break
        token = m.group(1)
        word = token.lower()
        if operand_next:
            if token == b"(":
                ops.append(token)
                depth += 1
            elif token == b")" or word in _POWER:
                bad = True
            elif ops and ops[-1] == b"with":  # an exception, applied at once: WITH binds closest
                ops.pop()
                values.append(_apply(b"with", values.pop(), word.decode("ascii")))
                operand_next = False
            else:
                name = token.rstrip(b".-")  # a full stop or dash that ends the sentence is not part of the name
                label, terms = family(name.decode("ascii"))
                values.append((frozenset([label]), terms))
                operand_next = False
                if name != token and not token.endswith(b"+"):
                    seen, at = True, m.start(1) + len(name)
                    break
        elif token == b")":
            if not depth:
                break
            reduce_to(0)
            ops.pop()
            depth -= 1
        elif word in _POWER:
            follows = _TOKEN.match(text, m.end(), end)
            if word == b"with" and (text[at - 1:at] == b")" or follows is None):
                break  # WITH takes a single licence on its left and an exception on its right
            prose = follows is None or token == word and word != b"with" and follows.group(1) != b"(" and (
                family(follows.group(1).rstrip(b".-").decode("ascii"))[0] == "unknown")
            if prose and not depth:
                break  # an expression may stand in a sentence that goes on with "and"
            reduce_to(_POWER[word])
            ops.append(word)
            operand_next = True
        else:
            break
        seen, at = True, m.end()
    if not seen and not bad:
        return None
    if bad or operand_next or depth:
        return frozenset(["invalid"]), _STRICTEST, at
    reduce_to(0)
    return values[0][0], values[0][1], at


@lru_cache(maxsize=8)
def _automaton(phrases: tuple[tuple[str, str, str], ...]):
    """Automaton of (kind, phrase, label) rows; bytes stand in for characters one to one."""
    import ahocorasick
    found: dict[str, list[int]] = {}
    for i, (_, phrase, _label) in enumerate(phrases):
        found.setdefault(f" {phrase} ".encode().decode("latin-1"), []).append(i)
    a = ahocorasick.Automaton()
    for pattern, which in found.items():
        a.add_word(pattern, (len(pattern), tuple(which)))
    a.make_automaton()
    return a


def phrase_table(base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES, tags: dict[str, bool] = TAGS):
    return (*(("base", p, v) for p, v in base.items()), *(("notice", p, v) for p, v in notices.items()),
            *(("tag", p, "loose" if v else "") for p, v in tags.items()))


def _laid_out(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[str, np.ndarray]:
    """The words with one blank before and after each, a line break before each text, and where each word begins."""
    size = ends - starts
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]])[:len(size)] + 2 * (row + 1)
    out = np.full(int((size + 1).sum()) + 2 * len(first), 32, np.uint8)
    if len(size):
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(begin, size) + at] = low[np.repeat(starts, size) + at]
        head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        out[begin[head] - 2] = 10
    return out.tobytes().decode("latin-1"), begin


def finds(texts: pa.Array, phrases) -> tuple[list[tuple], np.ndarray]:
    """(row, kind, label, first word, words, terms or None, expression or None) of a few texts, by row and place; words of each."""
    data, offsets = utf8(texts)
    low, starts, ends, first = words(data, offsets, ALNUM)
    buffer, begin = _laid_out(low, starts, ends, first)
    hits = [(end + 2 - size, i) for end, (size, which) in _automaton(phrases).iter(buffer) for i in which]
    out: list[tuple] = []
    if hits:
        raw = None
        at = np.searchsorted(begin, np.array([h[0] for h in hits]))
        rows = np.searchsorted(first, at, side="right") - 1
        done: set[int] = set()
        for (_, i), w, r in zip(hits, at.tolist(), rows.tolist(), strict=True):
            kind, phrase, label = phrases[i]
            n = phrase.count(" ") + 1
            if kind != "tag":
                out.append((r, kind, label, w, n, None, None))
                continue
            raw = data.tobytes() if raw is None else raw
            stop = int(ends[w + n - 1])
            if stop in done:  # a longer tag ends with the same word
                continue
            m = _AFTER_TAG.match(raw, stop, int(offsets[r + 1]))
            read = m and evaluate(raw, m.end(), int(offsets[r + 1]))
            if not read or label and read[0] & {"invalid", "unknown"}:
                continue
            done.add(stop)
            said = raw[m.end():read[2]].decode("ascii", "replace")
            out += [(r, kind, x, w, n, TERMS[read[1]], said) for x in sorted(read[0])]
        out = [(r, kind, label, int(w - first[r]), n, terms, said) for r, kind, label, w, n, terms, said in out]
        out.sort(key=lambda x: (x[0], x[3], x[4], x[1], x[2]))
    return out, np.diff(first)


def places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=None) -> DataFrame:
    """One row per place found: doc_id, kind (base, notice, tag), label, word (from 0), n_words, terms and expression (tags only).

    A tag whose expression names several licences gives a row for each label.  Null texts are empty; rows of one id and text give their places
    once for each row; texts of any length are read whole; other columns are not read.
    """
    phrases = phrase_table() if phrases is None else phrases

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", 4 << 20):
                found, _ = finds(b.column("text"), phrases)
                cols = list(zip(*found, strict=True)) if found else [()] * 7
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()),
                     pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.string()), pa.array(cols[6], pa.string())],
                    names=["doc_id", "kind", "label", "word", "n_words", "terms", "expression"])

    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return narrow.mapInArrow(run, T.StructType([narrow.schema["doc_id"], *T._parse_datatype_string(
        "kind string, label string, word long, n_words long, terms string, expression string").fields]))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=None) -> DataFrame:
    """One row per document: doc_id, n_words, n_base (places of base phrases), first_word and last_word (smallest and largest start of
    one, else null), base_labels, labels (distinct, sorted, comma-joined; empty without any), score, n_tags, terms (the strictest of the
    tags, else null).

    ``score`` is the certainty of a licence statement: 1 minus the product, over labels, of 1 minus the weight of the label's surest kind.  Null
    and empty texts have no words and score 0; repeated rows give equal rows; other columns are not read.
    """
    phrases = phrase_table() if phrases is None else phrases

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", 4 << 20):
                found, n_words = finds(b.column("text"), phrases)
                n = b.num_rows
                n_base, n_tags, score = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
                lowest, highest, terms = [None] * n, [None] * n, [None] * n
                base, every = [""] * n, [""] * n
                begin = 0
                for stop in [*(i for i in range(1, len(found)) if found[i][0] != found[i - 1][0]), len(found)] if found else []:
                    mine, r = found[begin:stop], found[begin][0]
                    starts = [x[3] for x in mine if x[1] == "base"]
                    n_base[r], n_tags[r] = len(starts), len({x[3] for x in mine if x[1] == "tag"})
                    if starts:
                        lowest[r], highest[r] = starts[0], starts[-1]
                    base[r] = ",".join(sorted({x[2] for x in mine if x[1] == "base"}))
                    surest: dict[str, float] = {}
                    for x in mine:
                        surest[x[2]] = max(surest.get(x[2], 0.0), WEIGHTS[x[1]])
                    every[r] = ",".join(sorted(surest))
                    score[r] = 1 - np.prod([1 - v for _, v in sorted(surest.items())])
                    said = [TERMS.index(x[5]) for x in mine if x[5]]
                    terms[r] = TERMS[max(said)] if said else None
                    begin = stop
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_base), pa.array(lowest, pa.int64()), pa.array(highest, pa.int64()),
                     pa.array(base, pa.string()), pa.array(every, pa.string()), pa.array(score), pa.array(n_tags), pa.array(terms, pa.string())],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_tags", "terms"])

    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return narrow.mapInArrow(run, T.StructType([narrow.schema["doc_id"], *T._parse_datatype_string(
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_tags long, "
        "terms string").fields]))
