"""Removal of line chunks that repeat anywhere in the corpus.

Lines are hashed, and a rolling hash over two neighbouring line hashes decides where chunks
end.  A repeated run is a stretch of neighbouring pairs of lines that each occur at two places or more; runs of fewer than
``min_words`` words are left alone.  Two neighbouring pairs of a run belong to one chunk if each has the other as its neighbour
wherever it stands, so a boundary lies where the surroundings of a repeated passage differ.  Boundaries depend on content
alone, whatever copies of the surroundings there are: an insertion moves none but those next to it.  Chunks cover their run.

Chunks, and single lines of ``long_line`` words, are removed wherever they repeat, all but the first occurrence (smallest
id, then text hash, then line); equal hashes only nominate, the bytes are compared before anything goes.

Only hashes and positions are shuffled to find the chunks.  Texts move twice, to cut out the nominated
pieces and to drop the confirmed lines, and only those that a bitmap of 2 ** ``BITMAP`` bits of document key lets through: the
documents with such pieces or lines, and those that share their bit (more of them in a larger corpus; the join on the full key decides).
Repeated pairs, chunks and confirmed lines are written tables; the first two are deleted when the last is there.  Frequent hashes are counted with partial aggregation; the joins
that bring counts and first occurrences back have one row per hash on one side, so a hot hash can be split.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, scratch_path

MIN_WORDS = 20
LONG_LINE = 50
BITMAP = 24
_KEY = ["_i", "_t"]


def _words(line: Column) -> Column:
    """Pieces between single spaces."""
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_i, the id itself with nulls first (ids that are not whole numbers as strings), and _t, a hash of the text."""
    whole = isinstance(docs.schema[id_col].dataType, T.IntegralType)
    i = F.col(f"`{id_col}`").cast("long" if whole else "string")
    return docs.withColumns({"_i": F.coalesce(i, F.lit(-(1 << 63)) if whole else F.lit("")), "_t": F.xxhash64(F.col(f"`{text_col}`"))})


def _grams(docs: DataFrame, id_col: str, text_col: str, long_line: int) -> DataFrame:
    """Rows (key, at, kind, g, w1, w2): the rolling hash of each pair of lines, and each long line by itself."""
    hashed = (_keyed(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), "id", "text")
              .filter(F.col("text").isNotNull())
              .withColumn("line", F.transform(F.split("text", "\n", -1),
                                              lambda x: F.struct(F.md5(x).alias("h"), _words(x).alias("w")))))
    n = F.size("line")
    pairs = F.zip_with(
        F.slice("line", 1, n - 1), F.slice("line", 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.struct(F.unhex(F.md5(F.concat(a["h"], b["h"]))).alias("g"), a["w"].alias("w1"), b["w"].alias("w2")))
    numbered = F.transform(pairs, lambda p, i: F.struct(
        i.alias("at"), F.lit(2).alias("kind"), p["g"].alias("g"), p["w1"].alias("w1"), p["w2"].alias("w2")))
    single = F.filter(F.transform(F.col("line"), lambda x, i: F.struct(
        i.alias("at"), F.lit(1).alias("kind"), F.unhex(x["h"]).alias("g"), x["w"].alias("w1"), F.lit(0).alias("w2"))),
        lambda s: s["w1"] >= long_line)
    return hashed.select(*_KEY, F.explode(F.concat(numbered, single)).alias("x")).select(*_KEY, "x.*")


def _nominated(multi: DataFrame, repeated: DataFrame) -> DataFrame:
    """The chunks and long lines that occur more than once, with their first occurrence marked."""
    single = repeated.filter("kind = 1").select(
        *_KEY, F.col("at").alias("first"), F.col("at").alias("last"), F.concat(F.lit("1"), F.hex("g")).alias("hash"))
    chunks = multi.unionByName(single)
    firsts = (chunks.groupBy("hash").agg(F.count("*").alias("n"), F.min(F.struct(*_KEY, "first")).alias("o"))
              .filter("n > 1").select("hash", "o"))
    here = F.struct(*_KEY, "first")
    return chunks.join(firsts, "hash").select(*_KEY, "first", "last", "hash", here.eqNullSafe(F.col("o")).alias("is_first"))


def _repeated(docs: DataFrame, id_col: str, text_col: str, min_words: int, long_line: int) -> DataFrame:
    """Grams that occur at two places or more; the pairs only where their whole run has ``min_words`` words."""
    grams = _grams(docs, id_col, text_col, long_line).withColumn("here", F.xxhash64(*_KEY, "at"))
    # rows that agree in id and text are one place
    places = grams.groupBy("kind", "g").agg(F.min("here").alias("lo"), F.max("here").alias("hi")).filter("lo < hi").select("kind", "g")
    repeated = grams.join(places, ["kind", "g"]).repartition(*_KEY).dropDuplicates([*_KEY, "kind", "at"])
    w = Window.partitionBy(*_KEY, "kind").orderBy("at")
    opens = F.coalesce(F.lag("at").over(w) != F.col("at") - 1, F.lit(True))
    numbered = repeated.withColumn("run", F.sum(opens.cast("int")).over(w))
    whole = Window.partitionBy(*_KEY, "kind", "run")
    words = F.sum("w1").over(whole) + F.max_by("w2", "at").over(whole)
    return numbered.withColumn("words", words).filter((F.col("kind") == 1) | (F.col("words") >= min_words)).drop("run", "words", "w1", "w2")


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def repeated_chunks(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                    min_words: int = MIN_WORDS, long_line: int = LONG_LINE) -> DataFrame:
    """Chunks whose hash occurs more than once: (_i, _t, first line, last line, hash, is_first), with work tables in ``folder``."""
    repeated = _stored(_repeated(docs, id_col, text_col, min_words, long_line), f"{folder}/repeated")
    w = Window.partitionBy(*_KEY).orderBy("at")
    near = lambda c, d: F.when(F.lag("at", d).over(w) == F.col("at") - d, F.lag(c, d).over(w))
    pairs = (repeated.filter("kind = 2").drop("kind", "here").withColumn("e", F.xxhash64("g"))
             .withColumns({"e0": F.coalesce(near("e", 1), F.lit(0)), "e1": F.coalesce(near("e", -1), F.lit(0))}))
    # a pair is bound to its neighbour if it has the same one wherever it stands
    one = lambda c: (F.min(c) == F.max(c)) & (F.min(c) != 0)
    binds = pairs.groupBy("g").agg(one("e0").alias("left"), one("e1").alias("right"))
    bound = pairs.join(binds, "g").withColumns({"right0": near("right", 1), "left1": near("left", -1)})
    opens = F.coalesce(~(F.col("left") & F.col("right0")), F.lit(True))
    # the line where two chunks meet goes to the one that stands in more places; to both if neither has all places of the other
    ends = bound.withColumns({
        "chunk": F.sum(opens.cast("int")).over(w),
        "skip0": F.coalesce(F.col("left") & ~F.col("right0"), F.lit(False)).cast("int"),
        "skip1": F.coalesce(F.col("right") & ~F.col("left1"), F.lit(False)).cast("int")})
    multi = (ends.groupBy(*_KEY, "chunk")
             .agg((F.min("at") + F.min_by("skip0", "at")).alias("first"),
                  (F.max("at") + 1 - F.max_by("skip1", "at")).alias("last"),
                  F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "g"))),
                                                 lambda p: F.hex(p["g"])), "")).alias("hash"))
             .filter("first <= last").drop("chunk"))
    return _stored(_nominated(multi, repeated), f"{folder}/chunks")


def _bit() -> tuple[Column, Column]:
    """Place of a document key's word in the bitmap, and its bit there."""
    h = F.xxhash64(*_KEY)
    return F.shiftrightunsigned(h, 64 - BITMAP + 6), F.expr("shiftleft(1L, CAST(xxhash64(_i, _t) & 63 AS INT))")


def _flagged(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """``keyed`` with _in: false only for documents that are not among ``keys``; no shuffle of ``keyed``."""
    place, bit = _bit()
    bitmap = keys.groupBy(place.alias("_place")).agg(F.bit_or(bit).alias("_bits"))
    return (keyed.withColumn("_place", place).join(F.broadcast(bitmap), "_place", "left")
            .withColumn("_in", F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))).drop("_place", "_bits"))


def removable_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Line numbers to remove per document key (_i, _t), confirmed byte by byte; a written table."""
    spark = docs.sparkSession
    folder = scratch_path(spark, f"lines-{uuid.uuid4().hex[:12]}")
    chunks = repeated_chunks(docs, f"{folder}/work", id_col, text_col, **options)
    texts = _keyed(docs.select(id_col, text_col), id_col, text_col).select(*_KEY, F.col(f"`{text_col}`").alias("text"))
    texts = _flagged(texts, chunks).filter("_in").drop("_in")
    mine = chunks.groupBy(*_KEY).agg(F.collect_list(F.struct("first", "last", "hash", "is_first")).alias("c"))
    # the pieces are cut before the explode, so that a long text is not copied once for each of its chunks
    pieces = (texts.dropDuplicates(_KEY).join(mine, _KEY).withColumn("line", F.split("text", "\n", -1))
              .select(*_KEY, F.explode(F.transform("c", lambda x: F.struct(
                  x["first"].alias("first"), x["last"].alias("last"), x["hash"].alias("hash"), x["is_first"].alias("is_first"),
                  F.array_join(F.slice("line", x["first"] + 1, x["last"] - x["first"] + 1), "\n").alias("piece")))).alias("x"))
              .select(*_KEY, "x.*"))
    original = pieces.filter("is_first").select("hash", F.col("piece").alias("original"))
    same = pieces.join(original, "hash").filter(F.col("piece") == F.col("original"))
    lines = lambda which: F.array_distinct(F.flatten(F.collect_list(F.when(which, F.sequence("first", "last")))))
    # chunks may share a line: what the first occurrence of one holds stays, unless it is a long line that goes by itself
    multi, first = F.length("hash") == 32, F.col("is_first")
    gone = F.array_union(lines(~first & ~multi), F.array_except(lines(~first & multi), lines(first & multi)))
    out = _stored(same.groupBy(*_KEY).agg(gone.alias("_gone")).filter(F.size("_gone") > 0), f"{folder}/gone")
    delete_path(spark, f"{folder}/work")
    return out


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_counts: bool = False,
                **options) -> DataFrame:
    """``docs`` with ``text_col`` freed of repeated chunks, all columns in place.

    Lines end at "\\n".  A null text stays null and has no lines; an empty text is one empty line.  Rows that agree
    in id and text are the same document and get the same result; null ids order first.  ``keep_counts`` adds
    ``n_lines`` and ``n_removed`` (long), replacing columns of those names; otherwise names that start with an
    underscore and clash with the work columns _i, _t, _line, _gone, _place, _bits and _in are the only ones not allowed.
    """
    gone = removable_lines(docs, id_col, text_col, **options)
    flagged = _flagged(_keyed(docs, id_col, text_col), gone)
    untouched = flagged.filter(~F.col("_in")).withColumn("_gone", F.lit(None).cast(gone.schema["_gone"].dataType))
    joined = (flagged.filter("_in").join(gone, _KEY, "left").unionByName(untouched)
              .withColumn("_line", F.split(F.col(f"`{text_col}`"), "\n", -1)))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_line") - 1), F.col("_gone"))
    text = F.when(F.col("_gone").isNull(), F.col(f"`{text_col}`")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("_line", i)), "\n"))
    names = [c for c in docs.columns if not (keep_counts and c in ("n_lines", "n_removed"))]
    out = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in names]
    if keep_counts:
        out += [F.coalesce(F.size("_line"), F.lit(0)).cast("long").alias("n_lines"),
                F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed")]
    return joined.select(out)


#: The same for a table ``documents``; a chunk is known by its pairs, its text is compared as well.
ORACLE_SQL = f"""
WITH doc AS (SELECT *, row_number() OVER () AS r FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
line AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM doc),
h AS (SELECT r, doc_id, pos, l, md5(l) AS h, length(l) - length(replace(l, ' ', '')) + 1 AS w FROM line),
pair AS (SELECT r, doc_id, pos, md5(h || lead(h) OVER d) AS g, w AS w1, lead(w) OVER d AS w2 FROM h WINDOW d AS (PARTITION BY r ORDER BY pos)),
counted AS (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM pair WHERE g IS NOT NULL),
numbered AS (SELECT *, pos - row_number() OVER (PARTITION BY r ORDER BY pos) AS run FROM counted WHERE n > 1),
whole AS (SELECT r, run, sum(w1) + max_by(w2, pos) AS words FROM numbered GROUP BY r, run),
near AS (SELECT r, doc_id, run, pos, g, coalesce(lag(g) OVER d, '') AS g0, coalesce(lead(g) OVER d, '') AS g1
         FROM numbered JOIN whole USING (r, run) WHERE words >= {MIN_WORDS} WINDOW d AS (PARTITION BY r, run ORDER BY pos)),
binds AS (SELECT g, min(g0) = max(g0) AND min(g0) <> '' AS lb, min(g1) = max(g1) AND min(g1) <> '' AS rb FROM near GROUP BY g),
bound AS (SELECT near.*, lb, rb, lag(rb) OVER d AS rb0, lead(lb) OVER d AS lb1 FROM near JOIN binds USING (g) WINDOW d AS (PARTITION BY r, run ORDER BY pos)),
ends AS (SELECT *, sum(CASE WHEN lb AND coalesce(rb0, false) THEN 0 ELSE 1 END) OVER (PARTITION BY r, run ORDER BY pos) AS c,
                CASE WHEN lb AND NOT rb0 THEN 1 ELSE 0 END AS skip0, CASE WHEN rb AND NOT lb1 THEN 1 ELSE 0 END AS skip1 FROM bound),
multi AS (SELECT r, doc_id, min(pos) + min_by(skip0, pos) AS a, max(pos) + 1 - max_by(skip1, pos) AS b, string_agg(g, '' ORDER BY pos) AS hash
          FROM ends GROUP BY r, doc_id, run, c),
chunk AS (SELECT r, multi.doc_id, a, b, hash, array_to_string(string_split(text, chr(10))[a + 1:b + 1], chr(10)) AS piece, 2 AS kind
          FROM multi JOIN doc USING (r) WHERE a <= b
          UNION ALL SELECT r, doc_id, pos, pos, '', l, 1 FROM h WHERE w >= {LONG_LINE}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY kind, hash, piece ORDER BY doc_id, a) AS k, count(*) OVER (PARTITION BY kind, hash, piece) AS n FROM chunk),
spread AS (SELECT r, kind, k, unnest(generate_series(a, b)) AS pos FROM ranked WHERE n > 1),
gone AS (SELECT r, pos FROM spread GROUP BY r, pos
         HAVING bool_or(kind = 1 AND k > 1) OR (bool_or(kind = 2 AND k > 1) AND NOT bool_or(kind = 2 AND k = 1))),
kept AS (SELECT line.r, count(*) AS n_lines, count(gone.pos) AS n_removed,
                coalesce(string_agg(line.l, chr(10) ORDER BY line.pos) FILTER (WHERE gone.pos IS NULL), '') AS rest
         FROM line LEFT JOIN gone ON line.r = gone.r AND line.pos = gone.pos GROUP BY line.r)
SELECT d.doc_id, coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.rest, '')) AS text_sha256
FROM documents d LEFT JOIN doc USING (doc_id, text) LEFT JOIN kept k ON doc.r = k.r
"""
