"""Substring dedup by hashing lines and runs of sentences.

*Units.*  A text is cut at newlines; a line of ``min_words`` or more words is a
unit.  :func:`repeated_passages` adds the units inside lines: a line is cut
after each run of ``.``, ``!`` or ``?``, and from every sentence on, the fewest
whole sentences (of this and the lines after) that hold ``min_words`` words are
a unit too.  So a passage that repeats inside longer lines, or is wrapped at
other places, is found but for a part of its first and last sentence, and a
short sentence that many texts share is no unit by itself.

*Hashing.*  Units are normalised (lower case, runs of white space as one space)
and digested to 128 bits.  Digests are grouped over the whole corpus; the
occurrence of smallest rank (document id, then position) stays, and all others
are removed, with their offsets in the original text.  A repeated line goes
wherever it is; a run of sentences goes only where another document has it
earlier, so a text that repeats its own short sentences keeps them.

The count and the first occurrence of a digest come from one grouped aggregate
with map-side combining, so a unit that a third of the documents share costs
its counts, not its rows.  Units are then joined to the digests that occur twice
or more; frequent digests are sliced (``operators.skew``).

Defined results.  Null or empty text, or too few words: nothing removed.  Null
ids rank last.  Repeated rows: the first by row number keeps its units.  A line
repeated within one document is removed there as well.  A very long text is cut
like any other.  Empty table: no rows.  Extra columns are kept by
:func:`remove_repeats` and ignored elsewhere, whatever their names.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saletrace.operators.skew import sliced_join

from .common import id_and_text, materialize, packed, slices, unpacked

MIN_WORDS, HOT_ROWS = 20, 1_000_000
_WHITE = " \t\n\r\x0b\x0c"
_UNITS = T.ArrayType(T.StructType([T.StructField("line", T.IntegerType()),
                                   T.StructField("start", T.LongType()),
                                   T.StructField("end", T.LongType()),
                                   T.StructField("digest", T.BinaryType())]))


def line_units(text: str, min_words: int) -> list[tuple[int, int, int, bytes]]:
    """``(line number, start, end, digest)``; the end is before the newline."""
    out, at = [], 0
    for number, line in enumerate(text.split("\n")):
        words = line.lower().encode("utf-8", "surrogatepass").split()
        if len(words) >= min_words:
            out.append((number, at, at + len(line), xxhash.xxh3_128_digest(b" ".join(words))))
        at += len(line) + 1
    return out


def units_udf(min_words: int):
    @F.arrow_udf(_UNITS)
    def units(text: pa.Array) -> pa.Array:
        return pa.array([[{"line": n, "start": a, "end": b, "digest": d}
                          for n, a, b, d in line_units(x or "", min_words)]
                         for part in slices(text) for x in part],
                        pa.list_(pa.struct([("line", pa.int32()), ("start", pa.int64()),
                                            ("end", pa.int64()), ("digest", pa.binary())])))
    return units


def _repeats(units: DataFrame) -> DataFrame:
    """``units``: ``id, row, line, start, end, digest``, written.  Those to
    remove, with the first occurrence's id."""
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "row", "start")
    groups = materialize(units.groupBy("digest").agg(F.count(F.lit(1)).alias("n"),
                                                     F.min(rank).alias("first"))
                         .filter("n > 1"), "line-groups")
    groups = groups.select(F.col("digest").alias("met"), "first")
    marked = sliced_join(units, groups, [("digest", "met")], "inner", HOT_ROWS)
    return marked.filter(rank != F.col("first")).select(
        "id", "row", "line", "start", "end", "digest", F.col("first.id").alias("first_id"))


_SENTENCE = re.compile(r"[^.!?\n]*[.!?]+|[^.!?\n]+|\n")
_RUNS = T.ArrayType(T.StructType([T.StructField("line", T.IntegerType()),
                                  T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType()),
                                  T.StructField("digest", T.BinaryType()),
                                  T.StructField("run", T.BooleanType())]))


def sentence_runs(text: str, min_words: int) -> list[tuple[int, int, int, bytes]]:
    """``(line number of the start, start, end, digest)``: from each sentence
    on, the fewest sentences of ``min_words`` words together."""
    found, number = [], 0
    for m in _SENTENCE.finditer(text):
        piece = m.group()
        if piece == "\n":
            number += 1
            continue
        words = piece.lower().encode("utf-8", "surrogatepass").split()
        if words:
            found.append((number, m.start(), m.end(), b" ".join(words), len(words)))
    out, j, held = [], 0, 0
    for i, (number, start, _, _, n) in enumerate(found):
        while j < len(found) and held < min_words:
            held += found[j][4]
            j += 1
        if held < min_words:
            break
        body = b" ".join([x[3] for x in found[i:j]])
        out.append((number, start, found[j - 1][2], xxhash.xxh3_128_digest(b"run\n" + body)))
        held -= n
    return out


def runs_udf(min_words: int):
    @F.arrow_udf(_RUNS)
    def runs(text: pa.Array) -> pa.Array:
        def of(x: str) -> list[dict]:
            return [{"line": n, "start": a, "end": b, "digest": d, "run": run}
                    for run, cut in ((False, line_units), (True, sentence_runs))
                    for n, a, b, d in cut(x, min_words)]
        return pa.array([of(x or "") for part in slices(text) for x in part],
                        pa.list_(pa.struct([("line", pa.int32()), ("start", pa.int64()),
                                            ("end", pa.int64()), ("digest", pa.binary()),
                                            ("run", pa.bool_())])))
    return runs


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_words: int = MIN_WORDS) -> DataFrame:
    """One row for each span to remove, lines and runs of sentences merged where
    they overlap: the document's id, ``line`` (of the start), ``start, end``
    (code points, end exclusive) and ``first_id``, the document that keeps what
    the span begins with."""
    numbered = id_and_text(docs, id_col, text_col).withColumn(
        "number", F.monotonically_increasing_id())
    units = numbered.select("id", F.col("number").alias("row"),
                            F.explode(runs_udf(min_words)("text")).alias("u"))
    units = materialize(units.select("id", "row", "u.*"), "passages")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "row", "start")
    groups = materialize(units.groupBy("digest").agg(F.count(F.lit(1)).alias("n"),
                                                     F.min(rank).alias("first"))
                         .filter("n > 1").select(F.col("digest").alias("met"), "first"),
                         "passage-groups")
    met = sliced_join(units, groups, [("digest", "met")], "inner", HOT_ROWS)
    gone = met.filter(F.when(F.col("run"), F.col("row") != F.col("first.row"))
                      .otherwise(rank != F.col("first")))
    # spans of one document that overlap are one
    order = Window.partitionBy("row").orderBy("start", F.col("end").desc(), "first_id", "run")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    spans = (gone.select("id", "row", "line", "start", "end", "run", F.col("first.id").alias("first_id"))
             .withColumn("fresh", F.coalesce(F.max("end").over(before) <= F.col("start"), F.lit(True)))
             .withColumn("span", F.sum(F.col("fresh").cast("int")).over(
                 order.rowsBetween(Window.unboundedPreceding, 0))))
    return spans.groupBy("row", "span").agg(
        F.first("id").alias(id_col), F.min("line").alias("line"), F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.min(F.struct("start", (-F.col("end")).alias("e"), "first_id"))["first_id"].alias("first_id")
    ).drop("row", "span")


def _units(numbered: DataFrame, min_words: int) -> DataFrame:
    """``numbered``: ``id, text, number``."""
    units = numbered.select("id", F.col("number").alias("row"),
                            F.explode(units_udf(min_words)("text")).alias("u"))
    return materialize(units.select("id", "row", "u.*"), "lines")


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """One row for each line to remove: the document's id, ``line, start,
    end`` (code points, end exclusive) and ``first_id``, the document that
    keeps the line."""
    numbered = id_and_text(docs, id_col, text_col).withColumn(
        "number", F.monotonically_increasing_id())
    return (_repeats(_units(numbered, min_words))
            .select(F.col("id").alias(id_col), "line", "start", "end", "first_id"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the repeated lines.  A removed line takes its newline
    with it; :func:`repeated_lines` has the original offsets."""
    numbered = materialize(packed(docs, id=docs[id_col].cast("bigint"), text=docs[text_col],
                                  number=F.monotonically_increasing_id()), "numbered")
    spans = (_repeats(_units(numbered, min_words)).groupBy(F.col("row").alias("at"))
             .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("removed")))

    @F.arrow_udf(T.StringType())
    def cut(text: pa.Array, removed: pa.Array) -> pa.Array:
        out = []
        for x, gone in zip(text.to_pylist(), removed.to_pylist()):
            if gone:
                at, parts = 0, []
                for s in gone:
                    parts.append(x[at:s["start"]])
                    at = s["end"] + 1
                x = "".join([*parts, x[at:]])
            out.append(x)
        return pa.array(out, pa.string())

    joined = numbered.join(spans, numbered["number"] == spans["at"], "left")
    return unpacked(joined, docs, **{text_col: cut(joined["text"], joined["removed"])})


def repeated_lines_sql(documents: str = "documents", min_words: int = MIN_WORDS) -> str:
    """DuckDB SQL of :func:`repeated_lines`, from the definition alone."""
    return rf"""
WITH cut AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS body,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line
  FROM {documents} WHERE text IS NOT NULL
), placed AS (
  SELECT doc_id, line, body, lower(body) AS low,
         sum(length(body) + 1) OVER (PARTITION BY doc_id ORDER BY line) - length(body) - 1 AS start
  FROM cut
), norm AS (
  SELECT doc_id, line, start, start + length(body) AS "end",
         array_to_string(regexp_extract_all(low, '[^ \t\n\r\v\f]+'), ' ') AS key,
         len(regexp_extract_all(low, '[^ \t\n\r\v\f]+')) AS words
  FROM placed
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, start) AS place,
         first_value(doc_id) OVER (PARTITION BY key ORDER BY doc_id, start) AS first_id
  FROM norm WHERE words >= {min_words}
)
SELECT doc_id, CAST(line AS INTEGER) AS line, CAST(start AS BIGINT) AS start,
       CAST("end" AS BIGINT) AS "end", first_id
FROM ranked WHERE place > 1
"""


def repeated_passages_sql(documents: str = "documents", min_words: int = MIN_WORDS) -> str:
    """DuckDB SQL of :func:`repeated_passages`, from the definition alone."""
    return rf"""
WITH piece AS (
  SELECT doc_id, unnest(p) AS body, generate_subscripts(p, 1) AS k
  FROM (SELECT doc_id, regexp_extract_all(text, '[^.!?\n]*[.!?]+|[^.!?\n]+|\n') AS p
        FROM {documents} WHERE text IS NOT NULL)
), placed AS (
  SELECT doc_id, k, body, array_to_string(regexp_extract_all(lower(body), '[^ \t\n\r\v\f]+'), ' ') AS key,
         len(regexp_extract_all(lower(body), '[^ \t\n\r\v\f]+')) AS words,
         sum(length(body)) OVER w - length(body) AS start,
         sum(CASE WHEN body = chr(10) THEN 1 ELSE 0 END) OVER w AS line
  FROM piece WINDOW w AS (PARTITION BY doc_id ORDER BY k)
), sentence AS (
  SELECT *, row_number() OVER w AS i, sum(words) OVER w AS upto
  FROM placed WHERE words > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY k)
), reach AS (
  SELECT a.doc_id, a.i, a.line, a.start, min(b.i) AS j
  FROM sentence a JOIN sentence b ON b.doc_id = a.doc_id AND b.i >= a.i
   AND b.i < a.i + {min_words} AND b.upto - a.upto + a.words >= {min_words}
  GROUP BY ALL
), run AS (
  SELECT r.doc_id, r.line, r.start, max(s.start + length(s.body)) AS "end",
         'run' || string_agg(s.key, ' ' ORDER BY s.i) AS key
  FROM reach r JOIN sentence s ON s.doc_id = r.doc_id AND s.i BETWEEN r.i AND r.j
  GROUP BY r.doc_id, r.line, r.start, r.i
), row_line AS (
  SELECT doc_id, line, min(start) AS start, max(start + length(body)) AS "end",
         'line' || array_to_string(regexp_extract_all(lower(string_agg(body, '' ORDER BY k)),
                                                      '[^ \t\n\r\v\f]+'), ' ') AS key
  FROM placed WHERE body <> chr(10) GROUP BY doc_id, line HAVING sum(words) >= {min_words}
), unit AS (
  SELECT doc_id, line, start, "end", key, true AS run FROM run
  UNION ALL SELECT doc_id, line, start, "end", key, false FROM row_line
), ranked AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS first_id
  FROM unit WINDOW w AS (PARTITION BY key ORDER BY doc_id, start)
), gone AS (
  SELECT *, max("end") OVER (PARTITION BY doc_id ORDER BY start, "end" DESC, first_id, run
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
  FROM ranked WHERE CASE WHEN run THEN doc_id <> first_id ELSE place > 1 END
), span AS (
  SELECT *, sum(CASE WHEN reached > start THEN 0 ELSE 1 END) OVER (
    PARTITION BY doc_id ORDER BY start, "end" DESC, first_id, run ROWS UNBOUNDED PRECEDING) AS nth
  FROM gone
)
SELECT doc_id, CAST(min(line) AS INTEGER) AS line, CAST(min(start) AS BIGINT) AS start,
       CAST(max("end") AS BIGINT) AS "end", arg_min(first_id, (start, -"end", first_id)) AS first_id
FROM span GROUP BY doc_id, nth
"""
