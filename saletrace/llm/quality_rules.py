"""Quality rules with risk-controlled thresholds.

Two fixed rules (too few words, too much repetition) are joined by cutoffs on
the shares in ``METRICS`` that are selected so that, per stratum (language),
they reject at most ``alpha`` of the good documents that pass the fixed rules.
The bound is on the cutoffs alone: good documents that the fixed rules reject
come on top, and are not bounded.

1. *Ladder*: ``RUNGS`` sets of cutoffs, fixed in advance, from ``LOOSE`` to
   ``STRICT`` in equal ratios.  No document shapes them, so every label is
   held out.  A rung fixes the cutoffs of all metrics at once, and rejects
   whatever a looser one does.
2. *Certify*: a rung's false rejections k of a stratum's n good documents (of
   those that pass the fixed rules) give an exact (Clopper-Pearson) upper
   bound.  Rungs are tested from the loosest on, and the first whose bound
   exceeds ``alpha`` ends the ladder (fixed-sequence testing).  The error
   level ``delta`` is divided by the number of strata that could be certified
   at all; a stratum at the end of its ladder hands its level to those still
   open, in equal parts (a sequentially rejective graph, Bretz et al. 2009).
   All selected rungs hold together with probability ``1 - delta``.

With no false rejection a rung needs ``log(level) / log(1 - alpha)`` good
labelled documents: 299 at alpha 0.01 and level 0.05, 436 at a quarter of
that.  A stratum whose labels cannot certify its first rung keeps the fixed
rules only.  All labels are used; nothing is sampled.  The driver is handed
one row of counts per stratum with at least as many labels as level ``delta``
needs.

Defined results.  Null or empty text: no words, so the base rule fails.  Very
long text: counted whole.  Null language: a stratum of its own, apart from
the empty string's.  Conflicting labels of one id: that id is not used.
Repeated rows: one result row each.  A share equal to its cutoff passes.  No
labels: base rules alone.  No documents: no rows.  Further columns, whatever
their names, are not looked at; ``keep_good`` returns them unchanged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, packed, slices, unpacked
from .textstats import FIELDS, text_stats

#: name -> (numerator, denominator); rejected when the share exceeds the cutoff
METRICS = {
    "symbols_per_char": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_word_share": ("n_repeat_words", "n_words"),
    "adjacent_share": ("n_adjacent", "n_words"),
    "top_word_share": ("top_word", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "exclaim_share": ("n_exclaim", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
}
#: Cutoffs of the first and the last rung, by metric: round figures set by
#: hand, from "mostly symbols, or mostly one word" to the usual limits.
LOOSE = {"symbols_per_char": 0.5, "dup_line_share": 0.9, "repeat_word_share": 0.3,
         "adjacent_share": 0.5, "top_word_share": 0.5, "upper_share": 0.9,
         "exclaim_share": 0.5, "digit_share": 0.6}
STRICT = {"symbols_per_char": 0.1, "dup_line_share": 0.5, "repeat_word_share": 0.3,
          "adjacent_share": 0.1, "top_word_share": 0.2, "upper_share": 0.3,
          "exclaim_share": 0.1, "digit_share": 0.3}
RUNGS = 6
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
_STRUCT = T.StructType([T.StructField(f, T.LongType()) for f in FIELDS])


@F.arrow_udf(_STRUCT)
def stats_udf(text: pa.Array) -> pa.Array:
    rows = [text_stats(x or "") for part in slices(text) for x in part]
    cols = zip(*rows) if rows else [[] for _ in FIELDS]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], names=list(FIELDS))


# so that no filter on the counts is pushed below and counts the text again
stats_udf = stats_udf.asNondeterministic()


def base_failed(stats: str = "s"):
    n, r = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PERCENT * n)


def metric_array(stats: str = "s"):
    """The shares of ``METRICS`` as one array column (0 for an empty text)."""
    return F.array(*[F.coalesce(F.try_divide(F.col(f"{stats}.{a}").cast("double"),
                                             F.col(f"{stats}.{b}").cast("double")), F.lit(0.0))
                     for a, b in METRICS.values()])


def binomial_upper(k: int, n: int, delta: float) -> float:
    """Exact (Clopper-Pearson) upper confidence bound of a rate of which
    ``k`` of ``n`` were seen: the p at which P(X <= k) = ``delta``."""
    if n == 0 or k >= n:
        return 1.0
    i = np.arange(k + 1)
    choose = np.array([math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1)
                       for x in i.tolist()])
    lo, hi = k / n, 1.0
    for _ in range(60):
        p = (lo + hi) / 2
        if p >= 1.0:
            break
        terms = choose + i * math.log(p) + (n - i) * math.log1p(-p)
        top = terms.max()
        if top + math.log(np.exp(terms - top).sum()) > math.log(delta):
            lo = p
        else:
            hi = p
    return hi


def _clean_labels(labels: DataFrame) -> DataFrame:
    return (labels.filter("doc_id is not null and quality is not null")
            .groupBy(F.col("doc_id").cast("bigint").alias("id"))
            .agg(F.min("quality").alias("lo"), F.max("quality").alias("hi"))
            .filter("lo = hi").select("id", F.col("lo").alias("quality")))


def ladder() -> list[list[float]]:
    """The cutoffs of each rung, in the order of ``METRICS``."""
    return [[LOOSE[m] * (STRICT[m] / LOOSE[m]) ** (j / (RUNGS - 1)) for m in METRICS]
            for j in range(RUNGS)]


def certify(counts: dict[str | None, tuple[int, list[int]]], alpha: float,
            delta: float) -> dict[str | None, tuple[int, float, float]]:
    """``counts``: per stratum, n and the false rejections of each rung.
    Returns, per stratum with one, the last certified rung, its bound and the
    level it was tested at."""
    names = sorted(counts, key=lambda s: (s is not None, s or ""))
    level = {s: delta / len(names) for s in names}
    passed, best = dict.fromkeys(names, 0), {}
    still_open, moved = list(names), True
    while moved:
        moved = False
        for s in list(still_open):
            n, wrong = counts[s]
            while passed[s] < len(wrong):
                bound = binomial_upper(wrong[passed[s]], n, level[s])
                if bound > alpha:
                    break
                best[s] = (passed[s], bound, level[s])
                passed[s] += 1
            if passed[s] == len(wrong):
                still_open.remove(s)
                for other in still_open:
                    level[other] += level[s] / len(still_open)
                moved = True
    return best


def fit_thresholds(measured: DataFrame, labels: DataFrame, alpha: float = 0.01,
                   delta: float = 0.05) -> DataFrame:
    """``(stratum, cutoffs array<double>, bound, rung, level)`` for each
    stratum with a certified rung.  ``measured``: ``id, stratum, s`` (the
    statistics)."""
    rungs = ladder()
    good = (measured.join(_clean_labels(labels).filter("quality = 1"), "id")
            .filter(~base_failed()).select("stratum", metric_array().alias("m")))
    rejects = [F.sum(F.exists(F.arrays_zip(F.col("m"), F.array(*map(F.lit, rung)).alias("c")),
                              lambda x: x["m"] > x["c"]).cast("bigint")).alias(f"k{j}")
               for j, rung in enumerate(rungs)]
    fewest = math.ceil(math.log(delta) / math.log1p(-alpha))
    rows = good.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *rejects).filter(
        F.col("n") >= fewest).collect()
    best = certify({r.stratum: (r.n, [r[f"k{j}"] for j in range(RUNGS)]) for r in rows},
                   alpha, delta) if rows else {}
    # written, so that Spark knows their size where they are joined
    return materialize(measured.sparkSession.createDataFrame(
        [(s, rungs[j], bound, j, level) for s, (j, bound, level) in best.items()],
        "stratum string, cutoffs array<double>, bound double, rung int, level double"), "cutoffs")


def stratum(docs: DataFrame, lang_col: str | None):
    return docs[lang_col].cast("string") if lang_col else F.lit("")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str | None = "lang") -> DataFrame:
    """``id, stratum, s`` per row, written to the shared folder."""
    return materialize(docs.select(docs[id_col].cast("bigint").alias("id"),
                                   stratum(docs, lang_col).alias("stratum"),
                                   stats_udf(docs[text_col]).alias("s")), "stats")


def judge(measured: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to rows that carry ``stratum`` and
    ``s``.  One row per stratum is joined on; skew in the strata is no matter
    where that side is broadcast, and split by AQE where it is not."""
    cut = thresholds.select(F.col("stratum").alias("_stratum"), F.col("cutoffs").alias("_cut"))
    joined = measured.join(cut, measured["stratum"].eqNullSafe(cut["_stratum"]), "left")
    beyond = F.coalesce(F.exists(F.arrays_zip(metric_array().alias("m"), F.col("_cut").alias("c")),
                                 lambda x: x["m"] > x["c"]), F.lit(False))
    return (joined.withColumn("base_failed", base_failed())
            .withColumn("kept", ~base_failed() & ~beyond).drop("_stratum", "_cut"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
              text_col: str = "text", lang_col: str | None = "lang", **risk) -> DataFrame:
    """The rows of ``docs`` the rules keep, with their own columns."""
    thresholds = fit_thresholds(measure(docs, id_col, text_col, lang_col), labels, **risk)
    rows = packed(docs, stratum=stratum(docs, lang_col), s=stats_udf(docs[text_col]))
    return unpacked(judge(rows, thresholds).filter("kept"), docs)


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                     text_col: str = "text", lang_col: str | None = "lang", **risk) -> DataFrame:
    """One row per row of ``docs``: the counts, the base rule and the verdict."""
    measured = measure(docs, id_col, text_col, lang_col)
    return judge(measured, fit_thresholds(measured, labels, **risk))
