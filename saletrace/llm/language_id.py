"""Language identification: script ranges, word scores, Viterbi over words.

*Training.*  Character n-grams (1 to 4, over each word with its ends marked)
are hashed to ``BUCKETS`` buckets and counted per language over a bounded
sample of about ``SAMPLE_DOCS`` training documents, by hash of the id, half of
it dealt evenly to the languages, so that a rare one is learned too; the
counting runs on the executors, and only counts (at most buckets x languages) reach
the driver.  A language's scripts are those that hold ``SCRIPT_SHARE`` or
more of its letters.

*Word scores.*  A word's dominant script range narrows the candidates to the
languages written in it (all, if none is).  Each candidate scores the mean
log-probability of the word's n-grams, times the root of its length, clipped
to ``CLIP`` below the best; the others score as far below again.

*Spans.*  Viterbi over the words of a text: a path's score is the sum of its
words' scores less ``SWITCH`` per change of language, so a foreign name does
not cut a span, but a foreign passage does.  Words without a letter score
nothing.  The longest share of letters names the document; its score is that
share times the mean posterior of its words against the other languages.

Documents of one batch are decoded together, sorted by length, one word
position at a time in numpy; each text is decoded whole.

Defined results.  Null text, or no letter: ``und``, score 0, no spans.  Null
id: predicted, not held out.  No training rows: ``und``.  Ties: the language
first in alphabetical order.  Repeated rows: one result row each.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, id_and_text, slices

BUCKETS, SAMPLE_DOCS, LEAST_DOCS = 1 << 16, 8000, 20
FOLDS, HELD_OUT = 4, 2
SWITCH, CLIP, SCRIPT_SHARE = 8.0, 6.0, 0.02
MAX_GRAM, GROUP = 4, 128
CACHE_WORDS = 400_000
UNKNOWN = "und"

#: first code point, script (fixed ranges of the Unicode blocks)
SCRIPTS = ((0x0, "Latin"), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "Armenian"),
           (0x590, "Hebrew"), (0x600, "Arabic"), (0x700, "Syriac"), (0x750, "Arabic"),
           (0x780, "Other"), (0x900, "Devanagari"), (0x980, "Bengali"), (0xA00, "Gurmukhi"),
           (0xA80, "Gujarati"), (0xB00, "Oriya"), (0xB80, "Tamil"), (0xC00, "Telugu"),
           (0xC80, "Kannada"), (0xD00, "Malayalam"), (0xD80, "Sinhala"), (0xE00, "Thai"),
           (0xE80, "Lao"), (0xF00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"),
           (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"), (0x1780, "Khmer"),
           (0x1800, "Mongolian"), (0x18B0, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
           (0x2000, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"), (0x2DE0, "Cyrillic"),
           (0x2E00, "Han"), (0x3040, "Kana"), (0x3100, "Bopomofo"), (0x3130, "Hangul"),
           (0x3190, "Han"), (0xA000, "Other"), (0xA640, "Cyrillic"), (0xA6A0, "Other"),
           (0xA720, "Latin"), (0xA800, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"),
           (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Armenian"), (0xFB1D, "Hebrew"),
           (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFE70, "Arabic"), (0xFF00, "Latin"),
           (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, "Other"), (0x20000, "Han"),
           (0x32000, "Other"))
_FIRST = [a for a, _ in SCRIPTS]
_LETTERS = re.compile(r"[^\W\d_]+")
_WORD = re.compile(r"\S+")


def script_of(word: str) -> str:
    """The script range of most of a word's letters."""
    if word.isascii():
        return "Latin"
    counts: dict[str, int] = {}
    for c in word:
        s = SCRIPTS[bisect.bisect_right(_FIRST, ord(c)) - 1][1]
        counts[s] = counts.get(s, 0) + 1
    return max(counts, key=lambda s: (counts[s], s))


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(number of the word, bucket)`` of every n-gram of every word."""
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"),
                          "<u4").astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), sizes)
    rows, buckets = [], []
    mixed = np.zeros(len(codes), np.uint64)
    for n in range(1, MAX_GRAM + 1):
        if len(codes) < n:
            break
        with np.errstate(over="ignore"):
            mixed = (mixed[:len(codes) - n + 1] * np.uint64(0x100000001B3)) + codes[n - 1:]
            h = (mixed + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        inside = owner[:len(mixed)] == owner[n - 1:]
        if n == 1:
            inside &= codes > 3
        rows.append(owner[:len(mixed)][inside])
        buckets.append((h >> np.uint64(48)).astype(np.int64)[inside])
    return np.concatenate(rows), np.concatenate(buckets)


class WordModel:
    """Word scores per language; a worker remembers the words it has seen."""

    def __init__(self, langs: list[str], logp: np.ndarray, scripts: dict[str, list[int]]):
        self.langs, self.logp, self.scripts = langs, logp.astype(np.float32), scripts
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1, len(langs)), np.float32)
        self.letters = np.zeros(1, np.int64)
        self.key = hashlib.sha256(
            self.logp.tobytes() + repr((langs, sorted(scripts.items()))).encode()).hexdigest()

    def lookup(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Row numbers of each text's chunks in the table of scores."""
        got = [list(map(self.rows.get, chunks)) for chunks in texts]
        new = {c for chunks, rows in zip(texts, got) if None in rows
               for c, r in zip(chunks, rows) if r is None}
        if new:
            self._learn(list(new))
            got = [list(map(self.rows.get, chunks)) if None in rows else rows
                   for chunks, rows in zip(texts, got)]
        return [np.array(rows, np.int64) for rows in got]

    def _learn(self, chunks: list[str]) -> None:
        words = ["".join(_LETTERS.findall(c)).lower() for c in chunks]
        real = [w for w in words if w]
        scores = np.zeros((len(chunks), len(self.langs)), np.float32)
        letters = np.array([len(w) for w in words])
        if real:
            row, bucket = gram_buckets(real)
            sums = np.stack([np.bincount(row, self.logp[bucket, k], len(real))
                             for k in range(len(self.langs))], 1)
            n = np.maximum(np.bincount(row, minlength=len(real)), 1)
            size = np.array([math.sqrt(len(w)) for w in real])
            value = sums / n[:, None] * size[:, None]
            value -= value.max(1, keepdims=True)
            value = np.maximum(value, -CLIP)
            written = ["Latin" if w.isascii() else script_of(w) for w in real]
            for script in set(written):
                allowed = self.scripts.get(script, ())
                barred = [k for k in range(len(self.langs)) if k not in allowed]
                if allowed and barred:
                    rows = np.flatnonzero([x == script for x in written])
                    value[rows[:, None], barred] = -2 * CLIP
            scores[letters > 0] = value
        start = len(self.table)
        self.rows.update(zip(chunks, range(start, start + len(chunks))))
        self.table = np.concatenate([self.table, scores])
        self.letters = np.concatenate([self.letters, letters])

    def forget(self) -> None:
        """Between batches: start anew once too many words are held."""
        if len(self.rows) > CACHE_WORDS:
            self.__init__(self.langs, self.logp, self.scripts)


#: cells (words x texts) of one padded group; a longer text goes alone
CELLS = 1 << 18


def _alike(scores: list[np.ndarray]) -> Iterator[list[int]]:
    """Texts of like length, padded to the longest of at most ``CELLS``."""
    part: list[int] = []
    for i in sorted(range(len(scores)), key=lambda i: len(scores[i])):
        if not len(scores[i]):
            continue
        if part and (len(part) == GROUP or len(scores[i]) * (len(part) + 1) > CELLS):
            yield part
            part = []
        part.append(i)
    if part:
        yield part


def viterbi(scores: list[np.ndarray], penalty: float = SWITCH) -> list[np.ndarray]:
    """The best path of each text's word scores (words x languages)."""
    out: list[np.ndarray] = [np.zeros(0, np.int16)] * len(scores)
    for part in _alike(scores):
        n, k = len(part), scores[part[0]].shape[1]
        sizes = np.array([len(scores[i]) for i in part])
        longest = sizes.max()
        s = np.zeros((longest, n, k), np.float32)
        for j, i in enumerate(part):
            s[:sizes[j], j] = scores[i]
        value = np.zeros((n, k), np.float32)
        source = np.zeros((longest, n), np.int16)     # best language before each position
        stay = np.ones((longest, n, k), bool)
        rows = np.arange(n)
        for t in range(longest):
            best = value.argmax(1)
            jump = value[rows, best][:, None] - penalty
            source[t], stay[t] = best, value >= jump
            value = np.maximum(value, jump) + s[t]
        state = value.argmax(1)
        path = np.zeros((longest, n), np.int16)
        for t in range(longest - 1, -1, -1):
            path[t] = state
            state = np.where(stay[t, rows, state], state, source[t])
        for j, i in enumerate(part):
            out[i] = path[:sizes[j], j].copy()
    return out


def label(texts: list[str], model: WordModel):
    """Per text: language, score, spans ``(start, end, language)``."""
    model.forget()
    found = [x.split() for x in texts]
    rows = model.lookup(found)
    scores = [model.table[r] for r in rows]
    for x, chunks, r, s, path in zip(texts, found, rows, scores, viterbi(scores)):
        letters = model.letters[r]
        if not letters.sum() or model.langs == [UNKNOWN]:
            yield UNKNOWN, 0.0, []
            continue
        weight = np.bincount(path, letters, len(model.langs))
        best = int(weight.argmax())
        own = (path == best) & (letters > 0)
        e = np.exp(s[own])
        posterior = float((e[:, best] / e.sum(1)).mean())
        yield (model.langs[best], float(weight[best] / weight.sum()) * posterior,
               _spans(x, chunks, path, model.langs))


def _spans(text: str, chunks: list[str], path: np.ndarray, langs: list[str]):
    """Runs of one language, as code points from first to last word."""
    cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
    if len(cuts) == 2:
        a = text.find(chunks[0])
        return [(a, len(text.rstrip()), langs[path[0]])]
    places = [m.span() for m in _WORD.finditer(text)]
    if len(places) != len(chunks):  # characters only str.split takes as space
        places, at = [], 0
        for c in chunks:
            at = text.index(c, at)
            places.append((at, at + len(c)))
            at += len(c)
    return [(places[a][0], places[b - 1][1], langs[path[a]]) for a, b in zip(cuts, cuts[1:])]


def _rate(n: int, counts: dict[str, int], sample: int) -> float:
    """The share sampled of a language's ``n`` rows.  Where not all rows fit,
    half of the sample is dealt by rows, the other half evenly (``LEAST_DOCS``
    at least) to the languages."""
    total = sum(counts.values())
    even = max(LEAST_DOCS, sample / 2 / len(counts))
    return 1.0 if total <= sample else min(1.0, max(sample / 2 / total, even / n))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample: int = SAMPLE_DOCS) -> WordModel | None:
    """A model from the training fold; None without training rows."""
    train = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("text"),
                        docs[lang_col].alias("lang"))
    train = train.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()
                         & F.col("id").isNotNull() & (fold(F.col("id"), FOLDS) != HELD_OUT))
    counts = {r.lang: r["count"] for r in train.groupBy("lang").count().collect()}
    if not counts:
        return None
    scale = 1 << 30
    cut = F.create_map(*[F.lit(x) for lang, n in counts.items()
                         for x in (lang, int(scale * _rate(n, counts, sample)) + 1)])
    chosen = train.filter(F.pmod(F.xxhash64("id", F.lit("lang")), F.lit(scale)) < cut[F.col("lang")])

    def count(batches):
        grams: dict[str, np.ndarray] = {}
        scripts: dict[tuple[str, str], int] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                words = [w.lower() for w in _LETTERS.findall(text)]
                if not words:
                    continue
                _, bucket = gram_buckets(words)
                grams.setdefault(lang, np.zeros(BUCKETS, np.int64))
                grams[lang] += np.bincount(bucket, minlength=BUCKETS)
                for w in words:
                    key = (lang, script_of(w))
                    scripts[key] = scripts.get(key, 0) + len(w)
        for lang, counts in grams.items():
            at = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "script": "", "bucket": at, "n": counts[at]})
        if scripts:
            yield pd.DataFrame({"lang": [a for a, _ in scripts], "script": [b for _, b in scripts],
                                "bucket": -1, "n": list(scripts.values())})

    counted = (chosen.select("text", "lang")
               .mapInPandas(count, "lang string, script string, bucket bigint, n bigint")
               .groupBy("lang", "script", "bucket").agg(F.sum("n").alias("n")).collect())
    langs = sorted({r.lang for r in counted})
    if not langs:
        return None
    number = {x: i for i, x in enumerate(langs)}
    table = np.full((BUCKETS, len(langs)), 0.5)
    letters: dict[str, dict[str, int]] = {x: {} for x in langs}
    for r in counted:
        if r.bucket >= 0:
            table[r.bucket, number[r.lang]] += r.n
        else:
            letters[r.lang][r.script] = r.n
    scripts: dict[str, list[int]] = {}
    for lang, own in letters.items():
        for script, n in own.items():
            if n >= SCRIPT_SHARE * sum(own.values()):
                scripts.setdefault(script, []).append(number[lang])
    return WordModel(langs, np.log(table / table.sum(0)), scripts)


_RESULT = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("lang", T.StringType())])))])


_held: dict[str, WordModel] = {}


def remembered(model: WordModel) -> WordModel:
    """This worker's own copy of a model, with the words it has seen in
    earlier tasks."""
    return _held.setdefault(model.key, model)


def label_udf(model: WordModel):
    @F.arrow_udf(_RESULT)
    def labelled(text: pa.Array) -> pa.Array:
        known = remembered(model)
        out = []
        for part in slices(text, 2048):
            out += label([x or "" for x in part], known)
        return pa.StructArray.from_arrays(
            [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64()),
             pa.array([[{"start": a, "end": b, "lang": x} for a, b, x in o[2]] for o in out],
                      pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                                          ("lang", pa.string())])))],
            names=["lang", "score", "spans"])
    return labelled


def languages(docs: DataFrame, model: WordModel | None, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The id, ``held_out, lang_pred, score`` and ``spans`` of every row."""
    rows = id_and_text(docs, id_col, text_col)
    if model is None:
        model = WordModel([UNKNOWN], np.zeros((BUCKETS, 1)), {})
    held = F.coalesce(fold(F.col("id"), FOLDS) == HELD_OUT, F.lit(False))
    return rows.select("id", label_udf(model)("text").alias("r")).select(
        F.col("id").alias(id_col), held.alias("held_out"), F.col("r.lang").alias("lang_pred"),
        F.col("r.score").alias("score"), F.col("r.spans").alias("spans"))
