"""Secret scans: fixed patterns, and a character convolutional network over
every other candidate in its context.

*Base.*  Three kinds of span, leftmost and non-overlapping per kind: ``assign``
(a key word, ``:`` or ``=``, six or more value characters), ``access`` (AKIA
identifiers of 20 or more) and ``hex`` (24 or more lower-case hex digits).
They always stand.

*Candidates.*  Every run of 12 or more token characters that has a digit; of a
run that base spans touch, every part outside them of which the same holds.
Shorter runs, and those without a digit, are never judged.

*Network.*  Windows of 40 characters slide over the whole candidate, 10 at a
time; each with the characters before and after it is embedded, convolved
(width 5), rectified and max-pooled for each of the three segments, and a
logistic layer reads the pools.  The candidate's score is its best window's.
The network is trained by
gradient descent on labelled findings: every distinct one of all documents (a
candidate that a base pattern confirms is a secret; one that none does is not,
or is left out where it has the form or the lead of a written secret), with all
its windows, and findings written out from publicly documented token formats
and their look-alikes (``written_findings``), which together weigh as much as
those of the documents at least.  The findings are dealt by hash to shards of
about ``SHARD_WINDOWS`` windows.  In each of ``EPOCHS`` rounds every shard, with
the written findings, goes through one epoch from the same network, and the
shards' networks are averaged by their windows.

*Thresholds.*  A third of the findings is held back: a logistic curve on the
raw scores, all counted in cells of ``1 / CELLS``, calibrates them (Platt), and the threshold is the highest
calibrated score at which the exact (Clopper-Pearson) lower confidence bound
of recall still reaches ``RECALL``, or 0.5 where that is lower: what is more
likely a secret than not is always one.  Fewer than 45 held-out secrets cannot
reach the bound; the lowest score among them is the threshold then.

Defined results.  Null or empty text: no spans.  Null ids and repeated rows
are carried through.  Without documents the network learns from the written
findings alone.
"""

from __future__ import annotations

import random
import re
import string

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, slices
from .quality_rules import binomial_upper

KINDS = ("assign", "access", "hex", "network")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
DIGIT = re.compile(r"[0-9]")
MIN_VALUE, MIN_ACCESS, MIN_HEX, MIN_CANDIDATE = 6, 20, 24, 12
TOKEN_CHARS = string.ascii_letters + string.digits + "+/_=-"
#: what the written secrets look like, or are led by
FORMS = re.compile(r"gh[a-z]_[A-Za-z0-9]{16}|[a-z]k_[a-z]+_[A-Za-z0-9]{16}|xox[a-z]-[A-Za-z0-9-]{16}"
                   r"|AIza[A-Za-z0-9_-]{16}|npm_[A-Za-z0-9]{16}|eyJ[A-Za-z0-9_-]{16}"
                   r"|(?:pwd|auth)=[A-Za-z0-9+/_-]{12}")
LEADS = re.compile(r"(?:bearer|credentials?|private.key|client.key|pwd|auth|\bkey)[\x20:='\"]+$",
                   re.IGNORECASE | re.ASCII)
_HEX_MAP = bytes(104 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
_HEX_RUN = b"h" * MIN_HEX

BEFORE, VALUE, AFTER, STEP = 24, 40, 8, 10
WIDTH = BEFORE + VALUE + AFTER
OTHER, PAD, ALPHABET = 128, 129, 130
PART = 50_000
SHARD_WINDOWS, EPOCHS, CELLS, MOST = 50_000, 12, 1024, 64
RECALL, CONFIDENCE = 0.95, 0.9


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base patterns, in order."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= MIN_ACCESS]
    if text.encode("utf-8", "surrogatepass").translate(_HEX_MAP).find(_HEX_RUN) >= 0:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)
                if m.end() - m.start() >= MIN_HEX]
    return sorted(out)


def _run(text: str, at: int) -> tuple[int, int]:
    """The run of token characters around position ``at``."""
    start, end = at, at + 1
    for step in (64, 1024, 1 << 14, 1 << 18, 1 << 22, len(text)):
        part = text[max(0, start - step):start]
        kept = len(part) - len(part.rstrip(TOKEN_CHARS))
        start -= kept
        if kept < step:
            break
    for step in (64, 1024, 1 << 14, 1 << 18, 1 << 22, len(text)):
        part = text[end:end + step]
        kept = len(part) - len(part.lstrip(TOKEN_CHARS))
        end += kept
        if kept < step:
            break
    return start, end


def candidates(text: str) -> list[tuple[int, int]]:
    """``(start, end)`` of every run of token characters with a digit."""
    out, at = [], 0
    while m := DIGIT.search(text, at):
        start, end = _run(text, m.start())
        if end - start >= MIN_CANDIDATE:
            out.append((start, end))
        at = end
    return out


def uncovered(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The candidates, and of those that base spans touch the parts outside
    them that are candidates by themselves."""
    out, first = [], 0
    for a, b in candidates(text):
        while first < len(base) and base[first][2] <= a:
            first += 1
        at, whole = a, True
        for i in range(first, len(base)):
            s, _, e = base[i]
            if s >= b:
                break
            if e > at:
                out += _part(text, at, s)
                at, whole = e, False
        out += [(a, b)] if whole else _part(text, at, b)
    return out


def _part(text: str, start: int, end: int) -> list[tuple[int, int]]:
    long = end - start >= MIN_CANDIDATE
    return [(start, end)] if long and DIGIT.search(text, start, end) else []


def windows(text: str, start: int, end: int) -> np.ndarray:
    """Rows of ``WIDTH`` alphabet codes over the whole of a candidate and its
    context: one for each ``VALUE`` characters at every ``STEP`` of it, the
    last one flush with its end."""
    part = text[max(0, start - BEFORE):end + AFTER]
    raw = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
    size, lead = end - start, start - max(0, start - BEFORE)
    codes = np.full(BEFORE + max(size, VALUE) + AFTER, PAD, np.uint8)
    codes[BEFORE - lead:BEFORE + size] = np.minimum(raw[:lead + size], OTHER)
    after = np.minimum(raw[lead + size:], OTHER)
    at = BEFORE + max(size, VALUE)
    codes[at:at + len(after)] = after
    return sliding_window_view(codes, WIDTH)[offsets(size)]


def offsets(size: int) -> np.ndarray:
    """Where the windows over a candidate of ``size`` characters start."""
    last = max(0, size - VALUE)
    return np.append(np.arange(0, last, STEP), last)


class CharNetwork:
    """Embedding, one convolution, segment max-pooling, logistic output."""

    DIM, SPAN, FILTERS = 8, 5, 24
    CUTS = (0, BEFORE - 2, BEFORE + VALUE - 2, WIDTH - SPAN + 1)

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {"e": r.normal(0, 0.4, (ALPHABET, self.DIM)),
                  "w": r.normal(0, 0.2, (self.SPAN * self.DIM, self.FILTERS)),
                  "b": np.zeros(self.FILTERS),
                  "v": r.normal(0, 0.2, 3 * self.FILTERS), "c": np.zeros(1)}
        self.scale, self.offset, self.threshold = 1.0, 0.0, 0.5

    def _forward(self, x: np.ndarray):
        e = self.p["e"][x]
        n = x.shape[1] - self.SPAN + 1
        cols = np.concatenate([e[:, k:k + n] for k in range(self.SPAN)], axis=2)
        h = np.maximum(cols @ self.p["w"] + self.p["b"], 0)
        at = np.stack([h[:, a:b].argmax(1) + a for a, b in zip(self.CUTS, self.CUTS[1:])], 1)
        pooled = np.take_along_axis(h, at, 1)
        return cols, at, pooled, pooled.reshape(len(x), -1) @ self.p["v"] + self.p["c"][0]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i:i + 1024])[3] for i in range(0, len(x), 1024)]
                              or [np.zeros(0)])

    def best(self, x: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
        """The raw score of each candidate, whose windows start at ``first``
        (by default each row is a candidate)."""
        z = self.raw(x)
        return z if first is None or not len(z) else np.maximum.reduceat(z, first)

    def score(self, x: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
        """Calibrated probabilities."""
        return self._calibrated(self.best(x, first))

    def _calibrated(self, z):
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.offset, -30, 30)))

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 4e-3,
              seed: int = 3, weight: np.ndarray | None = None) -> None:
        r, state = np.random.default_rng(seed), None
        for _ in range(epochs):
            state = self.epoch(x, y, r.permutation(len(x)), weight, rate, state)

    def epoch(self, x: np.ndarray, y: np.ndarray, order: np.ndarray,
              weight: np.ndarray | None = None, rate: float = 4e-3, state=None):
        """One pass in ``order``; returns the optimizer's state (two moments
        and the steps taken) for the next one."""
        weight = np.ones(len(x)) if weight is None else weight
        m, s, step = state or ({k: np.zeros_like(v) for k, v in self.p.items()},
                               {k: np.zeros_like(v) for k, v in self.p.items()}, 0)
        for i in range(0, len(x), 64):
            rows = order[i:i + 64]
            grads, step = self._gradients(x[rows], y[rows], weight[rows]), step + 1
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
        return m, s, step

    def _gradients(self, x: np.ndarray, y: np.ndarray,
                   weight: np.ndarray | float = 1.0) -> dict[str, np.ndarray]:
        cols, at, pooled, z = self._forward(x)
        dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight / len(x)
        flat = pooled.reshape(len(x), -1)
        dpool = (dz[:, None] * self.p["v"]).reshape(pooled.shape) * (pooled > 0)
        taken = cols[np.arange(len(x))[:, None, None], at]
        dw = np.einsum("nsfd,nsf->df", taken, dpool)
        dcols = dpool[..., None] * self.p["w"].T
        de = np.zeros_like(self.p["e"])
        n = np.arange(len(x))[:, None, None]
        for k in range(self.SPAN):
            np.add.at(de, x[n, at + k], dcols[..., k * self.DIM:(k + 1) * self.DIM])
        return {"e": de, "w": dw + 1e-4 * self.p["w"], "b": dpool.sum((0, 1)),
                "v": flat.T @ dz + 1e-4 * self.p["v"], "c": dz.sum(keepdims=True)}

    def calibrate(self, x: np.ndarray, y: np.ndarray, first: np.ndarray | None = None,
                  weight: np.ndarray | float = 1.0) -> None:
        """``calibrate_scores`` on candidates, which ``y`` labels."""
        self.calibrate_scores(self.best(x, first), y, weight)

    def calibrate_scores(self, z: np.ndarray, y: np.ndarray, weight: np.ndarray | float = 1.0,
                         count: np.ndarray | None = None) -> None:
        """Platt scaling by Newton steps, then the recall-constrained cut, on
        raw scores that each stand for ``count`` candidates."""
        count = np.ones(len(z), np.int64) if count is None else count
        weight = weight * count
        a, b = 1.0, 0.0
        true, false = (y * count).sum(), ((1 - y) * count).sum()
        hi, lo = (true + 1) / (true + 2), 1 / (false + 2)
        t = np.where(y > 0, hi, lo)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            d = weight * (p - t)
            g = np.array([(d * z).sum(), d.sum()])
            w = weight * np.maximum(p * (1 - p), 1e-9)
            h = np.array([[(w * z * z).sum(), (w * z).sum()], [(w * z).sum(), w.sum()]])
            move = np.linalg.solve(h + 1e-6 * np.eye(2), g)
            a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
        self.scale, self.offset = float(max(a, 1e-3)), float(b)
        secret = np.flatnonzero(y > 0)
        secret = secret[np.argsort(z[secret], kind="stable")]
        upto = np.cumsum(count[secret])
        total = int(upto[-1]) if len(upto) else 0
        # held-out secrets that the cut may miss: the most whose bound holds
        lost, above = 0, max(total, 1)
        while above - lost > 1:
            mid = (lost + above) // 2
            if binomial_upper(mid, total, 1 - CONFIDENCE) <= 1 - RECALL:
                lost = mid
            else:
                above = mid
        cut = z[secret[np.searchsorted(upto, lost, side="right")]] if total else 0.0
        self.threshold = min(0.5, float(self._calibrated(cut))) if total else 0.5


def begins(at: int, start: int, end: int) -> bool:
    """Whether the window at ``at`` of a run holds the beginning of the
    secret ``start`` to ``end``, or its first ``VALUE - STEP`` characters."""
    return at <= start and min(end, at + VALUE) - start >= min(end - start, VALUE - STEP)


def format_findings(count: int = 1500, seed: int = 11) -> list[tuple[bytes, int]]:
    """The labelled windows of findings that stand alone: ``(window, label)``."""
    return [(w.tobytes(), y) for rows, labels in _findings(count, seed, False)
            for w, y in zip(rows, labels) if y >= 0]


def written_findings(count: int = 1500, seed: int = 11) -> list[tuple[np.ndarray, list[int]]]:
    """Findings written out from public formats, ``count`` that stand alone
    and as many in a longer run."""
    return [f for two in zip(_findings(count, seed, False), _findings(count, seed + 1, True))
            for f in two]


def _findings(count: int, seed: int, glued: bool) -> list[tuple[np.ndarray, list[int]]]:
    """A candidate's windows, and a label for each (-1: only a part of the
    secret is seen, none)."""
    r = random.Random(seed)
    low, alnum = string.ascii_lowercase, string.ascii_letters + string.digits
    pick = lambda chars, n: "".join(r.choices(chars, k=n))
    hexa = "0123456789abcdef"
    word = lambda: pick(low, r.randint(2, 9))
    secrets = [
        lambda: ("", "ghp_" + pick(alnum, 36)), lambda: ("", "sk_live_" + pick(alnum, 24)),
        lambda: ("", "xoxb-" + pick(string.digits, 11) + "-" + pick(alnum, 24)),
        lambda: ("key ", "AIza" + pick(alnum + "_-", 35)), lambda: ("", "npm_" + pick(alnum, 36)),
        lambda: ("Authorization: Bearer ", pick(alnum + "_-", r.randint(20, 60))),
        lambda: ("pwd=", pick(alnum, r.randint(12, 24))),
        lambda: ("client_key = '", pick(alnum + "+/", 40)),
        lambda: ("private key: ", pick(alnum + "+/", 44) + "="),
        lambda: ("credentials ", pick(alnum + "+/", r.randint(24, 44))),
        lambda: ("eyJ" + pick(alnum, 20) + ".", "eyJ" + pick(alnum + "_-", 40)),
        lambda: ("auth=", pick(alnum, r.randint(20, 40)))]
    others = [
        lambda: ("id ", "-".join(pick(hexa, n) for n in (8, 4, 4, 4, 12))),
        lambda: ("commit ", pick(hexa, 20)), lambda: ("card ", pick(string.digits, 16)),
        lambda: ("phone ", pick(string.digits, 12)), lambda: ("", f"{word()}-{word()}-20{pick(string.digits, 2)}"),
        lambda: ("on ", f"20{pick(string.digits, 2)}-0{r.randint(1, 9)}-1{r.randint(0, 9)}T10"),
        lambda: ("/", f"{word()}/{word()}/{pick(string.digits, 5)}"),
        lambda: ("", f"{word()}_{word()}_{pick(string.digits, 3)}"),
        lambda: ("isbn ", f"978-{pick(string.digits, 10)}"),
        lambda: ("", f"{word()}{word()}{pick(string.digits, 2)}"),
        lambda: (f"{word()}@", f"{word()}{pick(string.digits, 2)}-{word()}"),
        lambda: ("data:image/png;base64,", pick(alnum + "+/", 60))]
    inside = [*secrets[:5], lambda: ("pwd=", pick(alnum, r.randint(12, 24))),
              lambda: ("auth=", pick(alnum, r.randint(20, 40)))]
    piece = lambda: r.choice([word, word, word, lambda: pick(string.digits, 2)])()
    out = []
    for i in range(count):
        label = i % 2
        lead, value = r.choice((inside if glued else secrets) if label else others)()
        before = after = ""
        if glued:
            by = r.choice("//_-")
            before = "".join(by + piece() for _ in range(r.randint(1, 12))) + by
            after = "".join(by + piece() for _ in range(r.randint(0, 8)))
            before, lead = before + (lead if lead.endswith("=") else ""), ""
        head = " ".join(word() for _ in range(5)) + r.choice([" ", " ", "\n", ": "]) + lead
        run = before + value + after
        text = head + run + r.choice([" ", ".", "\n", "\"", ", "]) + word() + " " + word()
        rows = windows(text, len(head), len(head) + len(run))
        start, end = len(before), len(before) + len(value)
        out.append((rows, [0 if not label or at + VALUE + AFTER <= start or at - BEFORE >= end
                           else 1 if begins(at, start, end) else -1
                           for at in offsets(len(run)).tolist()]))
    return out


_FOUND = T.ArrayType(T.StructType([T.StructField("windows", T.BinaryType()),
                                   T.StructField("labels", T.ArrayType(T.IntegerType())),
                                   T.StructField("label", T.IntegerType())]))


def written_form(text: str, start: int, end: int) -> bool:
    """Whether a candidate has the form or the lead of a written secret."""
    return bool(FORMS.search(text, start, end)
                or LEADS.search(text[max(0, start - BEFORE):start]))


def labelled(text: str) -> list[tuple[np.ndarray, list[int], int]]:
    """The windows of each candidate, a label for each, and the candidate's own.  One in a written secret's form
    that no base pattern confirms has no label and is left out."""
    out, base = [], base_spans(text)
    for a, b in candidates(text):
        hits = [(max(s, a) - a, min(e, b) - a) for s, _, e in base if s < b and a < e]
        if not hits and written_form(text, a, b):
            continue
        rows, at = windows(text, a, b), offsets(b - a)
        labels = np.array([-1 if hits else 0] * len(at))
        for s, e in hits:
            labels[[begins(i, s, e) for i in at.tolist()]] = 1
        out.append((rows, labels.tolist(), int(bool(hits))))
    return out


@F.arrow_udf(_FOUND)
def _labelled_udf(text: pa.Array) -> pa.Array:
    rows = [[{"windows": w.tobytes(), "labels": y, "label": label} for w, y, label in labelled(x or "")]
            for part in slices(text) for x in part]
    return pa.array(rows, pa.list_(pa.struct([("windows", pa.binary()),
                                              ("labels", pa.list_(pa.int32())),
                                              ("label", pa.int32())])))


def fit(written: list[tuple[np.ndarray, list[int]]],
        sample: list[tuple[np.ndarray, list[int]]] = ()) -> CharNetwork:
    """A network of findings (windows and their labels); a third of them
    calibrates it.  The written ones together weigh as much as the sample, or
    more."""
    network, findings = CharNetwork(), [*sample, *written]
    kept = [i for i in range(len(findings)) if i % 3 != 2]
    x, y = (np.concatenate([np.asarray(findings[i][k]) for i in kept]) for k in (0, 1))
    own = np.repeat([i >= len(sample) for i in kept], [len(findings[i][0]) for i in kept])
    known = y >= 0
    network.train(x[known], y[known].astype(float), weight=_balance(own[known]))
    held = findings[2::3]
    network.calibrate(np.concatenate([w for w, _ in held]),
                      np.array([float(max(labels) > 0) for _, labels in held]),
                      np.cumsum([0, *[len(w) for w, _ in held[:-1]]]),
                      _balance(np.arange(2, len(findings), 3) >= len(sample)))
    return network


def _balance(own: np.ndarray) -> np.ndarray:
    """Weights of mean 1 that give the ``own`` rows half of the total, or
    their share where that is larger."""
    w = np.where(own, max(1.0, (~own).sum() / max(1, own.sum())), 1.0)
    return w / w.mean()


_KEYS = ("e", "w", "b", "v", "c")


def _packed(network: CharNetwork, state) -> np.ndarray:
    parts = [d[k].ravel() for d in (network.p, *state[:2]) for k in _KEYS]
    return np.concatenate([*parts, [float(state[2])]])


def _unpacked(packed: np.ndarray):
    """The network and the optimizer's state of a row of :func:`_packed`."""
    network, at, dicts = CharNetwork(), 0, []
    for _ in range(3):
        dicts.append({})
        for k in _KEYS:
            like = network.p[k]
            dicts[-1][k] = packed[at:at + like.size].reshape(like.shape).copy()
            at += like.size
    network.p = dicts[0]
    return network, (dicts[1], dicts[2], int(round(packed[at])))


def _shards(batches):
    """``shard, windows, labels`` of the findings in each shard, in the order
    of their bytes."""
    held: dict[int, list] = {}
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "windows", "labels"))):
            held.setdefault(row[0], []).append(row[1:])
    for shard in sorted(held):
        rows = sorted(held.pop(shard))
        yield (shard, np.frombuffer(b"".join(w for w, _ in rows), np.uint8).reshape(-1, WIDTH),
               np.concatenate([np.asarray(y) for _, y in rows]))


def _round(number: int, packed: np.ndarray, written):
    """One epoch of each shard from the same network."""
    def run(batches):
        for shard, x, y in _shards(batches):
            network, state = _unpacked(packed)
            wx, wy = written.value
            known = y >= 0
            x, y = np.concatenate([x[known], wx]), np.concatenate([y[known], wy]).astype(float)
            own = np.arange(len(x)) >= known.sum()
            order = np.random.default_rng([3, number, shard]).permutation(len(x))
            state = network.epoch(x, y, order, _balance(own), state=state)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int64()), "n": pa.array([len(x)], pa.int64()),
                "packed": pa.array([_packed(network, state).tobytes()], pa.binary())})
    return run


def _cells(packed: np.ndarray):
    """How many held-out findings of either label score in each cell."""
    def run(batches):
        network = _unpacked(packed)[0]
        for batch in batches:
            for part in range(0, len(batch), 256):
                rows = batch.slice(part, 256)
                sets = [np.frombuffer(w, np.uint8).reshape(-1, WIDTH)
                        for w in rows.column("windows").to_pylist()]
                first = np.cumsum([0, *[len(w) for w in sets[:-1]]])
                z = np.clip(network.best(np.concatenate(sets), first), -MOST, MOST)
                yield pa.RecordBatch.from_pydict({
                    "cell": pa.array(np.floor(z * CELLS).astype(np.int64)),
                    "label": rows.column("label")})
    return run


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          epochs: int = EPOCHS) -> CharNetwork:
    """A network from every distinct finding of all documents and from
    ``written_findings``.  The findings stay on the executors; the driver gets
    a network from each shard and the held-out scores counted in cells."""
    spark, written = docs.sparkSession, written_findings()
    found = (docs.select(F.explode(_labelled_udf(docs[text_col])).alias("f")).select("f.*")
             .dropDuplicates(["windows", "labels"])
             .withColumn("_h", F.xxhash64("windows", "labels", F.lit("secrets"))))
    found = materialize(found, "secret-findings")
    total = found.agg(F.sum(F.size("labels"))).first()[0]
    if not total:
        return fit(written)
    shards = -(-int(total) // SHARD_WINDOWS)
    held = F.pmod("_h", F.lit(3)) == 2
    kept = materialize(found.where(~held).withColumn("shard", F.pmod(F.expr("_h DIV 3"), F.lit(shards)))
                       .repartition(shards, "shard").select("shard", "windows", "labels"),
                       "secret-shards")
    x, y = (np.concatenate([np.asarray(f[k]) for i, f in enumerate(written) if i % 3 != 2])
            for k in (0, 1))
    sent = spark.sparkContext.broadcast((x[y >= 0], y[y >= 0]))
    network = CharNetwork()
    zero = {k: np.zeros_like(v) for k, v in network.p.items()}
    packed = _packed(network, (zero, zero, 0))
    for number in range(epochs):
        rows = sorted(kept.mapInArrow(_round(number, packed, sent), "shard long, n long, packed binary")
                      .collect())
        if not rows:  # all findings are held out
            return fit(written)
        packed = np.average([np.frombuffer(r.packed) for r in rows], axis=0,
                            weights=[r.n for r in rows])
    network = _unpacked(packed)[0]
    cells = (found.where(held).select("windows", "label").mapInArrow(_cells(packed), "cell long, label int")
             .groupBy("cell", "label").count().orderBy("cell", "label").collect())
    own = written[2::3]
    z = network.best(np.concatenate([w for w, _ in own]), np.cumsum([0, *[len(w) for w, _ in own[:-1]]]))
    count = np.array([r["count"] for r in cells] + [1] * len(own), np.int64)
    mine = np.arange(len(count)) >= len(cells)
    weight = np.where(mine, max(1.0, count[~mine].sum() / len(own)), 1.0)
    network.calibrate_scores(
        np.concatenate([np.array([r.cell / CELLS for r in cells]), z]),
        np.concatenate([np.array([float(r.label) for r in cells]),
                        [float(max(labels) > 0) for _, labels in own]]),
        weight / (weight * count).sum() * count.sum(), count)
    return network


def all_spans(texts: list[str], network: CharNetwork) -> list[list[tuple[int, int, int, float]]]:
    """``(start, kind number, end, score)`` per text, in order."""
    out, where, parts, held = [], [], [], 0
    best: dict[tuple[int, int, int], float] = {}

    def flush():
        if parts:
            first = np.cumsum([0, *[len(w) for w in parts[:-1]]])
            for key, p in zip(where, network.score(np.concatenate(parts), first).tolist()):
                best[key] = max(p, best.get(key, 0.0))
            where.clear()
            parts.clear()

    for i, text in enumerate(texts):
        base = base_spans(text)
        out.append([(s, k, e, 1.0) for s, k, e in base])
        for a, b in uncovered(text, base):
            for at in range(a, max(a + 1, b - VALUE), PART):  # of a very long one, a part at a time
                where.append((i, a, b))
                parts.append(windows(text, at, min(b, at + PART + VALUE)))
                held += len(parts[-1])
                if held > PART:
                    flush()
                    held = 0
    flush()
    for (i, a, b), p in best.items():
        if p >= network.threshold:
            out[i].append((a, 3, b, p))
    return [sorted(x) for x in out]


_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()),
                                   T.StructField("start", T.LongType()),
                                   T.StructField("end", T.LongType()),
                                   T.StructField("score", T.DoubleType())]))


def spans_udf(network: CharNetwork):
    @F.arrow_udf(_SPANS)
    def spans(text: pa.Array) -> pa.Array:
        rows = [r for part in slices(text) for r in all_spans([x or "" for x in part], network)]
        return pa.array([[{"kind": KINDS[k], "start": s, "end": e, "score": p}
                          for s, k, e, p in row] for row in rows],
                        pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                            ("end", pa.int64()), ("score", pa.float64())])))
    return spans


def scan(docs: DataFrame, network: CharNetwork, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``id_col, spans`` for each row; offsets are code points, end exclusive."""
    return docs.select(docs[id_col].cast("bigint").alias(id_col),
                       spans_udf(network)(docs[text_col]).alias("spans"))


def redact(docs: DataFrame, network: CharNetwork, text_col: str = "text",
           mask: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced (null stays null)."""
    @F.arrow_udf(T.StringType())
    def masked(text: pa.Array) -> pa.Array:
        out = []
        for texts in slices(text):
            for x, found in zip(texts, all_spans([x or "" for x in texts], network)):
                parts, at = [], 0
                for s, _, e, _ in found:
                    if e > at:
                        parts += [x[at:s], mask] if s >= at else []
                        at = e
                out.append(x if not found else "".join([*parts, x[at:]]))
        return pa.array(out, pa.string())
    return docs.withColumn(text_col, masked(docs[text_col]))
