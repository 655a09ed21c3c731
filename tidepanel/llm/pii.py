"""Personal data by patterns and a character-level BiLSTM with a CRF.

Patterns give the base spans.  A small bidirectional LSTM over characters,
with a linear-chain CRF on top, is trained in numpy on the labelled spans of a
bounded sample (and on rewritten forms of them that the patterns miss).  It
adds spans; base spans always stay.

Long texts are scored in overlapping windows.  Every position takes its tag
scores from the window in whose middle it lies, and one Viterbi pass over each
stretch of such scores decides its tags, so a span that crosses windows is
found whole.  A span needs a digit or an "@" to count, so windows that hold
neither are not scored: no span could come of them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, ship_package, slices

KINDS = ("email", "ip", "card", "phone")
#: Documents the model is trained on, at most, and their length, at most (those of smallest hash).
SAMPLE_DOCS, SAMPLE_CHARS = 1_500, 20_000
WINDOW, STRIDE = 192, 128
MARGIN = (WINDOW - STRIDE) // 2

Span = tuple[int, int, int]  # kind, start, end

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# possessive runs: a digit run is tried once, from its first digit
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]+")
DATE = re.compile(r"(?:[0-9]{4}([-./ ])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-./ ])[0-9]{1,2}\2[0-9]{4})")


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(ch for ch in s if "0" <= ch <= "9")


def small_parts(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """An address has one "@": its name is the run before it, back to the match before."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by kind and then start; per kind leftmost and non-overlapping."""
    out: list[Span] = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if not TRIGGER.search(text):
        return out
    out += [(1, *m.span()) for m in IP.finditer(text) if small_parts(m[0])]
    out += [(2, *m.span()) for m in CARD.finditer(text) if m.end() - m.start() >= 16 and 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return out


def plausible(kind: int, s: str) -> bool:
    """What a span of the model must look like to be added."""
    d = digits_of(s)
    if kind == 0:
        return bool(re.fullmatch(r"[^\s@]+ ?@ ?[^\s@]+\.[A-Za-z]{2,}", s))
    if kind == 1:
        return bool(re.fullmatch(r"[0-9]+(?:[. ]+[0-9]+){3}", s)) and small_parts(re.sub(r"[. ]+", ".", s))
    if kind == 2:
        return 13 <= len(d) <= 19 and luhn(d) and bool(re.fullmatch(r"[0-9][0-9 .\-/]*[0-9]", s))
    return 8 <= len(d) <= 15 and not DATE.fullmatch(s) and bool(re.fullmatch(r"[+(]?[0-9][0-9 ().\-/]*[0-9]", s))


# ---- model

def _classes() -> np.ndarray:
    """Class of each Latin-1 code point: ASCII letters by letter, digits and marks by themselves, the rest by sort."""
    t = np.zeros(257, np.int64)
    for cp in range(256):
        ch = chr(cp)
        if "a" <= ch <= "z":
            t[cp] = cp - 97
        elif "A" <= ch <= "Z":
            t[cp] = 26
        elif "0" <= ch <= "9":
            t[cp] = 27
        elif ch in "@.-+() _%/:,;'\"":
            t[cp] = 28 + "@.-+() _%/:,;'\"".index(ch)
        else:
            t[cp] = 43 if ch.isspace() else 44 if ch.isalpha() else 45
    t[256] = 46  # beyond Latin-1
    return t


CLASS_OF = _classes()
PAD, N_CLASSES = 47, 48
K = 1 + len(KINDS)


def encode(text: str) -> np.ndarray:
    return CLASS_OF[np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), 256)]


@dataclass
class Tagger:
    """Weights by name: per direction d in "fb" Wd (class x 4H), Ud (H x 4H), then V (2H x K), a (K), A (K x K), s (K)."""

    w: dict[str, np.ndarray]

    @property
    def hidden(self) -> int:
        return len(self.w["Uf"])


def new_tagger(hidden: int, rng: np.random.Generator) -> Tagger:
    w = {}
    for d in "fb":
        w[f"W{d}"] = rng.normal(0, 0.3, (N_CLASSES, 4 * hidden))
        w[f"W{d}"][:, hidden:2 * hidden] += 1.0  # forget gates start open
        w[f"U{d}"] = rng.normal(0, hidden ** -0.5, (hidden, 4 * hidden))
    w["V"], w["a"] = rng.normal(0, hidden ** -0.5, (2 * hidden, K)), np.zeros(K)
    w["A"], w["s"] = np.zeros((K, K)), np.zeros(K)
    return Tagger({k: v.astype(np.float32) for k, v in w.items()})


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(x: np.ndarray, w: np.ndarray, u: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """One direction over x (T, N): hidden states (T, N, H), and what the way back needs."""
    t, n = x.shape
    h = len(u)
    hs, hid, c, saved = np.empty((t, n, h), np.float32), np.zeros((n, h), np.float32), np.zeros((n, h), np.float32), []
    for i in range(t):
        z = w[x[i]]
        z += hid @ u
        g = np.tanh(z[:, 3 * h:])
        gates = _sigmoid(z[:, :3 * h])
        c_old = c
        c = gates[:, h:2 * h] * c_old + gates[:, :h] * g
        tc = np.tanh(c)
        if keep:
            saved.append((hid, c_old, gates, g, tc))
        hid = gates[:, 2 * h:] * tc
        hs[i] = hid
    return hs, saved


def _run_back(x: np.ndarray, u: np.ndarray, saved: list, dhs: np.ndarray, gw: np.ndarray, gu: np.ndarray) -> None:
    h = len(u)
    dh = dc = np.zeros_like(saved[0][0])
    for i in range(len(saved) - 1, -1, -1):
        hid, c_old, gates, g, tc = saved[i]
        dh = dh + dhs[i]
        do = dh * tc
        dc = dc + dh * gates[:, 2 * h:] * (1 - tc * tc)
        dz = np.concatenate([dc * g, dc * c_old, do], 1) * gates * (1 - gates)
        dz = np.concatenate([dz, dc * gates[:, :h] * (1 - g * g)], 1)
        np.add.at(gw, x[i], dz)
        gu += hid.T @ dz
        dh = dz @ u.T
        dc = dc * gates[:, h:2 * h]


def scores(m: Tagger, x: np.ndarray) -> np.ndarray:
    """Tag scores (T, N, K) of windows x (T, N) of character classes."""
    w = m.w
    f, _ = _run(x, w["Wf"], w["Uf"], False)
    b, _ = _run(x[::-1], w["Wb"], w["Ub"], False)
    h = m.hidden
    return f @ w["V"][:h] + b[::-1] @ w["V"][h:] + w["a"]


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def loss_and_gradients(m: Tagger, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log-likelihood of tags y (T, N) under the CRF, and its gradients."""
    w, h = m.w, m.hidden
    t, n = x.shape
    f, sf = _run(x, w["Wf"], w["Uf"], True)
    b, sb = _run(x[::-1], w["Wb"], w["Ub"], True)
    hs = np.concatenate([f, b[::-1]], 2)
    e = hs @ w["V"] + w["a"]
    al, be = np.empty_like(e), np.zeros_like(e)
    al[0] = e[0] + w["s"]
    for i in range(1, t):
        al[i] = e[i] + _logsumexp(al[i - 1][:, :, None] + w["A"], 1)
    for i in range(t - 2, -1, -1):
        be[i] = _logsumexp(w["A"] + (e[i + 1] + be[i + 1])[:, None, :], 2)
    z = _logsumexp(al[-1], 1)
    de = np.exp(al + be - z[None, :, None])
    pair = np.exp(al[:-1, :, :, None] + w["A"] + (e[1:] + be[1:])[:, :, None, :] - z[None, :, None, None]).sum((0, 1))
    rows, cols = np.arange(t)[:, None], np.arange(n)
    gold = e[rows, cols, y].sum() + w["s"][y[0]].sum() + w["A"][y[:-1], y[1:]].sum()
    de[rows, cols, y] -= 1
    np.subtract.at(pair, (y[:-1].ravel(), y[1:].ravel()), 1)
    gs = de[0].sum(0)
    grad = {"A": pair / n, "s": gs / n, "a": de.sum((0, 1)) / n, "V": np.einsum("tnh,tnk->hk", hs, de) / n}
    dh = de @ w["V"].T / n
    for d, xs, saved, back in (("f", x, sf, dh[:, :, :h]), ("b", x[::-1], sb, dh[::-1, :, h:])):
        grad[f"W{d}"], grad[f"U{d}"] = np.zeros_like(w[f"W{d}"]), np.zeros_like(w[f"U{d}"])
        _run_back(xs, w[f"U{d}"], saved, back, grad[f"W{d}"], grad[f"U{d}"])
    return float(z.sum() - gold) / n, grad


def _letters(rng: np.random.Generator, least: int, most: int) -> str:
    return "".join(chr(97 + int(c)) for c in rng.integers(0, 26, int(rng.integers(least, most + 1))))


def rewritten(kind: int, s: str, rng: np.random.Generator) -> str:
    """Another way to write a labelled span, mostly one the patterns miss."""
    d = digits_of(s)
    if kind == 0:
        name, host = s.split("@")
        if rng.random() < 0.6:
            name = _letters(rng, 2, 9) + (("." + _letters(rng, 2, 9)) if rng.random() < 0.4 else "")
        if rng.random() < 0.6:
            host = _letters(rng, 3, 10) + "." + ("com", "org", "net", "de", "co.uk")[rng.integers(5)]
        return name + (" @ ", "@ ", " @")[rng.integers(3)] + host
    if kind == 1:
        return (". ", " . ", " .")[rng.integers(3)].join(s.split("."))
    if kind == 2:
        return (".", "/", ".", "/", " ", "-")[rng.integers(6)].join(d[i:i + 4] for i in range(0, len(d), 4))
    form = rng.integers(8)
    if len(d) >= 10 and form < 6:
        a, b, c = d[-10:-7], d[-7:-4], d[-4:]
        return (f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}) {b} {c}", f"{a} {b} {c}", f"({a}){b}-{c}")[form]
    mark = ("-", " ", ".")[rng.integers(3)]
    if form % 2 or len(d) < 9:
        return d[-8:-4] + mark + d[-4:]
    return mark.join((d[-9:-6], d[-6:-3], d[-3:]))


def decoy(rng: np.random.Generator) -> str:
    """Digits that are nobody's: dates, times, amounts, versions, numbers of things."""
    n = rng.integers(0, 10, 12)
    d = "".join(map(str, n))
    return (f"20{d[:2]}-0{1 + n[2] % 9}-1{d[3]}", f"1{d[0]}.0{1 + n[1] % 9}.20{d[2:4]}", f"0{1 + n[0] % 9}/1{d[1]}/19{d[2:4]}", f"1{n[0] % 10}:{n[1] % 6}{d[2]}",
            f"{d[:1]},{d[1:4]},{d[4:7]}", f"{d[:4]}.{d[4:6]}", f"v{d[0]}.{d[1]}.{d[2]}", f"{d[:7]}", f"No. {d[:8]}", f"{d[:2]} %", f"19{d[:2]}-20{d[2:4]}",
            f"{d[:4]} {d[4:6]}", f"@{_letters(rng, 3, 8)}", f"{d[:3]}-{d[3:5]}")[rng.integers(14)]


def training_windows(texts: list[str], rng: np.random.Generator, size: int, per_text: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(x, y), each (windows, size): around labelled spans, as found and rewritten (some twice in a row), with decoys in their
    place, around other digits, and anywhere.  ``per_text`` bounds the spans, and the other digits, that one text gives."""
    xs, ys = [], []

    def add(text: str, spans: list[Span], at: int) -> None:
        at = max(0, at)
        x, y = np.full(size, PAD, np.int64), np.zeros(size, np.int64)
        part = encode(text[at:at + size])
        x[:len(part)] = part
        for k, a, b in spans:
            y[max(0, a - at):max(0, min(size, b - at))] = k + 1
        xs.append(x)
        ys.append(y)

    for text in texts:
        spans = base_spans(text)
        inside = [(a, b) for _, a, b in spans]
        for k, a, b in spans[:per_text]:
            add(text, spans, a - int(rng.integers(4, size // 2)))
            for real in (True, True, False):
                new = rewritten(k, text[a:b], rng) if real else decoy(rng)
                own = [(k, a, a + len(new))] if real else []
                if rng.random() < 0.25:
                    mark = (" or ", ", ", " / ", " ")[rng.integers(4)]
                    more = rewritten(k, text[a:b], rng) if real else decoy(rng)
                    own += [(k, a + len(new) + len(mark), a + len(new) + len(mark) + len(more))] if real else []
                    new += mark + more
                shift = len(new) - (b - a)
                moved = [(q, s + shift * (s >= b), e + shift * (s >= b)) for q, s, e in spans if e <= a or s >= b]
                add(text[:a] + new + text[b:], [*moved, *own], a - int(rng.integers(4, size // 2)))
        loose = [m.start() for m in TRIGGER.finditer(text) if not any(a <= m.start() < b for a, b in inside)]
        for at in loose[:per_text]:
            add(text, spans, at - int(rng.integers(4, size // 2)))
        add(text, spans, int(rng.integers(0, max(1, len(text)))))
    return np.array(xs).reshape(-1, size), np.array(ys).reshape(-1, size)


def train(texts: list[str], hidden: int = 28, steps: int = 800, batch: int = 64, size: int = 72, rate: float = 0.015, seed: int = 3) -> Tagger:
    """Adam on the CRF likelihood; without any labelled span the tagger says "none" everywhere."""
    rng = np.random.default_rng(seed)
    m = new_tagger(hidden, rng)
    x, y = training_windows(texts, rng, size)
    if not len(x) or not y.any():
        m.w["a"][0] += 100
        return m
    one, two = ({k: np.zeros_like(v) for k, v in m.w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        at = rng.integers(0, len(x), batch)
        _, grad = loss_and_gradients(m, np.ascontiguousarray(x[at].T), np.ascontiguousarray(y[at].T))
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        clip, lr = min(1.0, 5.0 / (norm + 1e-9)), rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grad.items():
            g = g * clip
            one[k] = 0.9 * one[k] + 0.1 * g
            two[k] = 0.99 * two[k] + 0.01 * g * g
            m.w[k] -= (lr * (one[k] / (1 - 0.9 ** step)) / (np.sqrt(two[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return m


def viterbi(m: Tagger, runs: list[np.ndarray]) -> list[np.ndarray]:
    """Best tags of each run of scores (length, K); runs of like length are decoded side by side."""
    a, out = m.w["A"], [np.zeros(len(r), np.int8) for r in runs]
    # a run where leaving tag 0 never pays, not even with the best transitions, is all 0
    gain = max(0.0, float((a[1:, 1:].max() if K > 1 else 0) - a[0, 0])) + max(0.0, float(a[0, 1:].max() + a[1:, 0].max() - 2 * a[0, 0]), float((m.w["s"][1:] - m.w["s"][0]).max()))
    open_ = [i for i, r in enumerate(runs) if (r[:, 1:].max(1) - r[:, 0]).max() + gain > 0]
    open_.sort(key=lambda i: len(runs[i]))
    for lo in range(0, len(open_), 256):
        group = open_[lo:lo + 256]
        t = len(runs[group[-1]])
        e = np.zeros((t, len(group), K), np.float32)
        for j, i in enumerate(group):
            e[:len(runs[i]), j] = runs[i]
        sizes = np.array([len(runs[i]) for i in group])
        back = np.empty((t, len(group), K), np.int8)
        back[:] = np.arange(K)  # behind its end a run keeps its tag
        s = e[0] + m.w["s"]
        for q in range(1, t):
            on = slice(int(np.searchsorted(sizes, q, "right")), None)  # runs that are longer than q
            way = s[on, :, None] + a
            back[q, on] = way.argmax(1)
            s[on] = way.max(1) + e[q, on]
        tag = s.argmax(1)
        cols = np.arange(len(group))
        tags = np.empty((t, len(group)), np.int8)
        tags[-1] = tag
        for q in range(t - 1, 0, -1):
            tag = back[q][cols, tag]
            tags[q - 1] = tag
        for j, i in enumerate(group):
            out[i] = tags[:len(runs[i]), j]
    return out


def model_spans(m: Tagger, texts: list[str], batch: int = 512) -> list[list[Span]]:
    """Plausible spans of the tagger in each text."""
    todo, found = [], [[] for _ in texts]  # todo: text, window number
    for i, t in enumerate(texts):
        hit: set[int] = set()
        for h in TRIGGER.finditer(t):
            # windows j cover [j * STRIDE - MARGIN, j * STRIDE - MARGIN + WINDOW)
            hit.update(range(max(0, (h.start() + MARGIN - WINDOW) // STRIDE + 1), (h.end() - 1 + MARGIN) // STRIDE + 1))
        todo += [(i, j) for j in sorted(hit) if j * STRIDE < len(t)]
    middle: list[np.ndarray] = []
    for lo in range(0, len(todo), batch):
        part = todo[lo:lo + batch]
        x = np.full((WINDOW, len(part)), PAD, np.int64)
        for c, (i, j) in enumerate(part):
            a = j * STRIDE - MARGIN
            codes = encode(texts[i][max(0, a):a + WINDOW])
            x[max(0, -a):max(0, -a) + len(codes), c] = codes
        e = scores(m, x)[MARGIN:MARGIN + STRIDE]
        middle += [e[:, c] for c in range(len(part))]
    runs, where = [], []
    lo = 0
    while lo < len(todo):
        hi = lo + 1
        while hi < len(todo) and todo[hi] == (todo[lo][0], todo[hi - 1][1] + 1):
            hi += 1
        i, j = todo[lo]
        runs.append(np.concatenate(middle[lo:hi])[:len(texts[i]) - j * STRIDE])
        where.append((i, j * STRIDE))
        lo = hi
    for tags, (i, at) in zip(viterbi(m, runs), where, strict=True):
        if not tags.any():
            continue
        cut = np.flatnonzero(np.diff(tags, prepend=0, append=0))
        for a, b in zip(cut, cut[1:], strict=False):
            if not tags[a]:
                continue
            k, a, b = int(tags[a]) - 1, at + int(a), at + int(b)
            s = texts[i][a:b]
            lead = len(s) - len(s.lstrip(" \n\t.,;:-"))
            s = s.strip(" \n\t.,;:-")
            if s and plausible(k, s):
                found[i].append((k, a + lead, a + lead + len(s)))
    return found


def all_spans(m: Tagger, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """For each text its base spans, and these with the model's that overlap none of them."""
    out = []
    for text, more in zip(texts, model_spans(m, texts), strict=True):
        base = base_spans(text)
        taken = sorted((a, b) for _, a, b in base)
        add, last = [], -1
        for k, a, b in sorted(more, key=lambda s: s[1]):
            if a >= last and not any(x < b and a < y for x, y in taken):
                add.append((k, a, b))
                last = b
        out.append((base, sorted(base + add)))
    return out


def as_string(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def fit_tagger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> Tagger:
    """Train on the SAMPLE_DOCS documents of smallest hash (of id and text) that hold a digit or an "@", at most SAMPLE_CHARS long."""
    src = (docs.select(F.xxhash64(id_col, text_col).alias("h"), F.col(text_col).cast("string").alias("t"))
           .filter(F.length("t") <= SAMPLE_CHARS).filter(F.col("t").rlike("[0-9@]")))
    # the hashes first: sorting rows with their texts would send every task's best to the driver
    hashes = [r["h"] for r in src.select("h").distinct().orderBy("h").limit(SAMPLE_DOCS).collect()]
    some = src.filter(F.col("h") <= F.lit(hashes[-1])).dropDuplicates(["h"]).orderBy("h").collect() if hashes else []
    return train([r["t"] for r in some], **how)


def find_personal_data(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts of base spans by kind, ``base_sha256``, ``spans`` (base and added), ``n_added``.

    Null texts count as empty; repeated rows and null ids are rows like any
    other; texts are searched whole; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("d"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    kind = src.schema["d"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            got = all_spans(tagger, b.column(1).to_pylist())
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in got], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *counts, pa.array([hashlib.sha256(as_string(x).encode()).hexdigest() for x, _ in got], pa.string()),
                 pa.array([as_string(x) for _, x in got], pa.string()), pa.array([len(x) - len(y) for y, x in got], pa.int64())],
                names=["d", *KINDS, "h", "s", "a"])

    return src.mapInArrow(run, f"d {kind}, email long, ip long, card long, phone long, h string, s string, a long").toDF(
        id_col, *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added")


def redact(docs: DataFrame, tagger: Tagger, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced by its kind in brackets (touching or overlapping spans by the first's).

    Null texts stay null; all other columns stay as they are.
    """
    ship_package(docs.sparkSession)
    at = docs.columns.index(text_col)
    src = docs.select(*[column(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])

    def hidden(text: str, spans: list[Span]) -> str:
        out, end = [], 0
        for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
            if a >= end and (a > end or not out):
                out += [text[end:a], f"[{KINDS[k].upper()}]"]
            elif a >= end:
                out.append(f"[{KINDS[k].upper()}]")
            end = max(end, b)
        return "".join([*out, text[end:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, at):
            texts = b.column(at).to_pylist()
            got = all_spans(tagger, [t or "" for t in texts])
            new = [t if t is None or not s else hidden(t, s) for t, (_, s) in zip(texts, got, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if i == at else b.column(i) for i in range(b.num_columns)], names=b.schema.names)

    return src.mapInArrow(run, src.schema).toDF(*docs.columns)
