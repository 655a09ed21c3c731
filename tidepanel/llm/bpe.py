"""Byte-level BPE by backtracking over longest matches.

A merge table defines BPE by repeatedly joining the lowest-ranked adjacent
pair.  The same tokens come out, in time linear in the text, by walking it
left to right: take the longest token at the position (from one Aho-Corasick
pass), accept it if it is *compatible* with the token before it, otherwise try
its next shorter prefix token, otherwise undo the previous token.  Two tokens
are compatible if BPE over their joined bytes gives back exactly these two;
that is decided by undoing their merges from the highest rank down, and kept
in a pair table.  A dead-end set of positions makes every position be left at
most once, so the walk is linear.

Decoding needs no search: all token bytes lie in one blob, and an offset table
gives each id's range in it.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, slices

# Fixed value: the word-splitting pattern of byte-level BPE vocabularies of this family.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# What a worker remembers between words; results do not depend on it, and it is all bounded, whatever the texts.
#: Words whose ids are kept in each of two generations, and the length of the longest kept.
WORD_CACHE, WORD_LENGTH = 100_000, 40
#: Pairs of tokens whose compatibility is kept, eight bytes each (a prime, as pairs are placed by remainder).
PAIR_CACHE = 524_287


def byte_letters() -> dict[str, int]:
    """Letter used for each byte in the vocabulary file -> the byte.

    Printable Latin-1 bytes stand for themselves; the others take the code
    points from 256 on, in order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairModel:
    """Tables of one vocabulary file (tokenizers' JSON, byte level, no normaliser)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens: list[bytes] = [b""] * size
        for word, i in vocab.items():
            if word not in self.special:
                self.tokens[i] = bytes(letters[c] for c in word)
        base = {i for i, t in enumerate(self.tokens) if len(t) == 1}
        # rank of a token: the order of the merge that makes it; single bytes come before all
        self.rank = [-1] * size
        self.parts: list[tuple[int, int] | None] = [None] * size
        self.merged: dict[tuple[int, int], int] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            made = vocab[a + b]
            self.merged.setdefault((vocab[a], vocab[b]), made)
            if made not in base and self.parts[made] is None:
                self.parts[made], self.rank[made] = (vocab[a], vocab[b]), r
        self.longest = ahocorasick.Automaton()
        by_bytes = {}
        for i, t in enumerate(self.tokens):
            if t and (len(t) == 1 or self.parts[i]):
                by_bytes[t] = i
                self.longest.add_word(t.decode("latin-1"), (len(t), i))
        self.longest.make_automaton()
        # the longest token that is a proper prefix of each token
        self.shorter = [-1] * size
        for t, i in by_bytes.items():
            self.shorter[i] = next((by_bytes[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in by_bytes), -1)
        for text, i in self.special.items():
            self.tokens[i] = text.encode()
        self.offsets = np.zeros(size + 1, np.int64)
        np.cumsum([len(t) for t in self.tokens], out=self.offsets[1:])
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        # at its remainder, a pair as (left * size + right) * 2 + compatible; a later pair takes the place of an earlier
        self.pairs = array("q", [-1]) * PAIR_CACHE
        self.split = regex.compile(SPLIT_PATTERN)
        self.special_re = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = _Words(self)

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE over the bytes of both tokens ends with exactly these two.

        Going back in merge order, the higher-ranked of the two edge tokens
        is the one made last: before that merge its inner part stood at the
        border.  If at any such moment the two border parts could merge at a
        lower rank than what was done next, BPE would have merged across.
        """
        pair = left * len(self.tokens) + right
        place = pair % PAIR_CACHE
        known = self.pairs[place]
        if known >> 1 == pair:
            return known & 1 == 1
        a, b, ok = left, right, True
        limit, across_wins_ties = len(self.tokens) + 1, False
        while True:
            made = self.merged.get((a, b))
            if made is not None:
                r = self.rank[made]
                # left-to-right order: at equal rank the leftmost occurrence merges first
                if r < limit or (across_wins_ties and r == limit):
                    ok = False
                    break
            ra, rb = self.rank[a], self.rank[b]
            if ra < 0 and rb < 0:
                break
            if ra > rb:
                limit, across_wins_ties, a = ra, False, self.parts[a][1]
            else:
                limit, across_wins_ties, b = rb, True, self.parts[b][0]
        self.pairs[place] = pair * 2 + ok
        return ok

    def encode_word(self, data: bytes) -> list[int]:
        """Exact BPE of one word (bytes the pattern never splits further)."""
        n = len(data)
        best = [0] * n
        reach = [0] * n
        for end, (size, i) in self.longest.iter(data.decode("latin-1")):
            start = end - size + 1
            if size > reach[start]:
                reach[start], best[start] = size, i
        out: list[int] = []
        dead = bytearray(n + 1)
        pos, token = 0, best[0] if n else -1
        while token >= 0:
            last = out[-1] if out else -1
            while True:
                end = pos + len(self.tokens[token])
                if not dead[end] and (last < 0 or self.compatible(last, token)):
                    out.append(token)
                    pos = end
                    token = best[pos] if pos < n else -1
                    break
                token = self.shorter[token]
                if token < 0:
                    dead[pos] = 1
                    out.pop()
                    pos -= len(self.tokens[last])
                    token = last
                    break
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text (little-endian unsigned 32-bit)."""
        words, find = self.words, self.split.findall
        if self.special_re is None or not any(s in text for s in self.special):
            return np.frombuffer(b"".join(map(words.__getitem__, find(text))), "<u4")
        out = []
        for piece in self.special_re.split(text):
            i = self.special.get(piece)
            out.append(b"".join(map(words.__getitem__, find(piece))) if i is None else i.to_bytes(4, "little"))
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; bytes that are not UTF-8 become replacement characters."""
        ids = ids.astype(np.int64)
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        where = np.repeat((starts - (ends - sizes)).astype(np.int32), sizes)
        where += np.arange(total, dtype=np.int32)
        return self.blob[where].tobytes().decode("utf-8", "replace")


class _Words(dict):
    """Word -> its ids as bytes, filled on demand; words in use outlive a turn-over, long ones are not kept."""

    def __init__(self, model: BytePairModel):
        super().__init__()
        self.model = model
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            out = array("I", self.model.encode_word(word.encode())).tobytes()
            if len(word) > WORD_LENGTH:
                return out
        if len(self) >= WORD_CACHE:
            self.turn_over()
        self[word] = out
        return out

    def turn_over(self) -> None:
        self.older = dict(self)
        self.clear()


_MODELS: dict[str, BytePairModel] = {}


def model(path: str) -> BytePairModel:
    """The model of a vocabulary file, built once per worker."""
    if path not in _MODELS:
        _MODELS[path] = BytePairModel(path)
    return _MODELS[path]


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, the ``keep`` columns, ``n_tokens``, ``ids`` (array of int).

    ``path`` is the vocabulary file on every node.  A null text counts as
    empty and gives no ids; repeated rows are encoded each; null ids are
    kept; other columns of ``docs`` are not read.  Every text is encoded
    whole, whatever its length.
    """
    ship_package(docs.sparkSession)
    head = [id_col, *[c for c in keep if c != id_col]]
    names = [f"k{i}" for i in range(len(head))]
    src = docs.select(*[F.col(c).alias(n) for c, n in zip(head, names, strict=True)], F.col(text_col).cast("string").alias("t"))
    at = len(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in slices(batches, at, 1 << 20):
            ids = [m.encode(t or "") for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(at)], pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))], names=[*names, "n", "i"])

    schema = ", ".join(f"{n} {src.schema[n].dataType.simpleString()}" for n in names) + ", n long, i array<int>"
    return src.mapInArrow(run, schema).toDF(*head, "n_tokens", "ids")


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids",
                     out_col: str = "text") -> DataFrame:
    """One row per input row: id and the decoded text (null ids: empty text)."""
    ship_package(encoded.sparkSession)
    src = encoded.select(F.col(id_col).alias("d"), F.col(ids_col).cast("array<int>").alias("i"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                texts = [m.decode(np.array(x or [], np.int64)) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["d", "t"])

    return src.mapInArrow(run, f"d {src.schema['d'].dataType.simpleString()}, t string").toDF(id_col, out_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode from the ids alone, in one pass over the texts.

    Returns id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit),
    decoded_sha256 (UTF-8 of the decoded text).  Nulls as in
    :func:`encode_documents`.
    """
    ship_package(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("d"), F.col(text_col).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in slices(batches, 1):
            n, ids_sha, text_sha = [], [], []
            for t in b.column(1).to_pylist():
                ids = m.encode(t or "")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(m.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["d", "n", "i", "o"])

    kind = src.schema["d"].dataType.simpleString()
    return src.mapInArrow(run, f"d {kind}, n long, i string, o string").toDF(
        id_col, "n_tokens", "ids_sha256", "decoded_sha256")
