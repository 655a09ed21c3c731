import hashlib
import random

import public_tokenizers
from tokenizers import Tokenizer

from tidepanel.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
TEXTS = ["", " ", "a", "Hello world", "  two  spaces\n\n\tand\r\n", "don't we'll I'M", "naïve café 漢字 😀", "x" * 5000 + "ab" * 3000,
         "a <|endoftext|> b<|endoftext|>", "१२३ 456 ²", "THE!! THE!! ###", "word " * 4000]


def test_same_ids_and_text_as_the_library():
    m = bpe.model(PATH)
    rnd = random.Random(2)
    fuzz = ["".join(rnd.choice("ab e\n\t'stré漢😀1٣ \x1c\x85<|endoftext|>A.!") for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    for t in TEXTS + fuzz:
        want = LIB.encode(t, add_special_tokens=False).ids
        got = m.encode(t)
        assert got.tolist() == want
        assert m.decode(got) == LIB.decode(want, skip_special_tokens=False)


def test_words_are_independent_of_the_cache(monkeypatch):
    monkeypatch.setattr(bpe, "WORD_CACHE", 3)
    m = bpe.BytePairModel(PATH)
    for t in TEXTS:
        assert m.encode(t).tolist() == LIB.encode(t, add_special_tokens=False).ids


def test_what_a_worker_remembers_is_bounded_by_words_bytes_and_pairs(monkeypatch):
    monkeypatch.setattr(bpe, "WORD_CACHE", 50)
    monkeypatch.setattr(bpe, "PAIR_CACHE", 101)
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdeinorst", k=rnd.randint(2, 9))) for _ in range(3000)] + ["ab" * 400 + str(i) for i in range(20)]
    m = bpe.BytePairModel(PATH)
    for text in (" ".join(words), " ".join(words[:40]), " ".join(reversed(words))):
        assert m.encode(text).tolist() == LIB.encode(text, add_special_tokens=False).ids
        assert len(m.words) <= 50 and len(m.words.older) <= 50 and len(m.pairs) == 101
        assert max(map(len, [*m.words, *m.words.older])) <= bpe.WORD_LENGTH


def test_documents_with_nulls_repeats_and_other_columns(spark):
    rows = [(1, "Hello", "k"), (1, "Hello", "k"), (None, "x y", "k"), (3, None, "k"), (4, "", "k"), (5, TEXTS[7], "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long" if False else "doc_id long, text string, n string")
    got = bpe.round_trip(df, PATH).collect()
    want = []
    for d, t, _ in rows:
        ids = LIB.encode(t or "", add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((d, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    enc = bpe.encode_documents(df, PATH, keep=("n",))
    assert enc.columns == ["doc_id", "n", "n_tokens", "ids"]
    back = {r["doc_id"]: r["text"] for r in bpe.decode_documents(enc, PATH).collect()}
    assert back == {1: "Hello", None: "x y", 3: "", 4: "", 5: TEXTS[7]}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(df, PATH).collect() == []
    assert bpe.encode_documents(df, PATH).collect() == []
