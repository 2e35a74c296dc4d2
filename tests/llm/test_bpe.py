import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from salesmart.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
TABLES = bpe.tables(RANKS, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def packed(text):
    return np.array(LIBRARY.encode_ordinary(text), "<u4").tobytes()


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(TABLES)


def agree(coder, texts):
    coded = coder.encode(texts)
    assert coded == [packed(t) for t in texts]
    assert coder.decode(coded) == [t.encode() for t in texts]


def test_short_pieces_and_white_space(coder):
    agree(coder, ["", " ", "Hello  world  it's 12 é日本 x\x1c\x1d a\x85 b", "I'll we've  \n\n they're", "<|endoftext|>", "\x00\x7f", "a b 　c"])


@pytest.mark.parametrize("alphabet", ["a", "ab", "aAzZ", "the in", "日本語", "ÃÂ", "-=", " \n", "er", "éèêë", "abcdefghijklmnopqrstuvwxyz"])
def test_long_pieces(coder, alphabet):
    rng = random.Random(alphabet)
    agree(coder, ["".join(rng.choice(alphabet) for _ in range(n)) for n in (63, 64, 65, 66, 129, 300, 1500)])


def test_classes_of_new_characters(coder):
    rng = random.Random(2)
    chars = [chr(int(c, 16)) for part in bpe.NEWER.split(", ") for c in part.split("-")]
    chars += [chr(rng.randrange(0x80, 0xD800)) for _ in range(300)] + list("ab1 \n!")
    agree(coder, ["".join(rng.choices(chars, k=200)) for _ in range(20)])


def test_slices_of_a_long_text_and_forgotten_pieces(monkeypatch):
    small = bpe.Coder(TABLES)
    for name, n in (("CHUNK", 500), ("TOKENS", 100), ("PIECES", 60), ("KNOWN", 50)):
        monkeypatch.setattr(bpe, name, n)
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("abcde") for _ in range(rng.randrange(1, 9))) for _ in range(900))
    agree(small, [text, "x", text[:450], ""])


def test_small_vocabulary_with_risky_tokens():
    rng = random.Random(8)
    for _ in range(30):
        tokens = [bytes([k]) for k in range(256)]
        made = list("abc")
        for _ in range(14):
            made.append(rng.choice(made) + rng.choice(made))
        made = list(dict.fromkeys(m for m in made if 1 < len(m) < 10))
        rng.shuffle(made)  # ranks in any order, not that of their parts
        ranks = {t: k for k, t in enumerate(tokens + [m.encode() for m in made])}
        library = tiktoken.Encoding("small", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        mine = bpe.Coder(bpe.tables(ranks, public_tokenizers.PATTERN))
        for n in (5, 30, 200):
            text = "".join(rng.choice("abc") for _ in range(n))
            assert np.frombuffer(mine.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)


def test_report_on_edge_rows(spark, edge, edge_rows):
    got = sorted(map(tuple, bpe.report(edge, TABLES).collect()), key=str)
    want = []
    for doc, text, *_ in edge_rows:
        ids = packed(text or "")
        want.append((doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_encode_and_decode_are_a_round_trip(spark, clashing, nothing):
    docs = clashing.withColumn("ids", F.lit("mine"))
    coded = bpe.encode(docs, TABLES)
    assert sorted(coded.columns) == sorted(docs.columns)
    back = bpe.decode(coded, TABLES, into="win")
    rows = back.select("text", F.col("win").cast("string").alias("win"), "ids", "key").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.win == (r.text or "") and r.ids == LIBRARY.encode_ordinary(r.text or "") and r.key == "mine"
    assert bpe.report(nothing, TABLES).count() == 0 and bpe.encode(nothing, TABLES).count() == 0


def test_null_and_foreign_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {bytes(r.decoded) for r in bpe.decode(rows, TABLES).collect()} == {b""}
    with pytest.raises(ValueError, match="does not hold"):
        bpe.Coder(TABLES).decode([np.array([60_000], "<u4").tobytes()])
    with pytest.raises(ValueError, match="lacks the bytes"):
        bpe.tables({b"a": 0}, public_tokenizers.PATTERN)


def test_whole_documents_table(spark, documents):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.report(documents, TABLES).collect()}
    rows = documents.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = packed(r.text or "")
        assert got[r.doc_id] == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
