import hashlib
import random
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mercato.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
SIGNS = ["a", "b", "'", "s", "'s", "'re", "'ll", "'T", "ve", " ", "  ", "\n", "\t", "\xa0", "1", "9", "½", "é", "ß", "中",
         "😀", "<|endoftext|>", "<|endof", "!", "...", "_", "\r\n", "\x00", "\x1c", "́", "Ⅷ", "the", "ing"]


@cache
def both():
    library = tokenizers.Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    return bpe.load(PATH), library


@pytest.fixture
def vocabulary():
    return both()[0]


@pytest.fixture
def library():
    return both()[1]


def coded(texts, vocabulary):
    raw = [t.encode() for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)])
    ids, at = bpe.Encoder(vocabulary).slice(np.frombuffer(b"".join(raw), dtype=np.uint8), offs)
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def naive(symbols, vocabulary):
    """Merge the leftmost pair of lowest rank, looking at all pairs each time."""
    ids = list(symbols)
    while True:
        ranks = [vocabulary.rank_of.get(a << 32 | b, bpe.NONE) for a, b in zip(ids, ids[1:])]
        if not ranks or min(ranks) == bpe.NONE:
            return ids
        at = ranks.index(min(ranks))
        ids[at:at + 2] = [int(vocabulary.merged[min(ranks)])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("ab '\n1s."), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=5))
def test_any_text_as_the_library(texts):
    vocabulary, library = both()
    assert coded(texts, vocabulary) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_mixed_signs_and_long_pieces(vocabulary, library):
    r = random.Random(7)
    texts = ["".join(r.choice(SIGNS) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 300, "ab" * 400, " " * 700, "\n" * 129 + "x", "中" * 200, "<|endoftext|>" * 3, "x" * 256 + " " + "y" * 257, ""]
    ids = coded(texts, vocabulary)
    assert ids == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    packed = [np.array(i, dtype="<u4").tobytes() for i in ids]
    assert [bpe._decoded(p, vocabulary) for p in packed] == [library.decode(i, skip_special_tokens=False) for i in ids]
    # ids that cut a character apart
    assert bpe._decoded(packed[0][:0] + np.array([ids[-4][0]], dtype="<u4").tobytes(), vocabulary) == library.decode([ids[-4][0]])


def test_trees_against_all_pairs(vocabulary):
    r = np.random.default_rng(3)
    for n in (1, 2, 5, 16, 31, 256, 300):
        rows = [r.choice(list(b"abehinot "), n).astype(np.uint8) for _ in range(20)]
        want = [naive(vocabulary.byte_ids[x].tolist(), vocabulary) for x in rows]
        data, start = np.concatenate(rows), np.arange(20) * n
        ids, offs = bpe.encode_pieces(data, start, start + n, vocabulary)
        assert [ids[a:b].tolist() for a, b in zip(offs[:-1], offs[1:])] == want
        if n > 1:
            assert [bpe.merge_long(vocabulary.byte_ids[x], vocabulary).tolist() for x in rows] == want


def test_known_pieces_from_slice_to_slice(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 50)  # forgets often
    r = random.Random(2)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 20))) for _ in range(200)]
    encoder = bpe.Encoder(vocabulary)
    for _ in range(20):
        text = " ".join(r.choice(words) for _ in range(60)).encode()
        ids, at = encoder.slice(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]))
        assert [ids.tolist()] == coded([text.decode()], vocabulary)
        assert len(encoder.known.key) <= 50


def test_pieces_of_one_hash_stay_apart(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "mix", lambda x: np.zeros_like(x))
    assert coded(["one two two one"], vocabulary) == [tokenizers.Tokenizer.from_file(PATH).encode("one two two one").ids]


def test_query_on_rows(spark, vocabulary, library):
    texts = [None, "", "same", "same", "The cat's hat.\n\n  x" * 3000, "<|endoftext|> a"]
    df = spark.createDataFrame([(i if i != 1 else None, t, "kept", 5) for i, t in enumerate(texts)],
                               "doc_id long, text string, decoded string, ids int")
    got = bpe.decode(bpe.encode(df, vocabulary), vocabulary)
    assert got.columns == ["doc_id", "text", "ids", "decoded"]
    rows = bpe.unpack(got).collect()
    want = {t: library.encode(t or "", add_special_tokens=False).ids for t in texts}
    assert len(rows) == 6 and all(r.ids == want[r.text] and r.decoded == (r.text or "") for r in rows)
    for r in bpe.digest(got.withColumn("n_tokens", got.doc_id)).collect():
        ids = want[texts[1 if r.doc_id is None else r.doc_id]]
        text = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.digest(bpe.decode(bpe.encode(df.limit(0), vocabulary), vocabulary)).collect() == []


def test_driver_table(spark, library):
    from mercato.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op13_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.load(public_tokenizers.path("word_bpe_49k.json"))
