import base64
import hashlib

import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from geolake.llm import bpe, catalog  # noqa: E402

RANKS = P.path(catalog.RANKS_FILE)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    None, "", " ", "\n\n  \t", "Hello world's  end", "naïve ñandú ß 你好 🙂🙂", "a" * 5000, "xyzzy" * 3000,
    "<|endoftext|> <unk> <s>", "\u2581 ▁▁ x", "\x00\x01\x7f\xa0\u200b", "1234567890 12,5", "Ĥello Ġ", "  lead", "tail  ",
    " ".join(f"w{i}ü" for i in range(4000)),
]


def test_equals_tiktoken_and_round_trips(spark, reference):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(1, "", "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    enc = bpe.encode_documents(docs, RANKS, P.PATTERN)
    got = enc.collect()
    assert len(got) == len(rows)
    for r in got:
        text = TEXTS[r.doc_id] or ""
        ids = reference.encode_ordinary(text)
        assert bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in ids)
        assert r.n_tokens == len(ids) and bytes(r.decoded).decode() == text
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode_documents(enc, RANKS, P.PATTERN).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(TEXTS)}
    assert bpe.encode_documents(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_cache_limit_changes_nothing(spark, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    docs = spark.createDataFrame([(i, f"some words {i} and {i * 7}") for i in range(50)], "doc_id long, text string")
    for r in bpe.encode_documents(docs, RANKS, P.PATTERN).collect():
        ids = reference.encode_ordinary(f"some words {r.doc_id} and {r.doc_id * 7}")
        assert bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in ids)


def test_refuses_incomplete_vocabulary():
    with pytest.raises(ValueError):
        bpe.model_proto({b"a": 0})


def test_query_on_data(spark, reference):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = catalog.queries()["op3_bpe"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_new_words_of_many_texts_are_learnt_in_one_call(reference):
    codec = bpe._codec_maker(RANKS, P.PATTERN)()
    calls, encode = [], codec.sp.encode

    class Counted:
        def encode(self, words, **more):
            calls.append(len(words))
            return encode(words, **more)
    codec.sp = Counted()
    texts = [f"qzxv{i}kwj xkcdq{i % 7}vv" for i in range(200)]
    want = [b"".join(i.to_bytes(4, "little") for i in reference.encode_ordinary(t)) for t in texts]
    assert codec.encode(texts) == want and len(calls) == 1
    assert codec.encode(texts) == want and len(calls) == 1   # known by now


def test_groups_of_texts_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "GROUP_CHARS", 10)
    codec = bpe._codec_maker(RANKS, P.PATTERN)()
    texts = [t or "" for t in TEXTS] * 2
    assert [len(x) // 4 for x in codec.encode_all(texts)] == [len(reference.encode_ordinary(t)) for t in texts]
    assert list(codec.encode_all([])) == []
