import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from geolake.llm import packing as pk

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")
FILE = P.path("word_bpe_49k.json")


def first_fit_decreasing(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        for i, b in enumerate(bins):
            if b + n <= capacity:
                bins[i] += n
                break
        else:
            bins.append(n)
    return len(bins)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_gapless_and_no_worse_than_first_fit_decreasing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([1, 2, 10, 50, 100])
    lengths = [rnd.randint(1, capacity) for _ in range(rnd.choice([0, 1, 30, 200]))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    placed, bins = defaultdict(int), defaultdict(list)
    for n, lo, hi, first, each, offset in pk.packing_plan(counts, capacity):
        assert lo == placed[n]
        placed[n] = hi
        for k in range(hi - lo):
            bins[first + k // each].append((offset + k % each * n, n))
    assert dict(placed) == counts
    for found in bins.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in found) <= 2
    assert len(bins) <= first_fit_decreasing(lengths, capacity)


@pytest.mark.parametrize("seed", range(10))
def test_large_pieces_are_matched_as_often_as_possible(seed):
    rnd = random.Random(seed)
    capacity = 30
    lengths = sorted(rnd.randint(11, 30) for _ in range(12))
    counts = {n: lengths.count(n) for n in set(lengths)}
    used = {first + k for _, lo, hi, first, each, _ in pk.packing_plan(counts, capacity) for k in range((hi - lo) // each)}

    def fewest(left):
        if not left:
            return 0
        big, rest = left[-1], left[:-1]
        best = fewest(rest)
        for k in range(len(rest)):
            if rest[k] + big <= capacity and (k == 0 or rest[k] != rest[k - 1]):
                best = min(best, fewest(rest[:k] + rest[k + 1:]))
        return 1 + best
    assert len(used) == fewest(lengths)


def test_plan_does_not_grow_with_the_corpus():
    rng = np.random.default_rng(0)
    few, many = ({int(n): int(c) * k for n, c in zip(*np.unique(np.minimum(rng.lognormal(6, 1, 50_000).astype(int) + 1, 4096), return_counts=True))}
                 for k in (1, 10 ** 6))
    assert len(pk.packing_plan(many)) < 2 * len(pk.packing_plan(few)) + 4 * 4096


TEXTS = ["Hello, World's end...", None, "", " \n", "ÉÀ é Á İΣ ΣΑΣ", "x y z \x1c w", "12345 it's we'll <|endoftext|>a <|startoftext|>",
         "abc" * 4000, "漢字 كلمة 🙂🙂", "tab\tand\x0bvt\x0cff\rcr", "a" * 3, "ﬁ ǅ ß Ⅷ ²", "don't 'S'T"]


def test_ids_are_those_of_the_library(spark):
    rnd = random.Random(1)
    texts = TEXTS + [" ".join(rnd.choice(["the", "Of", "naïve,", "42", "x-y", "́a"]) for _ in range(9000))]
    whole = tokenizers.Tokenizer.from_file(FILE)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, piece int, t string")
    got = defaultdict(list)
    for r in pk.pieces(docs, FILE).orderBy("doc_id", "piece").collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.length == len(ids) and r.start == len(got[r.doc_id]) and r.piece * 4096 == r.start
        got[r.doc_id] += ids
    assert got == {i: whole.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    assert len(got[len(texts) - 1]) > 2 * 4096


def test_words_beyond_the_memory_are_encoded_again(monkeypatch):
    monkeypatch.setattr(pk, "WORDS", 2)
    monkeypatch.setattr(pk, "PARTS", 2)
    whole = tokenizers.Tokenizer.from_file(FILE)
    words = pk.WordIds(FILE)
    text = "one two three one four two " * 3
    assert np.frombuffer(words.of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert len(words) == 2 and len(words.parts) == 2


def test_words_equal_the_library_in_any_mixture():
    rnd = random.Random(7)
    whole, words = tokenizers.Tokenizer.from_file(FILE), pk.WordIds(FILE)
    bits = ["'", "s", "'S", "'re", "ve", "ll", "Don", "A", "0", "12", "-", "\"", "...", "<|", "<|ENDOFTEXT|>", "<|endoftext|>", "|>", "_", "é", "É", "ß", "Ö", "×", "÷", "ÿ", "Ñandú", "ª", "µ",
            "W\u030a", "I\u0307", "\u0301", "\x1c", "\x00", "\x7f", "\xa0", "\u2003", "\u200b", "Σ", "ẞ", "漢", "１", "²", "🙂", "~", "^`"]
    for _ in range(3000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 6)))
        assert np.frombuffer(words.of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, ascii(text)


def check_packed(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for found in bins.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
        assert at <= capacity
    return len(bins)


def test_packing_of_documents(spark):
    rnd = random.Random(4)
    rows = [(i, "word " * rnd.choice([0, 1, 5, 5, 5, 5, 40, 300, 1500, 5000])) for i in range(200)] + [(3, "same")] * 50 + [(None, None), (None, "a b")]
    docs = spark.createDataFrame([(i, t, "s", 7) for i, t in rows], "doc_id long, text string, own string, len int")
    made = pk.pieces(docs, FILE)
    got = pk.pack(made).collect()
    lengths = []
    for _, t in rows:
        n = len((t or "").split()) + 1
        lengths += [4096] * (n // 4096) + [n % 4096] * (n % 4096 > 0)
    assert sorted(r.length for r in got) == sorted(lengths)
    assert check_packed(got, 4096) <= first_fit_decreasing(lengths, 4096)
    # The sequences hold the pieces' ids at their offsets.
    packed = spark.createDataFrame(got, pk.pack(made).schema)
    whole = {r.sequence_id: r.ids for r in pk.sequences(packed).collect()}
    for r in got:
        assert whole[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)


def test_callers_columns_and_equal_rows(spark):
    rows = [(1, 7, "own", 2, 3)] * 200 + [(None, 4, None, None, None)] * 5
    found = spark.createDataFrame(rows, "doc_id long, length int, own string, rank int, bucket int")
    got = pk.pack(found, 10)
    assert got.columns == ["doc_id", "length", "own", "rank", "bucket", "sequence_id", "offset"]
    got = got.collect()
    assert sorted([tuple(r[:5]) for r in got], key=str) == sorted(rows, key=str)
    assert check_packed(got, 10) == 203
    with pytest.raises(ValueError):
        pk.pack(found.withColumnRenamed("rank", "offset"), 10)
    with pytest.raises(ValueError):
        pk.pack(found, 6)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    made = pk.pieces(docs, FILE).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    assert pk.pack(made).collect() == []
    assert zlib.crc32(b"\1\0\0\0") == pk.pieces(spark.createDataFrame([(1, None)], "doc_id long, text string"), FILE).select(
        F.crc32("ids")).first()[0]
