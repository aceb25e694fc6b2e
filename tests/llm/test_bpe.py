import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import PASSAGE, SF
from tokenizers import Tokenizer

from sheetwright.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    file = open(PATH, encoding="utf-8").read()
    return bpe.Vocabulary(file, bpe.later_characters(file))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    return sorted(out, key=str)


def test_query_equals_the_library(spark, documents, library):
    from sheetwright.llm.queries import QUERIES

    df = QUERIES["op12_bpe_rank_array"](spark, SF)
    assert df.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, df.collect()), key=str) == expected(library, [(d, t) for d, t, *_ in documents])


ODD = ["", None, "<|endoftext|>", "a <|endoftext|>b<|endoftext|><|endoftext|> ", "<|endoftext|", "a" * 5000, " " * 3000 + "x", "日本語" * 500, "ab" * 300 + "'s 'S",
       "x\x1c\x1d \x85 y", "՘ՙ x࢏", "\U00010940\U0003d000", "\0￾﻿", "\r\n \t\n", PASSAGE, PASSAGE]


def test_odd_rows(spark, make_docs, library):
    rows = [*enumerate(ODD), (None, "no id"), (3, "same id"), (3, "same id")]
    docs = make_docs(rows).selectExpr("*", "1 AS n_tokens", "'x' AS ids", "2 AS _value", "3 AS ids_sha256")
    assert sorted(map(tuple, bpe.report(docs, PATH).collect()), key=str) == expected(library, rows)
    assert bpe.report(make_docs([]), PATH).collect() == []


def test_very_long_texts(spark, make_docs, library, monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé日", k=rng.randint(1, 9))) for _ in range(500)]
    rows = [(1, " ".join(rng.choices(words, k=200_000))), (2, "\n" * 400_000), (3, "ab" * 300_000), (4, "a<|endoftext|>" * 30_000)]
    assert sorted(map(tuple, bpe.report(make_docs(rows), PATH).collect()), key=str) == expected(library, rows)


def test_every_character_is_split_as_the_library_does(vocabulary, library):
    """In runs of 60 characters between letters, numbers and signs; all of Unicode that text can hold."""
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1{chr(c)}! {chr(c)}" for c in codes[i : i + 60]) for i in range(0, len(codes), 60)]
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert vocabulary.encode(text) == found.ids, text


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab \n'tsré日\U0001F600<|endoftext|>09"), max_size=200))
def test_round_trip(text):
    found, library = test_round_trip.found
    ids = found.encode(text)
    assert ids == library.encode(text, add_special_tokens=False).ids and found.decode(ids) == text


@pytest.fixture(autouse=True, scope="module")
def _shared(vocabulary, library):
    test_round_trip.found = vocabulary, library


def test_decoding_of_any_ids(vocabulary, library):
    rng = random.Random(3)
    for _ in range(2000):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 12))]
        assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_short_and_long_words_merge_alike(vocabulary):
    rng = random.Random(9)
    for n in [1, 2, 3, bpe.LONG - 1, bpe.LONG, bpe.LONG + 1, 700]:
        for _ in range(60):
            word = "".join(rng.choices(rng.choice(["ab", "etaoin", "abcdefghijklmnopqrstuvwxyz"]), k=n)).encode()
            assert bpe.merged_short(word, vocabulary.ranks) == bpe.merged_long(word, vocabulary.ranks)


def test_memory_of_words_is_bounded(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_WORDS", 20)
    memory = bpe.Memory(vocabulary)
    monkeypatch.setattr(vocabulary, "memory", memory)
    for i in [*range(300), *range(290, 310)]:
        assert vocabulary.encode(f"w{i} w") == library.encode(f"w{i} w", add_special_tokens=False).ids
        assert len(memory) <= 14 and len(memory.older) <= 14


def test_a_vocabulary_whose_merges_are_not_reached_is_refused():
    with pytest.raises(ValueError, match="same token"):
        bpe.merge_ranks([(b"a", b"b"), (b"b", b"c"), (b"ab", b"c"), (b"a", b"bc")])
    with pytest.raises(ValueError, match="cannot be reached"):
        bpe.merge_ranks([(b"a", b"b"), (b"b", b"c"), (b"a", b"bc")])


def test_pieces_of_a_decoded_text_end_between_characters():
    for text in ("", "a", "é", "日本", "\U0001F600a\U0001F600"):
        raw = text.encode()
        for n in range(len(raw) + 1):
            cut = bpe.whole_characters(raw[:n])
            assert n - cut < 4 and raw[:cut].decode() == text[: len(raw[:cut].decode())]


def test_columns_and_round_trip(spark, make_docs):
    rows = [(i, t) for i, t in enumerate(ODD)]
    ids = bpe.encoded(make_docs(rows).selectExpr("*", "7 AS _value", "8 AS IDS"), PATH)
    assert [c for c in ids.columns if c.lower() == "ids"] == ["ids"]
    back = bpe.decoded(ids, PATH)
    assert back.columns[-2:] == ["ids", "decoded"] and dict(back.dtypes)["ids"] == "array<int>"
    assert all(r["decoded"] == (r["text"] or "") for r in back.collect())
    nulls = bpe.decoded(spark.createDataFrame([(None,), ([],), ([60000],)], "ids array<int>"), PATH)
    assert [r["decoded"] for r in nulls.collect()] == ["", "", ""]


def test_other_tokenizer_files_are_refused(spark, make_docs):
    with pytest.raises(ValueError, match="byte-level"):
        bpe.report(make_docs([(1, "a")]), public_tokenizers.path("word_bpe_49k.json")).collect()
