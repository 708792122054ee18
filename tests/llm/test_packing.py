"""Packing: every id in exactly one piece, windows gapless and full, differencing against plain lists."""
import random
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradelake.llm import packing as K
from tradelake.llm.queries import op8_packing

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(JSON)


TEXTS = ["", " ", "a", "a b", "a  b", " a", "a ", "\n a\n\n b \n", "x\ty z", "it's  'tis don't", "é è ñ ß Ünï", "日本 語 テスト", "😀 a😀b 👩‍👩‍👧",
         "hello<|endoftext|> x <|endoftext|>", "<|endoftext|>", "a b　c\x85d\x1ce \x0b f", "1234 56,78 $9.0", "\r\n \r\n", "word " * 3000,
         "x" * 5000, "퟿ ﻿bom"]


@pytest.mark.parametrize("ranks", [RANKS, None])
def test_units_give_the_tokenizers_ids(tokenizer, ranks):
    units = K._Units(JSON, ranks)
    rng = random.Random(1)
    chars = list("abc é'.,!<|>0 \n\t ") + ["<|endoftext|>", "　", "ß", "日", "  ", " \n"]
    texts = TEXTS + ["".join(rng.choice(chars) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    for t in texts:
        assert np.frombuffer(K.token_bytes(t, units), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_plain_texts_are_looked_up_whole(tokenizer):
    # one call for a text, not one for every word that was not met before
    units, calls = K._Units(JSON, RANKS), []
    whole = units.whole
    units.whole = lambda text: calls.append(text) or whole(text)
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeéñ'1.,<|") for _ in range(rng.randint(1, 9))).replace("<|", "<") for _ in range(400)]
    plain = "  ".join(words[:100]) + " \n" + " ".join(words[100:]) + " "
    for text in (plain, plain + "\t日本 <|endoftext|>"):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(K.token_bytes(text, units), "<u4").tolist() == want
        if text == plain:
            assert calls == [plain] and not units
    assert len(units) > 300  # a text with other characters goes by its words


ODDS = list("abzé'×÷ſ.,!<|>09 \n\t\r\x0b\x0c\x1c\x1f\x7f\x85\xa0\xad\u1680\u2028　ßéıſ日½́") + [
    "<|endoftext|>", "  ", " \n", "'s", "'ll", " word", "ing", "é ", " é", "😀", "\n\n"]


@pytest.mark.parametrize("ranks", [RANKS, None])
def test_texts_together_give_the_tokenizers_ids(tokenizer, ranks):
    rng = random.Random(4)
    texts = ["".join(rng.choice(ODDS[:k]) for _ in range(rng.randint(0, 40))) for k in (8, 18, len(ODDS)) for _ in range(1500)]
    texts += TEXTS + ["lé  " * 900, "q" * 700 + " é" * 50, "", "\n"]
    rng.shuffle(texts)
    units = K._Units(JSON, ranks)
    for some in (texts, texts[:1], ["", ""], [], [" "], ["<|endoftext|>"]):
        got = K.encode_texts(some, units)
        assert len(got) == len(some)
        for t, ids in zip(some, got):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)
    assert max(map(len, units)) <= K.CACHED_CHARS or not ranks


def test_strange_bytes_are_those_of_odd_characters():
    for c in map(chr, [*range(0xd800), *range(0xe000, 0x11000)]):
        assert bool(K._ODD(c)) == bool(K._STRANGE[list(c.encode())].any()), repr(c)


def test_any_character_may_stand_beside_white_space(tokenizer):
    texts = [f"a{c}  b{c} {c}.{c}\n{c}" for c in map(chr, [*range(0xd800), *range(0xe000, 0x10000), 0x1f600])]
    got = K.encode_texts(texts, K._Units(JSON, RANKS))
    for t, ids, want in zip(texts, got, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, repr(t)


def test_a_word_of_many_texts_is_encoded_once(tokenizer, monkeypatch):
    class Counted(K._Units):
        chars = 0

        def __init__(self, *paths):
            super().__init__(*paths)
            whole, fast = self.whole, self.fast
            self.whole = lambda text: self.count(text) or whole(text)
            self.fast = lambda text: self.count(text) or fast(text)

        def count(self, text):
            Counted.chars += len(text)

    monkeypatch.setattr(K, "_Units", Counted)
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 9))) for _ in range(50)]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", ",", ".\n"]) for _ in range(200)) for _ in range(40)]
    docs = pd.DataFrame({"doc_id": [str(i) for i in range(42)], "text": [*texts, None, ""]})
    pieces = pd.concat(K._tokenize(JSON, RANKS, 2048, 512, 1)(iter([docs])))
    for i, t in zip(docs["doc_id"], docs["text"]):
        own = np.frombuffer(b"".join(pieces["ids"][pieces["doc_id"] == i]), "<u4").tolist()
        assert own == tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
    assert 0 < Counted.chars < sum(map(len, texts)) // 10


def test_long_texts_are_cut_and_keep_their_ids(tokenizer, monkeypatch):
    monkeypatch.setattr(K, "ENCODED_CHARS", 10)
    seen, one = [], K.encode_texts
    monkeypatch.setattr(K, "encode_texts", lambda texts, units: seen.append(texts) or one(texts, units))
    rng = random.Random(6)
    texts = ["", "abc", "defgh", "ijk", "", "x" * 50, "y", "日本 " * 9, "a <|endoftext|> b" * 5, "it's  a\n b  \t c " * 9]
    texts += ["".join(rng.choice(ODDS) for _ in range(rng.randint(0, 80))) for _ in range(500)]
    got = list(K._encoded(texts, K._Units(JSON, RANKS)))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert "".join(t for some in seen for t in some) == "".join(texts)
    assert all(sum(map(len, some)) <= 10 or len(some) == 1 for some in seen) and len(max(seen[:-1], key=len)) > 2
    assert list(K._parts("ab cd ef gh ij kl mn")) == ["ab cd ef gh", " ij kl mn"]


def plain_differencing(sizes, m):
    """Partitions as lists of (sum, items), merged largest spread first."""
    parts = [(k, [(s, [k])] + [(0, []) for _ in range(m - 1)]) for k, s in enumerate(sizes)]
    n = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: (-(p[1][0][0] - p[1][-1][0]) if m > 1 else 0, p[0]))
        (_, a), (_, b) = parts[0], parts[1]
        both = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a, reversed(b))]
        both.sort(key=lambda x: -x[0])
        parts = parts[2:] + [(n, [(s - both[-1][0], i) for s, i in both])]
        n += 1
    return [sum(sizes[i] for i in items) for _, items in parts[0][1]]


def test_differencing_matches_plain_lists():
    rng = np.random.default_rng(3)
    for m in (1, 2, 3, 7):
        sizes = np.sort(rng.choice(np.arange(1, 5000), 40, replace=False))[::-1]
        at = K.difference(sizes, m)
        got = np.bincount(at, weights=sizes, minlength=m)
        assert sorted(got) == sorted(plain_differencing(sizes.tolist(), m))
    assert len(K.difference(np.zeros(0, np.int64), 3)) == 0


@pytest.mark.parametrize("sizes", [[1] * 60, [9] * 5 + [1] * 80, [3, 3, 2, 2, 2, 1] * 9, [700] + [2] * 50])
def test_differencing_of_equal_pieces(sizes):
    for m in (1, 2, 5, 64, 257):
        at = K.difference(np.array(sizes), m)
        got = np.bincount(at, weights=sizes, minlength=m)
        assert sorted(got) == sorted(plain_differencing(sizes, m))


@pytest.mark.parametrize("sizes", [np.ones(20_000, np.int64), np.repeat([500, 20, 1], [50, 5_000, 15_000])])
def test_a_group_of_short_documents_takes_little_memory(sizes):
    tracemalloc.start()
    at = K.difference(sizes, 256)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    used = np.bincount(at, weights=sizes, minlength=256)
    assert used.max() - used.min() <= 1 and peak < 1000 * len(sizes)


def test_window_count_rises_to_the_capacity():
    at = K.pack_sizes(np.array([1500, 1500, 1500]), 2048)
    assert len(set(at.tolist())) == 3
    sizes = np.sort(np.random.default_rng(1).integers(1, 512, 2000))[::-1]
    at = K.pack_sizes(sizes, 2048)
    used = np.bincount(at, weights=sizes)
    assert used.max() <= 2048 and len(used) * 2048 <= 1.02 * sizes.sum()


def check(rows, texts, tokenizer):
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in texts.items()}
    seen, windows = {}, {}
    for r in rows:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and 0 < r.length <= 2048
        assert r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
        seen.setdefault(r.doc_id, []).append((r.start, r.length))
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, parts in seen.items():
        at = 0
        for s, n in sorted(parts):
            assert s == at
            at += n
        assert at == len(ids[i])
    assert set(seen) == set(ids)
    for parts in windows.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    return len(windows), sum(map(len, ids.values()))


def test_query_packs_every_id_once(spark, tokenizer):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    windows, tokens = check(op8_packing(spark, sf).collect(), texts, tokenizer)
    assert windows * 2048 <= 1.02 * tokens


def test_defined_cases(make_docs, tokenizer):
    big = (1 << 53) + 1
    texts = {1: None, 2: "", big: "big id", 4: "word " * 9000, 5: "x"}
    docs = make_docs(list(texts.items()), clash=("key", "ids", "bucket", "length", "offset"))
    rows = K.pack(docs, JSON, RANKS).withColumn("ids_crc32", F.crc32("ids"))
    check(rows.collect(), texts, tokenizer)
    twice = K.pack(make_docs([(7, "same text"), (7, "same text"), (None, "no id")]), JSON).collect()
    assert sorted(str(r.doc_id) for r in twice) == ["7", "7", "None"] and len({(r.sequence_id, r.offset) for r in twice}) == 3
    assert K.pack(make_docs([]), JSON).count() == 0
