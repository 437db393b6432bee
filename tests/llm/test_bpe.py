import hashlib
import random
import unicodedata

import numpy as np
import pytest
from tokenizers import Tokenizer

from skerry.llm import bpe
from skerry.llm.common import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def ours():
    with open(PATH, "rb") as file:
        return bpe.PrefixBpe(file.read())


HARD = [
    "", " ", "a", "Hello, World!", "don't we've I'm they'll he'd it's", "ΑΣ Σ ΟΔΥΣΣΕΥΣ", "İstanbul ß ẞ ﬁ", "x́y é", "日本語のテキスト", "  wide　space", "1234567890", "½ ² Ⅷ", "\U0001f600\U0001f468‍\U0001f469", "a" * 3000,
    "<|startoftext|>inside<|endoftext|>", "<|endoftext", "foo_bar-baz@qux.com", "\x00\x01\x7f�", "؀ال", "!!!???...", "aaaa bbbb " * 50, "it 's 'tis 'twas", "﻿bom", "ｆｕｌｌ", "\n\r\t\v\f\x85 ", "क्षत्रिय", "ĲSSEL ǅ", "'S 'T",
]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(text, library, ours):
    want = library.encode(text, add_special_tokens=False).ids
    assert ours.encode(text).tolist() == want
    assert ours.decode(np.asarray(want, dtype=np.int64)) == library.decode(want, skip_special_tokens=False)


def test_random_texts(library, ours):
    r = random.Random(3)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFSTOR      '''.,!-0123456789éüßñçœ€\n\tжяλ中́"
    for _ in range(3000):
        text = "".join(r.choice(alphabet) for _ in range(r.randint(1, 40)))
        assert ours.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_code_point(library, ours):
    """Each code point between letters, a few to a text: classes, composition and case are the library's."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 64):
        text = " ".join(f"a{chr(c)}b" for c in points[at : at + 64])
        if ours.encode(text).tolist() != library.encode(text, add_special_tokens=False).ids:
            assert [hex(c) for c in points[at : at + 64] if ours.encode(f"a{chr(c)}b").tolist() != library.encode(f"a{chr(c)}b", add_special_tokens=False).ids] == []
            assert ours.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def _marks():
    return [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c))[0] == "M"]


def test_marks_beside_marks(library, ours):
    """Every mark before and after marks of the common classes, where the order of combining classes shows."""
    for beside in "\u0334\u0321\u031b\u0323\u0316\u0301\u0345\u05b0\u064b\u093c\u094d\u3099":
        for at in range(0, len(_marks()), 200):
            text = " ".join(f"a{m}{beside}b c{beside}{m}d" for m in _marks()[at : at + 200])
            assert ours.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, (hex(ord(beside)), at)


def test_random_marks(library, ours):
    r, marks = random.Random(8), _marks()
    for _ in range(3000):
        text = " ".join("".join(r.choice("aeéïкかक") + "".join(r.choice(marks) for _ in range(r.randint(0, 4))) for _ in range(3)) for _ in range(10))
        assert ours.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_random_unicode(library, ours):
    r = random.Random(5)
    blocks = [(0x20, 0x7F), (0xA0, 0x250), (0x300, 0x370), (0x370, 0x590), (0x600, 0x700), (0x900, 0xE00), (0x1100, 0x1200), (0x1C80, 0x1D00), (0x1E00, 0x2100), (0x3040, 0x3100), (0xA640, 0xA800), (0xAC00, 0xAE00), (0x105C0, 0x10600), (0x10D40, 0x10D90), (0x11380, 0x113E0), (0x16100, 0x16140), (0x16D40, 0x16D80), (0x1F300, 0x1F700)]
    for _ in range(4000):
        few = r.sample(blocks, 3)
        text = "".join(chr(r.randrange(*r.choice(few))) if r.random() < 0.8 else " " for _ in range(r.randint(1, 30)))
        assert ours.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_task_leaves_nothing_behind(ours):
    ours.encode("some words that are kept " * 10)
    assert ours.known.young and ours.pairs
    ours.forget()
    assert not ours.known.young and not ours.known.old and not ours.pairs


def test_random_vocabulary_strings(library, ours):
    """Runs of tokens glued together: borders between tokens are where encoders differ."""
    r = random.Random(4)
    pieces = [p.replace("</w>", "") for p in library.get_vocab() if p.isascii() and p.replace("</w>", "").isalpha()]
    for _ in range(3000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(1, 6)))
        assert ours.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_documents(documents, texts, library):
    got = {r.doc_id: r for r in bpe.round_trip(documents, PATH, keep_ids=True).collect()}
    assert set(got) == set(texts)
    for k, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        r = got[k]
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.asarray(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_columns(spark, library):
    from pyspark.sql import functions as F

    d = spark.createDataFrame([("Hello there",), (None,)], "text string").withColumn("ids", bpe.encode(spark, F.col("text"), PATH))
    d = d.withColumn("back", bpe.decode(spark, F.col("ids"), PATH))
    got = d.collect()
    assert got[0].ids == library.encode("Hello there", add_special_tokens=False).ids and got[0].back == library.decode(got[0].ids, skip_special_tokens=False)
    assert got[1].ids == [] and got[1].back == ""
