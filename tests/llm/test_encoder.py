"""Words not met before go to the library many in one text, and come back whole."""

import random
import struct

from transqa.llm.common import tokenizer_file
from transqa.llm.token_files import Encoder


def test_new_words_share_a_text():
    with open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as file:
        encoder = Encoder(file.read(), 0)
    texts = [" ".join(f"{'zxq'[i % 3]}wk{i * j}é{j}" for j in range(40)) for i in range(50)]
    texts += ["tail ", " head", "a\nb c\td", "it's x's", "a \nfoo b", "日本 語", None]
    asked = []
    library = encoder._library
    encoder._library = lambda some: asked.extend(some) or library(some)
    got = encoder.encode(texts)
    assert len(asked) < 150
    for text, ids in zip(texts, got, strict=True):
        want = encoder.library.encode(text or "", add_special_tokens=False).ids + [0]
        assert ids == struct.pack(f"<{len(want)}I", *want)


def test_words_held_are_few():
    with open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as file:
        encoder = Encoder(file.read(), 0)
    for call in range(8):
        encoder.encode([" ".join(f"w{call}x{i}" for i in range(40_000))])
    assert len(encoder.words) <= 200_000


class Counted:
    """A library that notes how many characters it was given."""

    def __init__(self, library):
        self.library, self.chars = library, 0

    def encode_batch_fast(self, texts, **how):
        self.chars += sum(map(len, texts))
        return self.library.encode_batch_fast(texts, **how)


def counted():
    with open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as file:
        encoder = Encoder(file.read(), 0)
    encoder.library = Counted(encoder.library)
    return encoder


def test_a_word_is_one_between_marks_and_lines():
    words = [f"zq{a}{b}é" for a in "abcdefgh" for b in "klmno"]
    texts = [f"{a}.\n{b}, ({a})-{b};\t{a}" + "\xa0" * (a == b) for a in words for b in words]
    encoder = counted()
    got = encoder.encode(texts)
    assert encoder.library.chars < 5000
    for text, ids in zip(texts[::40], got[::40], strict=True):
        want = encoder.library.library.encode(text, add_special_tokens=False).ids + [0]
        assert ids == struct.pack(f"<{len(want)}I", *want)


def test_words_met_again_stay():
    often = " ".join(f"o{i}ften" for i in range(2000))
    encoder, asked = counted(), []
    for call in range(12):
        before = encoder.library.chars
        encoder.encode([often if call % 2 == 0 else " ".join(f"w{call}x{i}" for i in range(60_000))])
        asked.append(encoder.library.chars - before)
    assert asked[0] > 10_000 and max(asked[2::2]) < 100
    assert len(encoder.words) <= 200_000


def test_random_texts():
    parts = [
        " ", " ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "a", "the", "'", "'s", "'ll", "42", "½", ".", ",",
        "-", "_", "(", "?!", "é", "×", "÷", "ē", "ʼ", "’", "…", "日本", "\u0300", "😀", "\x00", "Ω", "\ufeff", "\u200b", "<|endoftext|"]
    draw = random.Random(10)
    encoder = counted()
    encoder.WORDS, encoder.TOGETHER = 300, 5
    library = encoder.library.library
    for _ in range(20):
        texts = ["".join(draw.choices(parts if i % 3 else parts[:4] + parts[11:], k=draw.randint(0, 30))) for i in range(200)] + [None]
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            want = library.encode(text or "", add_special_tokens=False).ids + [0]
            assert ids == struct.pack(f"<{len(want)}I", *want)
        assert len(encoder.words) <= 300
