"""Texts are cut into pieces that the library encodes each by itself, and once."""

import random

import pytest

tokenizers = pytest.importorskip("tokenizers")

from paddock.llm import token_files  # noqa: E402
from paddock.llm.bpe import Memory  # noqa: E402

PATH = token_files.default_tokenizer()
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
ODD = ["don't", "'S", "rock'n'roll", "''s", ".'s", "'ll'd", "5's", "(Don'T),", "<|endoftext|>", "x<|startoftext|>Y,", "<|ENDOFTEXT|>", "<|", "İ", "ΟΔΟΣ", "ẖH̱", "É,é", "ªÉ", "×÷", "ÄÖÜß-ÿÞ", "µ²¾", "日本語", "1,234.50", "...", '").', "\x01", "\x1c", "\x00", "​", "’s", "a\xa0B", "\x85", "﻿", "😀"]


def check(texts):
    got = token_files.WordTokenizer(PATH).encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_character_between_letters_digits_and_signs():
    texts = [text for i in [*range(0x2100), *range(0x3000, 0x3100), 0xFB01, 0xFF21, 0x1D400] for c in [chr(i)] for text in (f"aB{c}Cd", f"1{c}2 ({c}) {c}'s '{c}", f"{c}", f"É{c}é")]
    check(texts)


def test_random_strings():
    r = random.Random(11)
    some = "aBsTé'É×.,-(9² \n\t"
    check(["".join(r.choices(some, k=r.randint(0, 14))) for _ in range(20_000)])
    check(["".join(r.choice(ODD) if r.random() < 0.5 else r.choice(some) for _ in range(r.randint(0, 8))) for _ in range(20_000)])


def test_steps_without_words():
    assert token_files.WordTokenizer(PATH).encode([]) == []
    assert [len(x) for x in token_files.WordTokenizer(PATH).encode(["", " \n", "a", ""])] == [0, 0, 1, 0]
    check(["", "\n\n"])


class Counting(Memory):
    asked = 0

    def __getitem__(self, key):
        Counting.asked += 1
        return super().__getitem__(key)


def test_a_piece_is_looked_up_once_in_a_step_and_encoded_once(monkeypatch):
    own = token_files.WordTokenizer(PATH)
    own.memory, plain, parts = Counting(), [], []
    real_plain, real_parts = own._plain, own._parts
    monkeypatch.setattr(own, "_plain", lambda words: plain.extend(words) or real_plain(words))
    monkeypatch.setattr(own, "_parts", lambda words: parts.extend(words) or real_parts(words))
    texts = ["House, house (HOUSE) house-house. " * 200] * 5
    want = LIBRARY.encode(texts[0], add_special_tokens=False).ids
    for _ in range(2):
        assert all(x.tolist() == want for x in own.encode(texts))
    assert plain == [] and sorted(parts) == sorted(["house", ",", "(", ")", "-", "."])
    assert Counting.asked == 2 * 6
    for size in (1, 3):
        monkeypatch.setattr(token_files, "CACHE_WORDS", size)  # what is forgotten is encoded anew
        assert all(x.tolist() == want for _ in range(4) for x in own.encode(texts))


def test_workers_keep_their_tokenizer_from_task_to_task(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(40)], "doc_id long, text string")
    assert token_files.write_shards(docs, str(tmp_path), PATH, shard_bytes=50).count() > 4

    def kept(batches):
        import pyarrow as pa

        from paddock.llm import token_files as in_worker

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"words": [len(x.memory) for x in in_worker._tokenizers.values()]})

    assert [r for r in spark.range(0, 64, 1, 8).mapInArrow(kept, "words long").collect() if r["words"]]


def test_other_tokenizers_get_whole_words(tmp_path):
    """Runs of digits are one pre-token here: texts aren't cut inside words."""
    text = LIBRARY.to_str().replace(r"[\\p{N}]|", r"[\\p{N}]+|")
    (tmp_path / "t.json").write_text(text)
    own, library = token_files.WordTokenizer(str(tmp_path / "t.json")), tokenizers.Tokenizer.from_str(text)
    texts = ["2024 a1234,\n(B) 12'S", "", "é 77\t88 <|endoftext|>9"]
    assert own.model is None and library.encode("2024").ids != LIBRARY.encode("2024").ids
    assert [x.tolist() for x in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_of_a_very_long_text_are_not_kept(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_WORDS", 1000)
    own = token_files.WordTokenizer(PATH)
    for text in (" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(2000)), "xyzé-" * 20_000 + "日"):
        assert own.encode([text, "some"])[0].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
        assert not own.memory and not own.older[0] and not len(own.words[0])
    own.encode(["a few words"])
    assert len(own.memory) == 3
