"""What the encoder asks the tokenizers library for."""

import random

from tokenizers import Tokenizer

from tabmine.llm import token_files


class Counting:
    def __init__(self, tok):
        self.tok, self.tokens = tok, 0

    def __getattr__(self, name):
        return getattr(self.tok, name)

    def encode_batch_fast(self, texts, **how):
        out = self.tok.encode_batch_fast(texts, **how)
        self.tokens += sum(len(e.ids) for e in out)
        return out


def test_new_words_cost_their_own_tokens():
    path = token_files.vocabulary_path()
    enc, rng = token_files.Encoder(path), random.Random(5)
    enc.tok = Counting(enc.tok)
    texts = [" ".join("".join(rng.choices("abcdeéñü", k=rng.randrange(3, 9))) for _ in range(400)) for _ in range(5)]
    got = enc.encode(texts, 2)
    plain = [e.ids for e in Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)]
    assert [memoryview(g).cast(enc.code).tolist() for g in got] == [ids + [2] for ids in plain]
    assert enc.tok.tokens <= sum(map(len, plain)) + 20  # no separator tokens beside the words' own


def test_odd_characters_between_spaces():
    path = token_files.vocabulary_path()
    enc, rng, tok = token_files.Encoder(path), random.Random(6), Tokenizer.from_file(path)
    marks = ["a", "Z", "7", "Ġ", "Ċ", "́", "‍", "️", "中", "\U0001f600", "'s", "!", "\n", "\t", " ", "　", "\x1c", "\x00", "_", "$", " ", " ", " "]
    texts = ["".join(rng.choices(marks, k=rng.randrange(1, 60))) for _ in range(1500)]
    got = enc.encode(texts, 2)
    assert [memoryview(g).cast(enc.code).tolist()[:-1] for g in got] == [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]


def test_remembered_words_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(token_files.Encoder, "CACHE", 200)
    path = token_files.vocabulary_path()
    enc, rng = token_files.Encoder(path), random.Random(7)
    enc.tok = Counting(enc.tok)
    tok, common = Tokenizer.from_file(path), " ".join("".join(rng.choices("abcdeéñü", k=7)) for _ in range(40))
    each = []
    for _ in range(40):
        text = common + " " + " ".join("".join(rng.choices("abcdeéñü", k=9)) for _ in range(30)) + ".\nNew line"
        before = enc.tok.tokens
        assert [memoryview(g).cast(enc.code).tolist()[:-1] for g in enc.encode([text], 2)] == [tok.encode(text, add_special_tokens=False).ids]
        each.append((enc.tok.tokens - before) / len(tok.encode(text, add_special_tokens=False).ids))
        assert len(enc.after) + len(enc.plain) + sum(map(len, enc.before.values())) <= 400
    assert max(each[1:]) < 0.7  # the common words are not encoded again
