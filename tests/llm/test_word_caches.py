"""What the tokenizing operators remember from one part of the texts to the next."""

import public_tokenizers
import pyarrow as pa

from occulink.llm import packing

ODD = ["", "a", "same words here, same words here!", "same words here, same words here!", "two  spaces\n and\n", " leading word", "naïve Straße, (x) x), ''' l'été 12 a1", "日本 語, 語!"]


def texts_of(batch):
    ids, starts = batch
    return [ids[a:z].tolist() for a, z in zip(starts, starts[1:], strict=False)]


def test_packing_keeps_words_and_no_chunks():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    packing.encoder.cache_clear()
    encode, plain = packing.encoder(path), Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    want = [plain.encode(t, add_special_tokens=False).ids for t in ODD]
    for _ in range(2):  # the second time from what is known
        assert texts_of(encode(pa.array(ODD))) == want
    assert not encode.cache


def test_equal_texts_are_encoded_once_in_a_part(monkeypatch):
    packing.encoder.cache_clear()
    encode, asked = packing.encoder(public_tokenizers.path("byte_bpe_50k.json")), []
    inner = encode.encode
    monkeypatch.setattr(encode, "encode", lambda chunks: asked.extend(chunks) or inner(chunks))
    got = texts_of(encode(pa.array(["one  copy\n of it"] * 50 + ["first word"] * 50)))
    assert len(asked) == len(set(asked)) and len({tuple(g) for g in got}) == 2


def _byte_coder():
    import base64

    import tiktoken

    from occulink.llm import bpe

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return bpe.Coder(path, public_tokenizers.PATTERN), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_words_in_use_stay_known_when_the_cache_turns(monkeypatch):
    from occulink.llm import bpe

    coder, plain = _byte_coder()
    asked, inner = [], coder._contract
    monkeypatch.setattr(bpe, "CACHE_BYTES", 4_000)
    monkeypatch.setattr(coder, "_contract", lambda words: asked.extend(words) or inner(words))
    for k in range(40):
        texts = ["zqxkvj wqzzkx, and qqkxzv.", " ".join(f"xkq{'abcdefghij'[k % 10] * n}zz{'klmn'[k // 10]}" for n in range(1, 6))]
        assert texts_of(coder.encode(pa.array(texts))) == [plain.encode_ordinary(t) for t in texts]
    assert len(asked) > 200 and all(asked.count(w) == 1 for w in (b"zqxkvj", b" wqzzkx", b" qqkxzv"))


def test_words_and_chunks_are_told_apart():
    coder, plain = _byte_coder()
    texts = [*ODD, "\n\n x", "a\n\n b", "\n\n", "a\n\n", " \n", "x \n y", "\t", "aaa's 'sx", "'s", "aba" * 40 + "a" * 99, "a" * 600, "é" * 130, "\U0001f600x\U0001f600"]
    for _ in range(2):
        ids, starts = coder.encode(pa.array(texts))
        assert texts_of((ids, starts)) == [plain.encode_ordinary(t) for t in texts]
        assert coder.decode(ids, starts) == [t.encode() for t in texts]
    for wrong in (-1, 10**6):
        try:
            coder.decode(pa.array([1, wrong]).to_numpy(), pa.array([0, 2]).to_numpy())
        except ValueError:
            continue
        raise AssertionError(wrong)
