"""How new words are dealt to the contraction queries."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from occulink.llm import bpe


def test_words_are_contracted_in_order_of_length(monkeypatch):
    coder = bpe.Coder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    asked, inner = [], coder._contract
    monkeypatch.setattr(bpe, "QUERY_ROWS", 400)
    monkeypatch.setattr(coder, "_contract", lambda words: asked.append([len(w) for w in words]) or inner(words))
    rng = np.random.default_rng(7)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, n)) for n in rng.integers(3, 25, 60)] + ["zqxß" * 3, "語" * 9]
    ids, starts = coder.encode(pa.array([" ".join(words), "", words[0]]))
    flat = [n for some in asked for n in some]
    assert len(asked) > 2 and flat == sorted(flat)
    assert coder.decode(ids, starts) == [" ".join(words).encode(), b"", words[0].encode()]
