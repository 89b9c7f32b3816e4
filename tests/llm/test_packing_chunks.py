"""Words are tokenised in chunks that the tokenizer's pieces never cross; a chunk is tokenised once."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from foldline.llm import packing, textbytes

WORDS = public_tokenizers.path("word_bpe_49k.json")


def encoded(encoder, texts):
    ids, counts = encoder.encode(*textbytes.flat(pa.array(texts, pa.string()), lower=True))
    assert len(counts) == len(texts) and counts.sum() == len(ids)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []


def test_marks_beside_a_word_cost_no_further_tokenising():
    encoder = packing.WordEncoder(WORDS)
    seen = []
    word = encoder.word
    encoder.word = lambda w: seen.append(w) or word(w)
    marks = ["", ".", ",", "!!!", ";", ":", "?", "%%%", "&&&"]
    texts = [" ".join(f"{w}{m} ({w}{m}" for w in ("thening", "réré", "4807")) for m in marks]
    first = encoded(encoder, texts)
    assert sorted(seen) == sorted({"thening", "réré", "4807", "(", *marks[1:]})
    assert encoded(encoder, texts[::-1]) == first[::-1] and len(seen) == 12


def test_chunks_equal_the_tokenizer(monkeypatch):
    whole = Tokenizer.from_file(WORDS)
    rng = random.Random(31)
    letters = [*"abstrelvdmAZ'''..,,!-=<>%&(){}|_0195\"` \n\t", *"éÉñßÿÀ×÷µºª¡»Ωσςжİıſẞ中ก", "́", "̸", " ", "　", "½", "²", "é", "Σ.", "'s", "'ll", "don't", "Ã", "ä,", "…", "\x00", "\x7f", "😀"]
    blocks = [["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(200)] for _ in range(12)]
    blocks += [[], [""], [None], ["", None, "x", None, ""], ["é"], ["×é÷"], ["a", ".", "a"], blocks[0]]
    for limit in (packing.CACHED_WORDS, 700):
        monkeypatch.setattr(packing, "CACHED_WORDS", limit)
        encoder = packing.WordEncoder(WORDS)
        for texts in blocks:
            assert encoded(encoder, texts) == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
