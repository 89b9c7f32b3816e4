"""A worker's memory of chunks never changes the ids."""

import public_tokenizers
import pyarrow as pa
import tiktoken

from foldline.llm import byte_bpe, textbytes

BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_block_that_overfills_the_memory(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED_IDS", 40)
    encoder = byte_bpe.ShardEncoder(BPE, public_tokenizers.PATTERN)
    reference = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.replay.ranks, special_tokens={})
    first = "known words of a first block"
    blocks = [[first], [first + " qzxj" * 3, "vkq0x9f3a7" * 30 + " of a zzqy"], [first, "of other words"], [first]]
    for texts in blocks:
        data, offsets = textbytes.flat(pa.array(texts))
        ids, counts = encoder.encode(data, offsets)
        assert len(ids) == counts.sum()
        at = 0
        for text, n in zip(texts, counts.tolist(), strict=True):
            assert ids[at:at + n].tolist() == reference.encode_ordinary(text)
            at += n
