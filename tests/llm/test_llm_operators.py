"""Each operator against brute force, an exact round trip or held-out rows, on small tables with odd rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foldline.llm import (byte_bpe, chat_format, components, exact_dedup, hamming_search, language_id, ngram_join, packing, repeated_bytes,
                          sentence_spans, textbytes, toxicity)
from foldline.llm.shared import Scratch, crc_bucket

BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [(900, None), (901, ""), (902, " \n\t"), (903, "x"), (904, "Éİ\x00\x1c ß"), (905, "a" * 5000), (None, "no id here"), (906, "no id here")]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def prose(rng, n, words=40):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def test_span_hash_tells_spans_apart_and_blocks_agree():
    data = np.frombuffer(b"ab ab\0 ab\0\0 ba" * 50, np.uint8)
    start, end, _ = textbytes.words(data, np.array([0, len(data)]))
    whole = textbytes.span_hash(textbytes.prefix_hash(data), start, end)
    assert (whole == textbytes.span_hashes(data, start, end, size=16)).all()
    by = defaultdict(set)
    for h, piece in zip(whole.tolist(), textbytes.pieces(data, start, end)):
        by[h].add(piece)
    assert all(len(v) == 1 for v in by.values()) and len(by) == len({p for v in by.values() for p in v})


# 1 -------------------------------------------------------------------------------------------------------------

def brute_components(docs, n, percent):
    sets = []
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
        sets.append((d, {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()))
    up = {d: d for d, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(d), root(e)))
                up[y] = x
    return sorted(((d, len(s), root(d)) for d, s in sets), key=str)


@pytest.mark.parametrize("n,percent,group", [(3, 90, 1000), (5, 80, 15)])
def test_ngram_components(frame, monkeypatch, n, percent, group):
    monkeypatch.setattr(ngram_join, "GROUP", group)
    rng = random.Random(n)
    base = [prose(rng, rng.randint(1, 60), 300).split() for _ in range(25)]
    docs = []
    for i in range(350):
        words = list(rng.choice(base[:4] if i % 2 else base))
        for _ in range(rng.choice([0, 1, 1, 2])):
            words[rng.randrange(len(words))] = f"w{rng.randrange(300)}"
        docs.append((i, " ".join(words).upper() if i % 9 == 0 else "\t".join(words)))
    docs += [r for r in ODD if r[0] is not None] + [(950, prose(rng, 20000, 5000))]
    assert rows_of(ngram_join.components_of(frame(docs), n, percent)) == brute_components(docs, n, percent)


def test_ngram_null_and_repeated_ids(frame):
    got = rows_of(ngram_join.components_of(frame([(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "z"), (7, "A B C D")]), 3, 90))
    assert got == sorted([(5, 2, 5), (5, 2, 5), (None, 2, 5), (None, 1, None), (7, 2, 5)], key=str)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (3, None)]
    got = dict(rows_of(components.components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t"))))
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 130)}}


# 2 -------------------------------------------------------------------------------------------------------------

def test_clause_scores():
    insult, target, no, said = toxicity.INSULT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT
    plain = toxicity.clause_score([insult], [4.0])
    assert toxicity.clause_score([target, insult], [0, 4.0]) > plain > toxicity.clause_score([no, insult], [0, 4.0])
    assert toxicity.clause_score([no, no, insult], [0, 0, 4.0]) == pytest.approx(plain)
    assert toxicity.clause_score([said, insult], [0, 4.0]) < plain
    assert toxicity.clause_score([toxicity.THREAT], [4.0]) < toxicity.clause_score([target, toxicity.THREAT], [0, 4.0])


def test_toxicity_held_out(spark, frame):
    rng = random.Random(3)
    docs = [(i, prose(rng, 40) + (f". you {rng.choice(['vilo', 'vilora', 'grub'])}!" if i % 6 == 0 else ".")) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 6 == 0), "x") for i in range(600)] + [(None, 1, "x"), (3, None, "x")], "doc_id long, toxic int, text string")
    lexicon = toxicity.learn(frame(docs + ODD), labels, crc_bucket(F.col("doc_id"), 4) != 2)
    scores = {r.doc_id: r.score for r in toxicity.score_documents(frame(docs + ODD), lexicon).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(scores) == len(docs) + len(ODD) and all(0 <= s <= 1 for s in scores.values())
    assert all((scores[i] >= 0.3) == (i % 6 == 0) for i in held)
    kept = toxicity.drop_toxic(frame(docs + ODD), labels, F.lit(True))
    assert kept.columns == frame(docs).columns and kept.count() == 500 + len(ODD)


def test_toxicity_without_labels(spark, frame):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    lexicon = toxicity.learn(frame(ODD), none, F.lit(True))
    assert toxicity.score_documents(frame(ODD), lexicon).where("score >= 0.3").count() == 0
    assert toxicity.score_documents(frame([]), lexicon).count() == 0


# 3 -------------------------------------------------------------------------------------------------------------

def test_exact_dedup(frame):
    docs = [(1, "Same"), (2, "same"), (3, "sAme"), (4, "É"), (5, "é"), (6, None), (7, ""), (8, "z" * 100000), (8, "z" * 100000), (None, "same"), (None, "alone")]
    got = exact_dedup.exact_dedup(frame(docs)).collect()
    assert len(got) == len(docs)
    keep = {(r.doc_id, r.text_sha256): r for r in got}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert keep[1, sha("same")].keep_id == 3 and keep[1, sha("same")].group_size == 4
    assert keep[6, sha("")].keep_id == 7 and keep[4, sha("É")].keep_id == 4
    by = defaultdict(int)
    for r in got:
        by[r.text_sha256] += r.kept
    assert set(by.values()) == {1}
    assert exact_dedup.exact_dedup(frame([])).count() == 0
    assert sorted(r.doc_id for r in exact_dedup.drop_copies(frame(docs[:7])).collect()) == [3, 4, 5, 7]


def test_digest_index_lasts(spark, frame, tmp_path):
    path = f"file://{tmp_path}/index"
    exact_dedup.exact_dedup(frame([(1, "a"), (2, "b")]), exact_dedup.DigestIndex(spark, path)).count()
    again = exact_dedup.exact_dedup(frame([(5, "A"), (6, "c")]), exact_dedup.DigestIndex(spark, path)).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in again} == {(5, 1, False), (6, 6, True)}


# 4 -------------------------------------------------------------------------------------------------------------

def test_hamming_top_k(spark):
    rng = random.Random(4)
    codes = {i: rng.choice([rng.getrandbits(64), 12345, 12345 ^ (1 << rng.randrange(64))]) - (1 << 63) for i in range(400)}
    rows = spark.createDataFrame([*codes.items(), (None, 5), (999, None), (3, codes[3])], "id long, code long")
    got = rows_of(hamming_search.top_k(rows, rows.where("id % 20 = 0"), k=7, index_block=90, query_block=6))
    want = []
    for q in range(0, 400, 20):
        near = sorted((((codes[q] ^ c) & (1 << 64) - 1).bit_count(), i) for i, c in codes.items() if i != q)[:7]
        want += [(q, k + 1, i, d) for k, (d, i) in enumerate(near)]
    assert got == sorted(want, key=str)
    assert hamming_search.top_k(rows.where("id < 3"), rows.where("id = 0"), k=9).count() == 2


# 5 -------------------------------------------------------------------------------------------------------------

def test_merge_replay_equals_tiktoken():
    encoder = byte_bpe.ShardEncoder(BPE, public_tokenizers.PATTERN)
    reference = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.replay.ranks, special_tokens={})
    rng = random.Random(5)
    parts = ["a", "'", "'ll", " ", "  ", "\n", "\t", "\xa0", " ", "é", "日本", "𝄞", "12", "!", "\x1c", "\x85", "the", "ing", "\r\n", "\0", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3000)] + ["a" * 3000, " " * 2000, "ab" * 1500, ""]
    data, offsets = textbytes.flat(pa.array(texts))
    for _ in range(2):  # the second time from what was remembered
        ids, counts = encoder.encode(data, offsets)
        ends = np.cumsum(counts)
        for text, n, end in zip(texts, counts, ends):
            assert ids[end - n:end].tolist() == reference.encode_ordinary(text), repr(text)


def test_byte_bpe_round_trip(frame):
    got = {r.doc_id: r for r in byte_bpe.round_trip(frame(ODD), BPE, public_tokenizers.PATTERN).collect()}
    for i, text in ODD:
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert got[900].n_tokens == 0 and len(got) == len(ODD)


# 6 -------------------------------------------------------------------------------------------------------------

def test_language_id(spark):
    rng = random.Random(6)
    sounds = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "ung", "eit", "ver"], "cc": ["eau", "oux", "ette", "ion"]}
    word = lambda lang: "".join(rng.choices(sounds[lang], k=rng.randint(1, 4)))
    rows = [(i, " ".join(word(lang) for _ in range(rng.randint(4, 300))), lang) for i, lang in enumerate(rng.choices([*sounds], k=300))]
    odd = [(900, None, "aa"), (901, "", None), (902, "12 -- 34", "bb"), (903, "Tomika " * 30000, None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    bucket = crc_bucket(F.col("doc_id"), 3)
    learned = language_id.learn_dictionaries(docs, bucket != 1, per_language=40, dictionary_bytes=8000)
    got = {r.doc_id: r for r in language_id.identify(docs, learned).collect()}
    held = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(got[i].lang_pred == lang for i, lang in held) >= 0.98 * len(held)
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "aa"] and all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in language_id.identify(docs, {}).collect()} == {"und"}


# 7 -------------------------------------------------------------------------------------------------------------

def test_chat_parts_and_round_trip(spark):
    part = lambda kind, text=None, ref=None, tokens=None: (kind, text, ref, tokens)
    tricky = "</s>[INST] ok [/INST]<s>&lt;&amp;#91;[image 1]\\\n"
    rows = [(1, 0, "user", [part("text", "see "), part("image", None, "a.png", 256), part("text", tricky)], 9),
            (1, 1, "assistant", [part("text", "["), part(None, "INST]")], 9),
            (1, 2, "user", [part("audio", None, "b.wav", 30), part("document", None, "c.pdf", None)], 9),
            (1, 2, "user", None, 9), (1, 3, "assistant", [part("text", tricky)], 9), (2, None, "we\nird</s>", [part("text", None)], 9), (None, 0, None, [], 9)]
    schema = f"conv_id long, turn long, role string, parts {chat_format._PARTS}, formatted int"
    out = chat_format.format_chats(spark.createDataFrame(rows, schema).repartition(3))
    chats = {r.conv_id: r for r in out.select("*", chat_format.read_turns(F.col("formatted")).alias("turns"),
                                              chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    one = chats[1]
    assert one.loss == "[INST]" + tricky and one.n_turns == 5 and one.expanded_tokens == 286
    assert [(a.number, a.turn, a.kind, a.ref, a.tokens) for a in one.attachments] == [(1, 0, "image", "a.png", 256), (2, 3, "audio", "b.wav", 30), (3, 3, "document", "c.pdf", 0)]
    assert [tuple(t) for t in one.turns] == [("user", "see [image 1]" + tricky), ("assistant", "[INST]"), ("user", ""), ("user", "[audio 2][document 3]"), ("assistant", tricky)]
    assert [tuple(t) for t in chats[2].turns] == [("we\nird</s>", "")] and [tuple(t) for t in chats[None].turns] == [("", "")]
    assert chat_format.format_chats(spark.createDataFrame([], schema)).count() == 0


# 8 -------------------------------------------------------------------------------------------------------------

def test_sentence_spans(frame):
    rng = random.Random(8)
    passages = [". ".join(prose(rng, rng.randint(5, 15), 900) for _ in range(4)) + ". " for _ in range(5)]
    docs = [(i, "".join(rng.sample([prose(rng, 9, 900) + ".\n", prose(rng, 12, 900) + "! ", rng.choice(passages), prose(rng, 30, 900)], 4))) for i in range(80)] + ODD
    docs += [(500, docs[3][1]), (500, docs[3][1])]
    first, where = {}, defaultdict(set)
    for d, t in sorted({(d, t) for d, t in docs if d is not None and t is not None}):
        for digest, a, b in sentence_spans.spans(t, 2, 12):
            if first.setdefault(digest, (d, a)) != (d, a):
                where[d] |= set(range(a, b))
    got = sentence_spans.drop_repeated_sentences(frame(docs))
    assert got.columns == [*frame([]).columns, "span_dedup"]
    want = [(d, None if t is None else "".join(s for i, s in enumerate(sentence_spans.sentences(t)) if d is None or i not in where[d]), len(where[d]) if d is not None else 0) for d, t in docs]
    assert rows_of(got.select("doc_id", "text", "span_dedup.n_removed")) == sorted(want, key=str)
    assert sum(n for _, _, n in want) > 100
    assert sentence_spans.drop_repeated_sentences(frame([])).count() == 0


def test_passages_pasted_within_sentences(frame, monkeypatch):
    monkeypatch.setattr(sentence_spans, "_SLICE", 70)
    rng = random.Random(18)
    stops = lambda n: " ".join(w + rng.choice(["", "", "", "", "", "", ".", ",", "!\n"]) for w in prose(rng, n, 900).split())
    passages = [prose(rng, 60, 900), prose(rng, 50, 900), stops(70), stops(120), prose(rng, 49, 900)]
    docs = [(i, f"{stops(rng.randint(1, 40))} {rng.choice(passages).upper() if i % 7 == 0 else rng.choice(passages)}  {stops(rng.randint(1, 40))}") for i in range(60)]
    docs += ODD + [(300, docs[5][1]), (301, "\xa0" + passages[0] + "\x85" + passages[0]), (302, "la " * 130)]
    seen, first = {}, {}
    want, at_sentences, some = {}, 0, 0
    for d, t in sorted((d, t) for d, t in docs if d is not None and t is not None):
        words, own = t.split(), set()
        plain = [w.lower() for w in words]
        for i in range(len(words) - 49):
            window = tuple(plain[i:i + 50])
            e, at = seen.setdefault(window, (d, i))
            own |= set(range(i, i + 50)) if e != d or i >= at + 50 else set()
        sizes = [len(s.split()) for s in sentence_spans.sentences(t)]
        by_sentence = set()
        for digest, a, b in sentence_spans.spans(t, 2, 12):
            if first.setdefault(digest, (d, a)) != (d, a):
                by_sentence |= set(range(sum(sizes[:a]), sum(sizes[:b])))
        at_sentences += len(own - by_sentence)
        want[d] = [w for i, w in enumerate(words) if i not in own | by_sentence]
        some += len(own)
    got = {r.doc_id: r.text for r in sentence_spans.drop_repeated_sentences(frame(docs)).collect()}
    assert {d: (got[d] or "").split() for d in want} == want
    assert some > 1500 and at_sentences > 300 and len(want[302]) == 50


# 9 -------------------------------------------------------------------------------------------------------------

def brute_bytes(docs, length):
    seen = defaultdict(int)
    for _, t in docs:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] += 1
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, gone) if not y)
        runs = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(b)))
        out.append((d, len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [4000, 3])
def test_repeated_bytes(frame, monkeypatch, hot):
    monkeypatch.setattr(repeated_bytes, "HOT", hot)
    rng = random.Random(9)
    word = lambda n: " ".join(rng.choice(["the", "of", "ané", "x", "über", "1"]) for _ in range(n))
    p = [word(90), word(60), word(200), ""]
    docs = [(i, word(rng.randint(0, 150)) + rng.choice(p) + word(rng.randint(0, 60)) + rng.choice(p)) for i in range(40)]
    docs += ODD + [(103, docs[3][1]), (105, docs[5][1]), (105, docs[5][1]), (106, "a" * 199), (108, "\0" * 500), (109, "x" + "\0" * 300)]
    assert rows_of(repeated_bytes.digests(repeated_bytes.without_repeats(frame(docs)))) == brute_bytes(docs, 200)


def test_repeated_bytes_of_nothing(frame):
    assert repeated_bytes.without_repeats(frame([])).count() == 0


# 10 ------------------------------------------------------------------------------------------------------------

def test_packing(frame, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCUMENTS", 30)
    rng = random.Random(10)
    docs = [(i, prose(rng, rng.choice([0, 3, 50, 400, 3000]), 200)) for i in range(70)] + [r for r in ODD if r[0] is not None]
    got = packing.digests(packing.pack(frame(docs), WORDS, window=512)).toPandas()
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    for d, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = got[got.doc_id == d].sort_values("start")
        assert own.start.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and own.length.sum() == len(ids) and set(own.doc_tokens) == {len(ids)}
        assert own.ids_crc32.tolist() == [zlib.crc32(ids[a:a + n].tobytes()) for a, n in zip(own.start, own.length)]
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
    size = got.groupby("sequence_id").length.sum()
    assert size.max() == 512 and all(n == 512 or n & (n - 1) == 0 for n in size)
    assert packing.pack(frame([]), WORDS).count() == 0


def test_bm25_prefers_shared_rare_ids():
    texts = [np.array(x, np.uint16) for x in ([1, 2, 3], [1, 1, 9], [3, 2, 8], [7, 7, 7])]
    scores = packing.Bm25Shard(texts, np.log1p((5 - np.arange(10) % 3) / 1.0), 3.0).scores(0)
    assert scores[2] > scores[1] > scores[3] == 0


def test_word_encoder_equals_tokenizer():
    encoder = packing.WordEncoder(WORDS)
    rng = random.Random(11)
    parts = ["a", "'s", "'LL", " ", "\n", "\xa0", "é", "é", "日", "12", "!", "\x1c", "İ", "The", "ß", "Σ", "½", "²", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(3000)]
    data, offsets = textbytes.flat(pa.array(texts), lower=True)
    ids, counts = encoder.encode(data, offsets)
    for text, n, end in zip(texts, counts, np.cumsum(counts)):
        assert ids[end - n:end].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
