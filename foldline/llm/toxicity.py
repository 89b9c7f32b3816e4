"""Toxicity by a weighted finite-state pattern grammar.

The words of a clause that belong to a class (insult, threat, target, negation,
reported speech) are the input of a cascade of transducers, each of which rewrites
the symbols of hits, insults and threats, by what it has read before them: a
negation turns the next hit, a second one takes that back; reported speech turns
all hits behind it; a target aims the hits behind it, or the one right before it.
What comes out has a weight for each hit, so that a clause counts by what is said
of whom and in which order, not by its words alone. The insult lexicon and its
weights are learned from labelled rows; words of the other classes are fixed.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldline.llm import textbytes as tb
from foldline.llm.shared import documents

INSULT, THREAT, TARGET, NEGATION, REPORT = range(1, 6)
# fixed values: function words of the four languages
WORDS = {
    TARGET: "you your yours yourself u they them he she him her du dich dir dein deine ihr euch tu te toi ton ta tes vous votre tú tu ti usted ustedes vosotros",
    NEGATION: "not no never nobody isn't aren't don't doesn't wasn't won't nicht kein keine nie niemals ne pas jamais aucun no nunca jamás ningún tampoco",
    REPORT: "said says say told claims claimed called calls quoted wrote sagte sagt nannte schrieb dit disait appelait écrit dijo dice llamó escribió",
    THREAT: "kill hurt shoot stab strangle töten erschießen tuer frapper matar golpear",
}
#: What a mark does to the weight of a hit; a threat at nobody counts by half.
FACTORS = {TARGET: 1.25, NEGATION: 0.6, REPORT: 0.7}
UNAIMED_THREAT = 0.5
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?;\n"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x80:] = True
_LETTER[[ord(c) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789'"]] = True


#: A symbol is a tag with the marks (tags) that transducers have put on it.
Symbol = tuple[int, frozenset]
HITS = (INSULT, THREAT)


@dataclass(frozen=True)
class Transducer:
    """A deterministic machine that rewrites symbols: ``moves[state, tag]`` is (next state, mark or None).

    The mark goes on the symbol that is read. Tags without a move keep the state
    and pass as they are; reading from the right, a symbol sees what follows it.
    """
    moves: dict
    start: str = "start"
    from_right: bool = False

    def run(self, symbols: list[Symbol]) -> list[Symbol]:
        state, out = self.start, []
        for tag, marks in reversed(symbols) if self.from_right else symbols:
            state, mark = self.moves.get((state, tag), (state, None))
            out.append((tag, marks if mark is None else marks | {mark}))
        return out[::-1] if self.from_right else out


def each_hit(state: str, to: str, mark: int | None) -> dict:
    return {(state, hit): (to, mark) for hit in HITS}


#: The next hit is negated; another negation before it takes that back.
NEGATED = Transducer({("start", NEGATION): ("negated", None), ("negated", NEGATION): ("start", None)} | each_hit("negated", "start", NEGATION))
#: What somebody says, says somebody else: all hits behind it.
REPORTED = Transducer({("start", REPORT): ("quoted", None)} | each_hit("quoted", "quoted", REPORT))
#: Hits behind a target are at it.
AIMED = Transducer({("start", TARGET): ("aimed", None)} | each_hit("aimed", "aimed", TARGET))
#: So is the hit right before one, with no other class between them.
AIMED_BACK = Transducer({("start", TARGET): ("aimed", None), ("aimed", NEGATION): ("start", None), ("aimed", REPORT): ("start", None)}
                        | each_hit("aimed", "start", TARGET), from_right=True)


def compose(*machines: Transducer):
    """The cascade that feeds each machine with what the one before it wrote."""
    def run(symbols: list[Symbol]) -> list[Symbol]:
        for machine in machines:
            symbols = machine.run(symbols)
        return symbols
    return run


CLAUSE = compose(NEGATED, REPORTED, AIMED, AIMED_BACK)


def hit_factor(tag: int, marks: frozenset) -> float:
    """The weight of a hit by its class and marks."""
    factor = 1.0
    for mark in marks:
        factor *= 1.0 if mark == TARGET and tag == THREAT else FACTORS[mark]
    return factor * (UNAIMED_THREAT if tag == THREAT and TARGET not in marks else 1.0)


def clause_score(tags: list[int], weights: list[float]) -> float:
    """Score of one clause: the weights of its insults and threats, each times what its marks make of it."""
    out = CLAUSE([(tag, frozenset()) for tag in tags])
    return sum(w * hit_factor(tag, marks) for (tag, marks), w in zip(out, weights, strict=True) if tag in HITS)


@dataclass
class Lexicon:
    """Insult words and stems with their weights, threat weights, and the log-odds of a text that no clause matches."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    threats: dict[str, float] = field(default_factory=dict)
    base: float = -3.0


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all runs of letters, digits, apostrophes and non-ASCII bytes."""
    letter = _LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin, stop = letter.copy(), letter.copy()
    begin[1:] &= ~letter[:-1] | edge[1:-1]
    stop[:-1] &= ~letter[1:] | edge[1:-1]
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1


def learn(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = 20000, min_toxic: int = 5,
          precision: float = 0.9, stem_bytes: tuple[int, ...] = (4, 5, 6)) -> Lexicon:
    """Fit the lexicon on at most ``sample`` usable labelled rows, those with the smallest hash of their id.

    A word, or a stem of ``stem_bytes`` bytes, is an insult if ``min_toxic``
    toxic texts (two more for a stem) have it and toxic texts are ``precision``
    of those that have it; its weight is the smoothed log-odds
    against the sample's. Rows of labels with null doc_id or toxic, and
    documents with null text, teach nothing; a repeated label counts once.
    """
    some = (labels.select("doc_id", "toxic").where(usable & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = documents(docs).where(F.col("text").isNotNull()).join(F.broadcast(some), "doc_id").select("text", "toxic")

    def parts(column: pa.Array) -> Iterator[tuple[set[bytes], set[bytes]]]:
        for text in pc.utf8_lower(column):
            data, offsets = tb.flat(pa.array([text.as_py()]))
            words = set(tb.pieces(data, *spans(data, offsets)))
            yield words, {w[:k] for w in words for k in stem_bytes if len(w) > k}

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {"w": Counter(), "s": Counter()}, {"w": Counter(), "s": Counter()}
        totals = [0, 0]
        for batch in batches:
            for (words, stems), toxic in zip(parts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                k = int(toxic > 0)
                totals[k] += 1
                found[k]["w"].update(words), found[k]["s"].update(stems)
        # what no toxic text of this task has may still be needed for its clean count, so all keys go on
        keys = [(kind, w) for kind in "ws" for w in found[0][kind].keys() | found[1][kind].keys()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(["t", *(k for k, _ in keys)]), pa.array([b"", *(w for _, w in keys)], pa.binary()),
             pa.array([totals[1], *(found[1][k][w] for k, w in keys)], pa.int64()), pa.array([totals[0], *(found[0][k][w] for k, w in keys)], pa.int64())],
            ["kind", "word", "toxic", "clean"])

    table = rows.mapInArrow(counts, "kind string, word binary, toxic long, clean long").groupBy("kind", "word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # bounded by the sample: each kept row needs min_toxic texts of it
    kept = table.where((F.col("kind") == "t") | (F.col("toxic") >= min_toxic) & (F.col("toxic") >= precision * (F.col("toxic") + F.col("clean")))).collect()
    n_toxic, n_clean = next(((r.toxic, r.clean) for r in kept if r.kind == "t"), (0, 0))
    out = Lexicon()
    if not n_toxic:
        return out
    prior = log((n_toxic + 0.5) / (n_clean + 0.5))
    weigh = lambda r: log((r.toxic + 0.5) / (r.clean + 0.5)) - prior
    word_weights = {bytes(r.word): weigh(r) for r in kept if r.kind == "w"}
    readable = lambda b: b.decode(errors="ignore").encode() == b
    out.stems = {bytes(r.word).decode(): weigh(r) for r in kept if r.kind == "s" and r.toxic >= min_toxic + 2 and readable(bytes(r.word))}
    out.words = {w.decode(): x for w, x in word_weights.items() if readable(w)}
    usual = float(np.median(list(word_weights.values()))) if word_weights else -prior
    out.threats = {w: usual for w in WORDS[THREAT].split() if w not in out.words}
    # texts that the lexicon misses: their share of toxic ones is the score without a match
    scores = score_texts(rows.select(F.monotonically_increasing_id().alias("doc_id"), "text", "toxic"), out, extra="toxic int")
    missed = scores.where("n_clauses = 0").agg(F.sum((F.col("toxic") > 0).cast("int")), F.count(F.lit(1))).first()
    toxic, count = missed[0] or 0, missed[1]
    out.base = log((toxic + 0.5) / (count - toxic + 0.5))
    return out


class Tagger:
    """Finds the tagged words of many texts at once by their hashes."""

    def __init__(self, lexicon: Lexicon):
        table: dict[int, tuple[int, float]] = {}
        for tag in (TARGET, NEGATION, REPORT):
            table |= {h: (tag, 0.0) for h in self.hashes(WORDS[tag].split())}
        for words, tag in ((lexicon.threats, THREAT), (lexicon.words, INSULT)):
            table |= dict(zip(self.hashes(words), ((tag, x) for x in words.values()), strict=True))
        self.words = self.sorted(table)
        by_size = defaultdict(dict)
        for stem, weight in lexicon.stems.items():
            by_size[len(stem.encode())][stem] = weight
        self.stems = {size: self.sorted(dict(zip(self.hashes(of), ((INSULT, x) for x in of.values()), strict=True))) for size, of in by_size.items()}

    @staticmethod
    def hashes(words) -> list[int]:
        if not words:
            return []
        data, offsets = tb.flat(pa.array(list(words)))
        return tb.span_hash(tb.prefix_hash(data), offsets[:-1], offsets[1:]).tolist()

    @staticmethod
    def sorted(table: dict[int, tuple[int, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = sorted(table)
        return np.array(keys, np.uint64), np.array([table[k][0] for k in keys], np.int8), np.array([table[k][1] for k in keys])

    def find(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, tags and weights of the tagged words, in order."""
        start, end = spans(data, offsets)
        prefix = tb.prefix_hash(data)
        tag, weight = np.zeros(len(start), np.int8), np.zeros(len(start))
        for size, (keys, tags, weights) in [(0, self.words), *self.stems.items()]:
            if not len(keys):
                continue
            at = np.flatnonzero((end - start > size) & (tag == 0)) if size else np.arange(len(start))
            hashes = tb.span_hash(prefix, start[at], start[at] + size if size else end[at])
            place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            hit = keys[place] == hashes
            tag[at[hit]], weight[at[hit]] = tags[place[hit]], weights[place[hit]]
        found = np.flatnonzero(tag)
        return start[found], tag[found], weight[found]


def score_texts(docs: DataFrame, lexicon: Lexicon, extra: str = "") -> DataFrame:
    """(doc_id, score, n_clauses, [extra column]) of every whole text; see ``score_documents``."""
    names = ["doc_id", "score", "n_clauses", *([extra.split()[0]] if extra else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(lexicon)
        for batch in batches:
            total, clauses = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            data, offsets = tb.flat(pc.utf8_lower(batch.column(1)))
            for a, b in tb.blocks(offsets):
                at = offsets[a:b + 1]
                own = data[at[0]:at[-1]]
                start, tag, weight = tagger.find(own, at - at[0])
                stops = np.union1d(np.flatnonzero(_END[own]), at - at[0])
                clause = np.searchsorted(stops, start, "right")
                hot = np.isin(clause, clause[(tag == INSULT) | (tag == THREAT)])
                start, tag, weight, clause = start[hot], tag[hot], weight[hot], clause[hot]
                row = np.searchsorted(at - at[0], start, "right") - 1 + a
                cuts = [0, *(np.flatnonzero(clause[1:] != clause[:-1]) + 1).tolist(), len(clause)] if len(clause) else [0]
                for x, y in zip(cuts, cuts[1:], strict=False):
                    total[row[x]] += clause_score(tag[x:y].tolist(), weight[x:y].tolist())
                    clauses[row[x]] += 1
            score = 1 / (1 + np.exp(-np.clip(lexicon.base + total, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(clauses), *batch.columns[2:]], names)

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *names[3:])
    return rows.mapInArrow(run, "doc_id long, score double, n_clauses long" + (f", {extra}" if extra else ""))


def score_documents(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """One row per document: doc_id, score (0 to 1), n_clauses (clauses that hold an insult or a threat).

    A clause ends at ``.``, ``!``, ``?``, ``;`` or a newline. The score is the
    logistic of the lexicon's base plus the sum of the clause scores. Null and
    empty texts have no clause and so the base score. Rows may repeat; other
    columns are ignored.
    """
    return score_texts(documents(docs), lexicon)


def base_score(lexicon: Lexicon) -> float:
    return 1 / (1 + exp(-lexicon.base))


def drop_toxic(docs: DataFrame, labels: DataFrame, usable: Column, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``threshold``; rows without an id stay.

    A row goes by its id and text together: a clean text that shares a toxic one's id stays.

    The lexicon is learned from the usable rows of ``labels``.
    """
    key = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)
    rows = documents(docs).withColumn("text_key", key)
    scores = score_texts(rows, learn(docs, labels, usable), "text_key string").where((F.col("score") >= threshold) & F.col("doc_id").isNotNull())
    gone = scores.select(F.col("doc_id").alias("toxic_id"), F.col("text_key").alias("toxic_key")).distinct()
    names = docs.columns
    at = docs.toDF(*[f"c{i}" for i in range(len(names))])  # names of the documents' columns may be any
    own_id, own_text = f"c{names.index('doc_id')}", f"c{names.index('text')}"
    same = (F.col(own_id).cast("long") == F.col("toxic_id")) & (F.sha2(F.coalesce(F.col(own_text).cast("string"), F.lit("")).cast("binary"), 256) == F.col("toxic_key"))
    return at.join(gone, same, "left_anti").toDF(*names)
