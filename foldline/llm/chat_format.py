"""Chat formatting with typed content parts, in DataFrame functions alone.

A message is a list of parts (kind, text, ref, tokens). The visitor walks them
in order: text is escaped, any other kind (image, audio, document) becomes a
numbered placeholder, and its reference and expanded token count are recorded.

Template of a turn: ``<s>role``, a newline, the content, ``</s>``; the content
of every role but the assistant stands between ``[INST]`` and ``[/INST]``; a
placeholder is ``[image 1]``. Texts are written without ``<`` and ``[`` (as
character references, and so ``&`` too), so that a control string in the output
is one of the template's, and reading it back gives the texts unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
OPEN, CLOSE, ASK, ASKED = "<s>", "</s>", "[INST]", "[/INST]"
_REFERENCES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
_NEWLINE = ("\n", "&#10;")  # in a role, which a newline ends
_PARTS = "array<struct<kind:string,text:string,ref:string,tokens:bigint>>"


def escape(text: Column, *more: tuple[str, str]) -> Column:
    for plain, written in (*_REFERENCES, *more):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, *more: tuple[str, str]) -> Column:
    for plain, written in (*more, *reversed(_REFERENCES)):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def text_parts(text: Column) -> Column:
    """The parts of a message that is one text; null is empty."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(0).cast("long").alias("tokens"))).cast(_PARTS)


def format_chats(messages: DataFrame) -> DataFrame:
    """One row per conv_id: conv_id, n_turns, formatted, loss_spans, attachments, expanded_tokens.

    ``messages`` has conv_id, turn, role, parts; other columns are ignored. The
    turns of a conversation are ordered by turn, then role, then content (so
    ties and repeated rows, which stay, have one order); null turns come first.
    Null roles, kinds and texts: empty role, text, empty text; null parts: no
    content. A null conv_id is a conversation of its own. ``loss_spans`` has
    start (from 0) and length, in code points of ``formatted``, of every
    assistant content; ``attachments`` has number (from 1, through the whole
    conversation), turn (from 0), kind, ref and tokens, in order.

    A conversation is one output value and so is put together in one task;
    turns are formatted before the shuffle and gathered map-side first.
    """
    part = lambda p: F.struct(F.coalesce(p["kind"], F.lit("text")).alias("kind"), F.coalesce(p["text"], F.lit("")).alias("text"),
                              p["ref"].alias("ref"), F.coalesce(p["tokens"], F.lit(0)).alias("tokens"))
    rows = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                           F.transform(F.coalesce(F.col("parts").cast(_PARTS), F.array().cast(_PARTS)), part).alias("parts"))
    # pieces: the content cut at its placeholders; the numbers that fill the gaps are known only in the whole conversation
    joined = F.array_join(F.transform("parts", lambda p: F.when(p["kind"] == "text", escape(p["text"])).otherwise(F.lit("["))), "")
    rows = rows.select("conv_id", "turn", "role", F.split(joined, r"\[", -1).alias("pieces"),
                       F.filter("parts", lambda p: p["kind"] != "text").alias("others"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "pieces", "others"))).alias("turns"))
    counts = F.transform("turns", lambda t: F.size(t["others"]))
    # others before each turn, as a running sum
    before = F.aggregate(counts, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    has_others = F.exists("turns", lambda t: F.size(t["others"]) > 0)
    turns = turns.withColumn("before", F.when(has_others, before))
    past = lambda i: F.coalesce(F.get(F.col("before"), i), F.lit(0))

    def content(t: Column, i: Column) -> Column:
        gap = lambda k: F.concat(F.lit("["), escape(t["others"][k]["kind"]), F.lit(" "), (past(i) + k + 1).cast("string"), F.lit("]"))
        filled = F.transform(t["pieces"], lambda piece, k: F.concat(F.when(k > 0, gap(k - 1)).otherwise(F.lit("")), piece))
        return F.array_join(filled, "")

    def turn(t: Column, i: Column) -> Column:
        own = t["role"] == ASSISTANT
        head = F.concat(F.lit(OPEN), escape(t["role"], _NEWLINE), F.lit("\n"), F.when(own, "").otherwise(ASK))
        tail = F.concat(F.when(own, "").otherwise(ASKED), F.lit(CLOSE))
        return F.struct(own.alias("own"), head.alias("head"), content(t, i).alias("content"), tail.alias("tail"))

    def attached(t: Column, i: Column) -> Column:
        return F.transform(t["others"], lambda p, k: F.struct((past(i) + k + 1).cast("long").alias("number"), i.cast("long").alias("turn"),
                                                              p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")))

    done = turns.select("conv_id", F.transform("turns", turn).alias("said"), F.flatten(F.transform("turns", attached)).alias("attachments"))
    # each turn's place: one running sum over (start of the turn, span of its content)
    place = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        start, size = acc["at"] + F.length(t["head"]), F.length(t["content"]).cast("long")
        span = F.when(t["own"], F.array(F.struct(start.alias("start"), size.alias("length")))).otherwise(F.array().cast("array<struct<start:bigint,length:bigint>>"))
        return F.struct((start + size + F.length(t["tail"])).alias("at"), F.concat(acc["spans"], span).alias("spans"))

    return done.select(
        "conv_id", F.size("said").cast("long").alias("n_turns"),
        F.array_join(F.transform("said", lambda t: F.concat(t["head"], t["content"], t["tail"])), "").alias("formatted"),
        F.aggregate("said", place, step)["spans"].alias("loss_spans"), "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda acc, a: acc + a["tokens"]).alias("expanded_tokens"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) of every turn, read from a formatted conversation; placeholders stay as they are."""
    def one(piece: Column) -> Column:
        body = F.substring(piece, len(OPEN) + 1, F.length(piece))
        role = F.substring_index(body, "\n", 1)
        content = F.substring(body, F.length(role) + 2, F.length(body))
        asked = F.substring(content, F.lit(len(ASK) + 1), F.length(content) - len(ASK) - len(ASKED))
        return F.struct(unescape(role, _NEWLINE).alias("role"), unescape(F.when(role == ASSISTANT, content).otherwise(asked)).alias("text"))

    return F.transform(F.filter(F.split(formatted, CLOSE, -1), lambda x: x != ""), one)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def digests(chats: DataFrame) -> DataFrame:
    """What is read back from the output: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    read = chats.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
