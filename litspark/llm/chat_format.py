"""Chat formatting: typed content parts become one marked-up string per conversation.

All of it is DataFrame expressions. A visitor over each turn's parts writes text escaped, and
every image, audio or document part as an ordered placeholder; it records which attachment a
placeholder stands for and how many tokens it expands to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound

#: Turn marks of the template.
START, END = "<|im_start|>", "<|im_end|>"
#: Control strings, as first character and rest. ``<|`` covers all of the template's own marks.
CONTROL_REST = r"\||s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\]"
#: Types that have a placeholder of their own; any other but text is written as ``other``.
MEDIA = ("image", "audio", "document")
PART_TYPE = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"


def escape(c: Column) -> Column:
    """Put a backslash behind the first character of each control string (one more, if some stand
    there already). No control string is left, and :func:`unescape` gives the text back."""
    return F.regexp_replace(c, rf"([<\[])(\\*)(?={CONTROL_REST})", r"$1\\$2")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, rf"([<\[])\\(\\*)(?={CONTROL_REST})", r"$1$2")


def text_parts(text: Column) -> Column:
    """A plain text as the only content part of its turn."""
    null = [F.lit(None).cast(t).alias(n) for n, t in (("uri", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *null))


def part_tokens(p: Column, patch: int = 14, audio_rate: float = 25.0, page_tokens: int = 256) -> Column:
    """Tokens that a placeholder expands to: image patches, audio frames, pages. Unknown sizes: 1."""
    image = F.ceil(p["width"] / patch) * F.ceil(p["height"] / patch)
    tokens = F.when(p["type"] == "image", image).when(p["type"] == "audio", F.ceil(p["seconds"] * audio_rate))
    tokens = tokens.when(p["type"] == "document", F.lit(page_tokens) * p["pages"])
    return F.greatest(F.coalesce(tokens, F.lit(1)).cast("bigint"), F.lit(1).cast("bigint"))


def format_chat(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """One row per conversation: ``conv``, ``formatted``, ``attachments``, ``expanded_tokens``, ``loss``.

    ``parts`` is an array of ``PART_TYPE``. Turns are ordered by (turn, role, content), nulls
    first, so ties and repeated rows have a fixed place and all stay. Null roles and texts are
    empty; a null or empty array is an empty turn. Text parts that follow one another are escaped as
    one text, so no control string arises where they meet. ``attachments`` lists (ref, type, uri, tokens)
    in the order of the placeholders ``<|type:ref|>``; a type other than those of ``MEDIA`` is written
    ``other`` there (it never enters the string itself) and expands to one token. ``loss`` lists the
    (start, length) in code points of every text inside ``formatted`` that an assistant says, without the
    placeholders among it. An empty table gives no rows; a null conversation id is a conversation. A
    conversation is one string, so its turns meet in one row, however long; nothing else is gathered.
    Other columns of ``df`` are ignored.
    """
    rows = df.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{parts}`"), F.array().cast(f"array<{PART_TYPE}>")).alias("parts"),
    )
    turns = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-(2**62))).alias("t"), "role", "parts"))).alias("turns"))
    is_text = lambda p: F.coalesce(p["type"], F.lit("text")) == "text"
    turns = turns.withColumn("media", F.filter(F.flatten(F.transform("turns", lambda t: t["parts"])), lambda p: ~is_text(p)))
    # attachments in the turns before each turn
    before = F.aggregate(
        "turns", F.array(F.lit(0)), lambda acc, t: F.concat(acc, F.array(F.element_at(acc, -1) + F.size(F.filter(t["parts"], lambda p: ~is_text(p)))))
    )

    def visit(t: Column, first: Column) -> Column:
        """The turn's string and the (start, length) of its texts; a text waits in ``run`` for the next one."""
        at = "struct<start:int,length:int>"
        start = F.struct(F.lit("").alias("s"), F.lit("").alias("run"), first.alias("ref"), F.array().cast(f"array<{at}>").alias("texts"))

        def told(acc: Column, run: Column) -> Column:
            span = F.struct(F.length(acc["s"]).alias("start"), F.length(run).alias("length"))
            return F.when(run == "", acc["texts"]).otherwise(F.concat(acc["texts"], F.array(span)))

        def part(acc: Column, p: Column) -> Column:
            kind = F.when(p["type"].isin(*MEDIA), p["type"]).otherwise("other")
            mark = F.concat(F.lit("<|"), kind, F.lit(":"), acc["ref"].cast("string"), F.lit("|>"))
            longer = F.struct(acc["s"].alias("s"), F.concat(acc["run"], F.coalesce(p["text"], F.lit(""))).alias("run"), acc["ref"].alias("ref"), acc["texts"].alias("texts"))
            placed = bound(escape(acc["run"]), lambda run: F.struct(F.concat(acc["s"], run, mark).alias("s"), F.lit("").alias("run"), (acc["ref"] + 1).alias("ref"), told(acc, run).alias("texts")))
            return F.when(is_text(p), longer).otherwise(placed)

        def whole_turn(acc: Column) -> Column:
            return bound(escape(acc["run"]), lambda run: F.struct(F.concat(acc["s"], run).alias("s"), told(acc, run).alias("texts")))

        return F.aggregate(t["parts"], start, part, whole_turn)

    def marked(t: Column, first: Column) -> Column:
        name = escape(F.replace(F.replace(t["role"], F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))
        return bound(visit(t, first), lambda v: F.struct(t["role"].alias("role"), F.concat(F.lit(START), name, F.lit("\n")).alias("head"), v["s"].alias("body"), v["texts"].alias("texts")))

    tail = f"{END}\n"

    def whole(bodies: Column) -> Column:
        text = F.array_join(F.transform(bodies, lambda b: F.concat(b["head"], b["body"], F.lit(tail))), "")
        ends = F.aggregate(
            bodies, F.array(F.lit(0)), lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(b["head"]) + F.length(b["body"]) + len(tail)))
        )

        def said(starts: Column) -> Column:
            moved = lambda b, i: F.transform(b["texts"], lambda x: F.struct((F.element_at(starts, i + 1) + F.length(b["head"]) + x["start"]).alias("start"), x["length"].alias("length")))
            return F.flatten(F.transform(bodies, lambda b, i: F.when(b["role"] == "assistant", moved(b, i)).otherwise(F.array().cast("array<struct<start:int,length:int>>"))))

        return F.struct(text.alias("formatted"), bound(ends, said).alias("loss"))

    # values that later ones are made of are bound, so that none is computed for each turn again
    made = bound(before, lambda firsts: bound(F.transform("turns", lambda t, i: marked(t, F.element_at(firsts, i + 1))), whole))
    listed = F.transform("media", lambda p, i: F.struct(i.alias("ref"), F.when(p["type"].isin(*MEDIA), p["type"]).otherwise("other").alias("type"), p["uri"].alias("uri"), part_tokens(p).alias("tokens")))
    turns = turns.select("conv", made.alias("made"), listed.alias("attachments"))
    return turns.select(
        F.col("conv").alias(conv), "made.formatted", "attachments", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda acc, x: acc + x["tokens"]).alias("expanded_tokens"), "made.loss"
    )


def read_back(formatted: Column) -> Column:
    """The (role, text) of every turn of a formatted conversation, unescaped."""
    def turn(x: Column) -> Column:
        body = F.substring(x, len(START) + 1, 2**31 - 1)
        return bound(body, lambda b: bound(F.substring_index(b, "\n", 1), lambda head: parts(b, head)))

    def parts(body: Column, head: Column) -> Column:
        role = F.regexp_replace(F.regexp_replace(unescape(head), r"(?<!\\)((?:\\\\)*)\\n", "$1\n"), r"\\\\", r"\\")
        return F.struct(role.alias("role"), unescape(F.substring(body, F.length(head) + 2, F.lit(2**31 - 1))).alias("text"))

    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    return bound(pieces, lambda p: F.transform(F.slice(p, F.lit(1), F.size(p) - 1), turn))
