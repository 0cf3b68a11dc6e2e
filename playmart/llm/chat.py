"""Chat formatting with a grammar round trip. DataFrame functions only.

A turn is rendered as  <s>ROLE[INST] TEXT [/INST]</s>  and a conversation as its turns in order. The grammar
is deterministic: a conversation is split at the end mark, a turn at the first [INST] and the last [/INST];
then a backslash before any character is taken away.

Every turn is first rendered as it is and parsed again. Where that does not give the same role and text, or where
they hold a control string, backslashes are doubled and one is put behind the first character of every control
string; so the only control strings of a formatted conversation are the template's. The whole conversation is then parsed once more; if it differs from its source, all its
turns are escaped, which always reads back.

Defined cases: a null role or text counts as empty; turns are ordered by turn (null first), then role and
text, so ties and repeated rows have a fixed order and all stay. Rows without conv_id are one conversation.
Texts of any length and no rows at all are fine. A conversation is one value, as its digest needs it whole.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, OPEN, CLOSE, END = "<s>", "[INST] ", " [/INST]", "</s>"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
LEARNED_ROLE = "assistant"
BLOCK = 256  # numbers that are summed one by one, see _sums_before


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def _any_mark(text: Column) -> Column:
    return reduce(Column.__or__, [F.contains(text, F.lit(mark)) for mark in CONTROL])


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(BEGIN), role, F.lit(OPEN), text, F.lit(CLOSE + END))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body names it."""
    return F.transform(F.array(value), body)[0]


def _sums_before(sizes: Column) -> Column:
    """For every number of an array the sum of those before it.

    An array that grows by one in an aggregate is copied every time, so sums are taken within blocks, then over
    blocks: the work is BLOCK copies a number at most, not the length of the array.
    """

    def grown(numbers: Column, size: Callable[[Column], Column]) -> Column:
        start = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("before"))
        return F.aggregate(
            numbers, start,
            lambda a, x: F.struct(
                (a["total"] + size(x)).alias("total"),
                F.concat(a["before"], F.array(a["total"])).alias("before"),
            ),
        )

    def whole(parts: Column) -> Column:
        begins = grown(parts, lambda part: part["total"])["before"]
        shifted = F.zip_with(
            parts, begins, lambda part, begin: F.transform(part["before"], lambda x: x + begin)
        )
        return F.flatten(shifted)

    def blocks(numbers: Column) -> Column:
        first = F.sequence(F.lit(1), F.greatest(F.size(numbers), F.lit(1)), F.lit(BLOCK))
        return F.transform(first, lambda at: grown(F.slice(numbers, at, F.lit(BLOCK)), lambda x: x))

    return _let(sizes, lambda numbers: _let(blocks(numbers), whole))


def _pieces(formatted: Column) -> Column:
    """The rendered turns of a conversation, each without its end mark; what follows the last mark is not one."""
    return _let(F.split(formatted, END), lambda p: F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))))


def _turn(piece: Column, *more: Callable[[Column, Column], Column]) -> Column:
    """role and text of a piece, and what `more` makes of its head and its text as written."""
    head = F.substring_index(piece, OPEN, 1)
    body = F.substr(piece, F.char_length(head) + len(OPEN) + 1)
    text = F.substr(body, F.lit(1), F.char_length(body) - len(CLOSE))
    role = unescape(F.substr(head, F.lit(len(BEGIN) + 1)))
    return F.struct(role.alias("role"), unescape(text).alias("text"), *(f(head, text) for f in more))


def parse(formatted: Column) -> Column:
    """Array of (role, text, at, size) read from a formatted conversation.

    at and size (code points) are where the turn's text stands, so a loss mask can be made of them. An empty
    string has no turns.
    """

    def placed(pieces: Column) -> Column:
        begins = _sums_before(F.transform(pieces, lambda p: F.char_length(p) + len(END)))
        return F.zip_with(
            pieces, begins,
            lambda piece, begin: _turn(
                piece,
                lambda head, text: (begin + F.char_length(head) + len(OPEN)).alias("at"),
                lambda head, text: F.char_length(text).alias("size"),
            ),
        )

    return _let(_pieces(formatted), placed)


def _reads_as(formatted: Column, source: Column) -> Column:
    """Does formatted parse to the roles and texts of source?"""
    return F.transform(_pieces(formatted), lambda piece: _turn(piece)) == source


def format_chats(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns (as parsed from formatted) and round_trip."""
    role, text = F.col("role"), F.col("text")
    rows = conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    rows = rows.withColumns({"plain": render(role, text), "escaped": render(escape(role), escape(text))})
    free = ~_any_mark(role) & ~_any_mark(text)
    stays = F.when(free, _reads_as(F.col("plain"), source)).otherwise(F.lit(False))
    rows = rows.withColumn("first", F.when(stays, F.col("plain")).otherwise(F.col("escaped")))
    turn = F.struct("turn", "role", "text", "first", "escaped")
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("all"))

    def joined(field: str) -> Column:
        return F.array_join(F.transform("all", lambda t: t[field]), "")

    said = F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    chats = chats.withColumns({"first": joined("first"), "said": said, "escaped": joined("escaped")})
    kept = F.when(_reads_as(F.col("first"), F.col("said")), F.col("first")).otherwise(F.col("escaped"))
    chats = chats.select("conv_id", "said", kept.alias("formatted"))
    chats = chats.withColumn("turns", parse(F.col("formatted")))
    read = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return chats.select("conv_id", "formatted", "turns", (read == F.col("said")).alias("round_trip"))


def learned_text(formatted: Column, turns: Column) -> Column:
    """All text under the loss mask, the assistant's places in the formatted text, without its escapes.

    A place is cut out of its own rendered turn, as looking for a code point counts all those before it.
    """
    after = len(CLOSE + END)

    def begin(i: Column) -> Column:
        return F.coalesce(F.get(turns, i - 1)["at"] + F.get(turns, i - 1)["size"] + after, F.lit(0))

    mask = F.transform(
        turns,
        lambda t, i: F.struct(
            (t["role"] == LEARNED_ROLE).alias("learned"),
            (t["at"] - begin(i) + 1).alias("at"),
            t["size"].alias("size"),
        ),
    )
    cut = F.zip_with(
        _pieces(formatted), mask,
        lambda piece, m: F.when(m["learned"], unescape(F.substr(piece, m["at"], m["size"]))),
    )
    return F.array_join(cut, "")
