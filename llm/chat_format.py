"""Chat formatting with a grammar round trip (DataFrame functions only).

A conversation becomes one training text in a bracketed template::

    <s>[INST] user [/INST] assistant </s>[SYS] system [/SYS][ROLE] tool [TEXT] text [/ROLE]

(all roles but user, assistant and system are spelled out). A deterministic
parser reads it back: a turn is told by its first characters, its text runs to
the first control string that no backslash precedes, and only the turn's own
closing string may stand there; backslashes before control strings are then
taken off by one. Turns are rendered as they are, parsed, and compared with the
source. Where the parsed turn differs (a text holds a control string, or one
that looks escaped), its content is escaped by one more backslash before every
control string in it, and rendered, parsed and compared again, until it is
identical. The whole conversation is then parsed again and compared with the
whole source; a difference ends the job. (One escape is enough: it leaves no
control string bare, and taking off one backslash gives the source.) Turns that
need no escaping are never touched.

The loss mask is a list of spans (start and length in code points of the
formatted text, and in its UTF-8 bytes), one per assistant turn, on its escaped
text alone. ``read_back`` finds turns and loss text in the formatted text and
the mask.

Defined cases: rows by turn, null turns first, equal turns by role and text;
null role and text are empty (an empty role is spelled out as such); a null
conv_id is a conversation of its own; repeated rows are turns of their own; an
empty table gives no rows; extra columns are ignored. A conversation becomes one
text, so it must fit Spark's 2 GB string; only its own turns meet in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BEGIN = "<s>"
#: Roles with marks of their own: opening and closing string. Others are [ROLE] role [TEXT] text [/ROLE].
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("[SYS] ", " [/SYS]")}
ROLE, TEXT, END = "[ROLE] ", " [TEXT] ", " [/ROLE]"
CONTROL = r"(?:</?s>|\[/?(?:INST|SYS|ROLE)\]|\[TEXT\])"
_BARE = rf"(?<!\\){CONTROL}"
#: A body stops at the first bare control string, whatever follows: the parser never looks further.
_BODY = rf"(?>.*?(?={_BARE}))"
TURN = (rf"\[INST\] {_BODY}(?<= )\[/INST\]|\[SYS\] {_BODY}(?<= )\[/SYS\]|"
        rf"\[ROLE\] {_BODY}(?<= )\[TEXT\] {_BODY}(?<= )\[/ROLE\]| {_BODY}(?<= )</s>")
ROUNDS = 2


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)(\\*+{CONTROL})", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)\\(\\*+{CONTROL})", "$1")


def _inner(piece: Column, opening: str, closing: str) -> Column:
    return F.substring(piece, F.lit(len(opening) + 1), F.length(piece) - len(opening) - len(closing))


def render(role: Column, text: Column) -> Column:
    """A turn in the template; role and text are already escaped as far as they are to be."""
    out = F.concat(F.lit(ROLE), role, F.lit(TEXT), text, F.lit(END))
    for name, (opening, closing) in MARKS.items():
        out = F.when(role == name, F.concat(F.lit(opening), text, F.lit(closing))).otherwise(out)
    return out


def _read(piece: Column) -> Column:
    """Role and text of a piece that ``TURN`` matched. A spelled-out role ends at the first bare control string."""
    spelled = _inner(piece, ROLE, END)
    name = F.regexp_extract(spelled, rf"(?s)^(.*?) {_BARE}", 1)
    out = F.struct(unescaped(name).alias("role"),
                   unescaped(F.substring(spelled, F.length(name) + len(TEXT) + 1, F.length(spelled))).alias("text"))
    for role, (opening, closing) in MARKS.items():
        out = F.when(piece.startswith(opening) & piece.endswith(closing),
                     F.struct(F.lit(role).alias("role"), unescaped(_inner(piece, opening, closing)).alias("text"))).otherwise(out)
    return out


def _pieces(body: Column) -> Column:
    """The turns at the start of a body, one after the other, as far as the grammar goes."""
    return F.regexp_extract_all(body, F.lit(rf"(?s)\G(?:{TURN})"), F.lit(0))


def _let(value: Column, then) -> Column:
    """``then`` over ``value``, which is computed once however often it is named."""
    return F.transform(F.array(value), then)[0]


def _returns(piece: Column, role: Column, text: Column) -> Column:
    """Whether the parser gets one turn out of ``piece``, and this one."""
    return _let(_pieces(piece), lambda p: F.when((F.size(p) == 1) & (p[0] == piece),
                                                 _read(p[0]) == F.struct(role.alias("role"), text.alias("text"))).otherwise(False))


def _round_trip(role: Column, text: Column, rounds: int = ROUNDS) -> Column:
    """The turn's rendering, with as many escapes as its round trip needs; null where none of the rounds is identical."""
    def tried(r: Column, t: Column, left: int) -> Column:
        return _let(render(r, t), lambda piece: F.when(_returns(piece, role, text), piece).otherwise(
            tried(escaped(r), escaped(t), left - 1) if left > 1 else F.lit(None).cast("string")))
    return tried(role, text, rounds)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_mask) per conversation."""
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                 F.coalesce("text", F.lit("")).alias("text"))
    rendered = turns.withColumn("piece", _round_trip(F.col("role"), F.col("text")))
    opening, closing = MARKS["assistant"]
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    until = order.rowsBetween(Window.unboundedPreceding, -1)

    def span(size: Column, prefix: str) -> list[Column]:
        before = F.coalesce(F.sum(size.cast("long")).over(until), F.lit(0))  # the template's own marks are ASCII
        return [(before + len(BEGIN) + len(opening)).alias(f"{prefix}start"),
                (size - len(opening) - len(closing)).cast("long").alias(f"{prefix}length")]

    placed = rendered.select("conv_id", F.row_number().over(order).alias("at"), "role", "text", "piece",
                             F.struct(*span(F.length("piece"), ""), *span(F.octet_length("piece"), "byte_")).alias("span"))
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "at", "role", "text", "piece", "span"))).alias("turns"))
    mask = F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["span"])
    joined = F.concat(F.lit(BEGIN), F.array_join(F.transform("turns", lambda t: t["piece"]), ""))
    out = whole.select("conv_id", joined.alias("formatted"),
                       mask.alias("loss_mask"), F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"))
    # An unparsed piece is null and leaves out a turn, so the comparison finds it.
    same = _parsed(F.col("formatted")) == F.col("source")
    checked = F.when(F.coalesce(same, F.lit(False)), F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("no round trip for conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))))
    return out.select("conv_id", checked.alias("formatted"), "loss_mask")


def _parsed(formatted: Column) -> Column:
    """The turns of a whole formatted text, null where it isn't in the grammar."""
    body = F.substring(formatted, F.lit(len(BEGIN) + 1), F.length(formatted))
    return _let(_pieces(body), lambda p: F.when(
        formatted.startswith(BEGIN) & (F.array_join(p, "") == body), F.transform(p, _read)))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted) from formatted texts and their masks alone."""
    # By bytes, as finding a code point means counting from the start.
    loss = _let(F.col("formatted").cast("binary"), lambda b: F.array_join(F.transform("loss_mask", lambda m: unescaped(
        F.substring(b, (m["byte_start"] + 1).cast("int"), m["byte_length"].cast("int")).cast("string"))), ""))
    return formatted.select("conv_id", _parsed(F.col("formatted")).alias("turns"), loss.alias("loss_text"), "formatted")


def digests(read: DataFrame) -> DataFrame:
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def conflict(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """``conversations`` and conversation -1, whose texts are made of control strings."""
    text = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(added)
