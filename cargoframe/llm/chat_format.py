"""Chat formatting: prefix-target expansion of conversations.

Every assistant turn becomes its own example: all turns before it are the
context and only its reply is trainable. One further example without a
trainable part holds a conversation's end when its last turn is not an
assistant's, so the output always lets a reader recover every turn.

Template of a turn: ``<s>[INST] role [/INST] text</s>``. A backslash is put
inside control strings that occur in a role or text (``<\\/s>``), and existing
backslashes are doubled; ``unescape`` undoes both, so no input string can be
taken for a marker and nothing is lost.

Only DataFrame functions run here: one grouping by conversation, everything
else happens within its row. An example holds all turns before it, which the
method asks for; a conversation is therefore the unit that one task holds.

Defined cases: NULL text or role is the empty string; NULL turns come first;
equal turns are ordered by role, then text, and repeated rows stay repeated
turns; rows with NULL conv_id form one conversation; a conversation without
an assistant gives one example with an empty target; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the template's control strings
OPEN, ROLE_END, CLOSE = "<s>[INST] ", " [/INST] ", "</s>"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")


def escape(text: Column) -> Column:
    """Make a string free of control strings, reversibly."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for s in CONTROL:
        out = F.replace(out, F.lit(s), F.lit(f"{s[0]}\\{s[1:]}"))
    return out


def unescape(text: Column) -> Column:
    """Inverse of ``escape``: a backslash before a backslash stands for one,
    any other backslash was put in."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_conversations(turns: DataFrame, trainable_role: str = "assistant") -> DataFrame:
    """Examples of (conv_id, turn, role, text) rows: conv_id, example (from 0),
    last (does it hold the whole conversation), text, loss_start and loss_chars (code points of
    ``text`` that are trainable; 0 chars: none)."""
    one = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                   F.coalesce("text", F.lit("")).alias("text"))
    conv = turns.select("conv_id", one.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    head = lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(ROLE_END))
    conv = conv.select(
        "conv_id",
        F.transform("ts", head).alias("heads"),
        F.transform("ts", lambda t: escape(t["text"])).alias("bodies"),
        F.filter(F.transform("ts", lambda t, i: F.when((t["role"] == trainable_role) | (i == F.size("ts") - 1), i)),
                 lambda i: i.isNotNull()).alias("ends"),
        F.transform("ts", lambda t: t["role"] == trainable_role).alias("own"))
    ex = conv.select("conv_id", "heads", "bodies", "own", F.posexplode("ends").alias("example", "at"))
    seg = F.transform(F.sequence(F.lit(1), F.col("at")),
                      lambda i: F.concat(F.element_at("heads", i), F.element_at("bodies", i), F.lit(CLOSE)))
    context = F.when(F.col("at") == 0, F.lit("")).otherwise(F.array_join(seg, ""))
    ex = ex.select("conv_id", F.col("example").cast("long").alias("example"),
                   (F.col("at") == F.size("own") - 1).alias("last"),
                   F.concat(context, F.element_at("heads", F.col("at") + 1)).alias("before"),
                   F.element_at("bodies", F.col("at") + 1).alias("reply"),
                   F.element_at("own", F.col("at") + 1).alias("own"))
    return ex.select("conv_id", "example", "last",
                     F.concat("before", "reply", F.lit(CLOSE)).alias("text"),
                     F.length("before").cast("long").alias("loss_start"),
                     F.when(F.col("own"), F.length("reply")).otherwise(0).cast("long").alias("loss_chars"))


def read_turns(text: Column) -> Column:
    """Array of (role, text) read back from a formatted example."""
    parts = F.slice(F.split(text, r"<s>\[INST\] ", -1), 2, 1 << 30)

    def turn(p: Column) -> Column:
        cut = F.instr(p, ROLE_END)
        body = F.substring(p, cut + len(ROLE_END), F.length(p) - cut - len(ROLE_END) + 1 - len(CLOSE))
        return F.struct(unescape(F.substring(p, F.lit(1), cut - 1)).alias("role"), unescape(body).alias("text"))

    return F.transform(parts, turn)


def conversation_digests(examples: DataFrame) -> DataFrame:
    """One row per conversation, read back from the examples alone."""
    target = unescape(F.substring(F.col("text"), F.col("loss_start").cast("int") + 1, F.col("loss_chars").cast("int")))
    whole = F.when(F.col("last"), F.transform(read_turns(F.col("text")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    rows = examples.select("conv_id", F.struct("example", target.alias("target")).alias("t"), whole.alias("whole"),
                           F.length("text").alias("n"))
    got = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"), F.first("whole", True).alias("whole"),
                                      F.sum("n").cast("long").alias("formatted_chars"), F.count("*").alias("n_examples"))
    loss = F.array_join(F.transform("ts", lambda t: t["target"]), "")
    return got.select(
        "conv_id", F.size("whole").cast("long").alias("n_turns"), F.sha2(F.array_join("whole", ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars", "n_examples")
