"""Chat formatting with schema fingerprints.

A record's layout is known by its fingerprint, a hash of its sorted nested field paths. Each known
layout is declared once, by an example and by where its turns are found; the fingerprint selects
the declaration, which turns prompt, instruction, message and single-turn records into canonical
turns (role, text). Turns are then rendered with a template whose marks cannot occur inside texts:
each control string in a text gets an escape sign after its first character, and escape signs are
doubled, so unescaping gives the text back exactly.

Records are variant values; everything is a native expression. The only shuffle gathers the turns
of a conversation, whose whole text is one value of the result.

Defined results: a null text is empty, a null role is the empty role; turns are ordered by turn
number (null first), place inside the record, then role and text; repeated rows are turns of their
own; a record of unknown layout gives a conversation without its turns and counts in ``unmapped``;
a null conversation identifier is an identifier; an empty table gives an empty table; extra
columns of the input do not reach the result. Field names are read case-sensitively.
"""

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROLS = (TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]")


# ---- layouts --------------------------------------------------------------------------------

@dataclass(frozen=True)
class Layout:
    """``examples``: records of this layout, one for each set of fields it may have. ``fields``:
    (role, path) pairs in order of the turns; or ``items``, the path of an array whose entries
    have the paths ``role`` and ``text``, with role names translated by ``names``."""
    name: str
    examples: tuple
    fields: tuple = ()
    items: str = ""
    role: str = ""
    text: str = ""
    names: tuple = ()


LAYOUTS = (
    Layout("prompt", ('{"prompt":"","response":""}', '{"prompt":"","completion":""}',
                      '{"prompt":""}', '{"response":""}', '{"completion":""}'),
           fields=(("user", "$.prompt"), ("assistant", "$.response"),
                   ("assistant", "$.completion"))),
    Layout("instruction", ('{"instruction":"","input":"","output":""}',
                           '{"instruction":"","output":""}', '{"instruction":""}'),
           fields=(("system", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
    Layout("messages", ('{"messages":[{"role":"","content":""}]}', '{"messages":[]}'),
           items="$.messages", role="$.role", text="$.content"),
    Layout("conversations", ('{"conversations":[{"from":"","value":""}]}',
                             '{"conversations":[]}'),
           items="$.conversations", role="$.from", text="$.value",
           names=(("human", "user"), ("gpt", "assistant"))),
    Layout("message", ('{"message":{"role":"","content":""}}',),
           fields=(("$.message.role", "$.message.content"),)),
)


def field_paths(record: Column) -> Column:
    """The record's nested fields as text, without the types of its leaves."""
    return F.regexp_replace(F.schema_of_variant(record),
                            r"\b(?:STRING|VOID|BIGINT|DOUBLE|BOOLEAN|VARIANT|DECIMAL\(\d+, ?\d+\))"
                            r"(?=[,>]|$)", "*")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(field_paths(record))


def _string(record: Column, path: str) -> Column:
    return F.try_variant_get(record, path, "string")


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"),
                    F.coalesce(text, F.lit("")).alias("text"))


def layout_turns(layout: Layout, record: Column) -> Column:
    """The array of turns of a record that has this layout."""
    if layout.items:
        def one(item):
            role = _string(item, layout.role)
            for old, new in layout.names:
                role = F.when(role == old, F.lit(new)).otherwise(role)
            return _turn(role, _string(item, layout.text))
        return F.transform(F.try_variant_get(record, layout.items, "array<variant>"), one)
    turns = []
    for role, path in layout.fields:
        named = _string(record, role) if role.startswith("$") else F.lit(role)
        present = F.try_variant_get(record, path, "variant").isNotNull()
        turns.append(F.when(present, _turn(named, _string(record, path))))
    return F.filter(F.array(*turns), lambda t: t.isNotNull())


def canonical(records: DataFrame, record: str = "record", layouts=LAYOUTS) -> DataFrame:
    """Adds ``layout`` (null if unknown) and ``turns``."""
    marked = records.withColumn("_print", fingerprint(F.col(record)))
    name = turns = None
    for layout in layouts:
        prints = [fingerprint(F.parse_json(F.lit(e))) for e in layout.examples]
        hit = F.col("_print").isin(*prints)
        found = layout_turns(layout, F.col(record))
        name = F.when(hit, layout.name) if name is None else name.when(hit, layout.name)
        turns = F.when(hit, found) if turns is None else turns.when(hit, found)
    return marked.withColumns({"layout": name, "turns": turns}).drop("_print")


# ---- the template ---------------------------------------------------------------------------

def escaped(text: Column) -> Column:
    heads = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS)
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({heads})", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def formatted(records: DataFrame, conv: str = "conv_id", turn: str = "turn",
              record: str = "record", loss_role: str = "assistant",
              layouts=LAYOUTS) -> DataFrame:
    """One row per conversation: conv, formatted, loss_spans (byte start and length of each text
    under the loss mask, in order), unmapped (records of unknown layout)."""
    rows = canonical(records.select(conv, turn, record), record, layouts)
    rows = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                       F.col("layout").isNull().cast("long").alias("unmapped"),
                       F.posexplode_outer("turns").alias("place", "said"))
    head = F.concat(F.lit(TURN), escaped(F.col("said.role")), F.lit(TEXT))
    body = escaped(F.col("said.text"))
    rows = rows.select(
        "conv", "turn", "place", "unmapped", "said", head.alias("head"), body.alias("body"))
    piece = F.concat("head", "body", F.lit(END))
    order = Window.partitionBy("conv").orderBy("turn", "place", "said.role", "said.text")
    rows = rows.select(
        "conv", "unmapped", F.row_number().over(order).alias("n"), piece.alias("piece"),
        (F.coalesce(F.sum(F.octet_length(piece)).over(
            order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
         + F.octet_length("head")).alias("start"),
        F.octet_length("body").alias("length"),
        (F.col("said.role") == loss_role).alias("loss"))
    grouped = rows.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct(
            "n", "piece", "start", "length", "loss")))).alias("all"),
        F.sum("unmapped").alias("unmapped"))
    return grouped.select(
        F.col("conv").alias(conv),
        F.array_join(F.transform("all", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(F.filter("all", lambda x: x["loss"]), lambda x: F.struct(
            x["start"].cast("long").alias("start"), x["length"].cast("long").alias("length")))
        .alias("loss_spans"), "unmapped")


def read_turns(formatted_text: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.filter(F.split(formatted_text, re.escape(TURN)), lambda p: p != "")

    def one(piece):
        head = F.substring_index(piece, TEXT, 1)
        rest = F.substr(piece, F.char_length(head) + len(TEXT) + 1)
        return _turn(unescaped(head), unescaped(F.substring_index(rest, END, 1)))
    return F.transform(pieces, one)


def loss_text(data: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped; ``data`` is the formatted text as bytes."""
    return F.array_join(F.transform(spans, lambda s: unescaped(
        F.substr(data, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string"))), "")
