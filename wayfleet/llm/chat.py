"""Chat formatting: records of many layouts become canonical turns, then one escaped text with a loss mask.

A record is a JSON text or a typed column.  The paths of its nested fields, without values and value types, are hashed to a
fingerprint, read from the text or from the column's type; a table of declared mappings says, for each fingerprint, which path
holds what.  So a layout costs one line in ``LAYOUTS`` and no code.  Everything is DataFrame code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfleet.llm.common import free_name, settle

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """``paths``: the field paths that make up the layout.  ``turns``: (role, path) for single texts, or
    ``listed`` = (path of the list, role field, text field).  A null or absent text under ``optional`` roles gives no turn."""

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    listed: tuple[str, str, str] | None = None
    optional: tuple[str, ...] = ()


# Known layouts of conversation records.
LAYOUTS = (
    Layout("messages", ("messages[].role", "messages[].content"), listed=("messages", "role", "content")),
    Layout("conversations", ("conversations[].from", "conversations[].value"), listed=("conversations", "from", "value")),
    Layout("dialog", ("dialog[].speaker", "dialog[].utterance"), listed=("dialog", "speaker", "utterance")),
    Layout("prompt_completion", ("prompt", "completion"), turns=(("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt_response", ("prompt", "response"), turns=(("user", "prompt"), ("assistant", "response"))),
    Layout("question_answer", ("question", "answer"), turns=(("user", "question"), ("assistant", "answer"))),
    Layout("instruction", ("instruction", "output"), turns=(("user", "instruction"), ("assistant", "output"))),
    Layout("instruction_input", ("instruction", "input", "output"), turns=(("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("system_prompt", ("system", "prompt", "response"), turns=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("nested_prompt", ("data.prompt.text", "data.reply.text"), turns=(("user", "data.prompt.text"), ("assistant", "data.reply.text"))),
)
# Speaker names of other layouts, by canonical role.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant"}

_TYPE = r"VOID|BOOLEAN|BIGINT|STRING|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\)|DATE|TIMESTAMP(_NTZ)?|BINARY|VARIANT|UUID"


def shape(record: Column) -> Column:
    """The nested field names of a JSON record, sorted, value types struck out: ``{messages:[{content:_,role:_}]}``.

    Objects under one list are merged, so a list with one odd member still differs from a list without.
    Text that is no JSON gives null.
    """
    kind = F.schema_of_variant(F.try_parse_json(record))
    return F.regexp_replace(kind, rf"\b({_TYPE})(?=[,>]|$)", "_")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(shape(record))


def _shape_of(paths: tuple[str, ...]) -> str:
    """The shape a layout's paths describe, spelled as ``shape`` spells it."""
    tree: dict = {}
    for path in paths:
        at = tree
        for part in path.split("."):
            at = at.setdefault(part, {})

    def spell(node: dict) -> str:
        if not node:
            return "_"
        fields = []
        for name in sorted(node, key=lambda n: n.removesuffix("[]").encode()):
            inner = spell(node[name])
            fields.append(f"{name.removesuffix('[]')}: " + (f"ARRAY<{inner}>" if name.endswith("[]") else inner))
        return f"OBJECT<{', '.join(fields)}>"

    return spell(tree)


def shape_of_type(kind: T.DataType) -> str:
    """``shape`` of any record that a column of this type holds."""
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name.encode())
        return f"OBJECT<{', '.join(f'{f.name}: {shape_of_type(f.dataType)}' for f in fields)}>"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{shape_of_type(kind.elementType)}>"
    return "_"


def _role(name: Column) -> Column:
    known = name
    for other, role in ROLE_NAMES.items():
        known = F.when(name == other, role).otherwise(known)
    return known


def _turns_of(layout: Layout, record: Column) -> Column:
    v = F.try_parse_json(record)
    if layout.listed:
        path, role, text = layout.listed
        items = F.try_variant_get(v, f"$.{path}", f"array<struct<`{role}`:string,`{text}`:string>>")
        return F.transform(items, lambda t: F.struct(_role(t[role]).alias("role"), F.coalesce(t[text], F.lit("")).alias("text")))
    single = [F.struct(F.lit(role).alias("role"), F.coalesce(F.try_variant_get(v, f"$.{path}", "string"), F.lit("")).alias("text")) for role, path in layout.turns]
    return F.array(*single)


def _typed_turns_of(layout: Layout, record: Column) -> Column:
    def at(path: str) -> Column:
        out = record
        for part in path.split("."):
            out = out[part]
        return out

    if layout.listed:
        path, role, text = layout.listed
        return F.transform(at(path), lambda t: F.struct(_role(t[role]).alias("role"), F.coalesce(t[text].cast("string"), F.lit("")).alias("text")))
    return F.array(*[F.struct(F.lit(role).alias("role"), F.coalesce(at(path).cast("string"), F.lit("")).alias("text")) for role, path in layout.turns])


def typed_turns(df: DataFrame, records: list[str], layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Add ``layout``, ``turns`` (role, text) and ``reason`` from typed record columns, one for each layout a row may have.

    A column's type gives its fingerprint, and that its mapping; a row's record is the first of the columns that is not null.  No text is
    parsed, so texts may have any length that a value can have.  A record in a column whose fingerprint is not declared
    has null turns and the reason ``undeclared_layout``, a row without a record ``no_record``.
    """
    declared = {_shape_of(known.paths): known for known in layouts}
    layout, turns, reason = F.lit(None).cast("string"), F.lit(None).cast(TURNS), F.lit("no_record")
    for name in reversed(records):
        known, here = declared.get(shape_of_type(df.schema[name].dataType)), F.col(name).isNotNull()
        layout = F.when(here, F.lit(known.name if known else None).cast("string")).otherwise(layout)
        turns = F.when(here, _typed_turns_of(known, F.col(name)) if known else F.lit(None).cast(TURNS)).otherwise(turns)
        reason = F.when(here, F.lit(None if known else "undeclared_layout").cast("string")).otherwise(reason)
    return df.withColumns({"layout": layout, "turns": turns, "reason": reason})


def canonical_turns(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Add ``layout``, ``turns`` (role, text) and ``reason`` from JSON texts.

    A record whose fingerprint is not declared has null for the first two and the reason ``undeclared_layout``; one that is null
    ``no_record``; one that cannot be read as JSON ``unreadable``: malformed, or with a text beyond the JSON parser's limit of 20 million
    characters or Spark's size limit of a variant.  Typed columns (``typed_turns``) have no such limit.
    An empty list of turns has no member to show its fields; it is read as no turns of any list layout.
    """
    name = free_name(records, "print")
    named = records.withColumn(name, fingerprint(F.col(record)))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for known in reversed(layouts):
        hit = F.col(name) == F.xxhash64(F.lit(_shape_of(known.paths)))
        if known.listed:
            hit = hit | (F.col(name) == F.xxhash64(F.lit(f"OBJECT<{known.listed[0]}: ARRAY<_>>")))
        layout = F.when(hit, known.name).otherwise(layout)
        turns = F.when(hit, _turns_of(known, F.col(record))).otherwise(turns)
    reason = F.when(F.col(record).isNull(), "no_record").when(shape(F.col(record)).isNull(), "unreadable").when(layout.isNull(), "undeclared_layout")
    return named.withColumns({"reason": reason, "layout": layout, "turns": turns}).drop(name)


# The control strings of the template.  "␛" begins an escape; it is rare in text.
ESCAPE = "␛"
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]")


def escaped(text: Column) -> Column:
    """No control string is left in the result, and ``unescaped`` gives the text back."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0"))
    for i, control in enumerate(CONTROLS, 1):
        text = F.replace(text, F.lit(control), F.lit(f"{ESCAPE}{i}"))
    return text


def unescaped(text: Column) -> Column:
    for i, control in enumerate(CONTROLS, 1):
        text = F.replace(text, F.lit(f"{ESCAPE}{i}"), F.lit(control))
    return F.replace(text, F.lit(ESCAPE + "0"), F.lit(ESCAPE))


# Opening and closing marks of a turn; any role but these three stands in the text between ROLE marks.
_MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
NULL_ROLE = ESCAPE + "9"


def _opening(role: Column) -> Column:
    out = F.concat(F.lit("[ROLE]"), F.coalesce(escaped(role), F.lit(NULL_ROLE)), F.lit("[/ROLE]<s>"))
    for name, (mark, _) in _MARKS.items():
        out = F.when(role == name, mark).otherwise(out)
    return out


def _closing(role: Column) -> Column:
    out = F.lit("</s>")
    for name, (_, mark) in _MARKS.items():
        out = F.when(role == name, mark).otherwise(out)
    return out


def format_turns(df: DataFrame, key: str) -> DataFrame:
    """(key, formatted, loss_mask) of every row of ``df`` (key, turns): the marked text, and the spans to learn from.

    A span is (begin, length) in code points of the formatted text and covers one assistant text
    without its marks.  Where spans begin is a running sum over the turns as rows.  A record without turns gives an empty text, one
    whose turns are null (its layout is not known) null for both.  Rows of equal keys, null ones too, are records of their own.
    Null texts are empty; texts of any length are kept whole.  No rows give no rows.
    """
    numbered = settle(df.select(F.col(key).alias("key"), "turns").withColumn("row", F.monotonically_increasing_id()), "turns")
    rows = numbered.select("row", "key", F.col("turns").isNotNull().alias("known"), F.posexplode_outer("turns").alias("turn_no", "turn"))
    rows = rows.select("row", "key", "known", "turn_no", F.col("turn.role").alias("role"), escaped(F.coalesce("turn.text", F.lit(""))).alias("body"))
    rows = rows.withColumn("opening", _opening(F.col("role"))).withColumn("closing", _closing(F.col("role")))
    rows = rows.withColumn("piece", F.when(F.col("turn_no").isNull(), "").otherwise(F.concat("opening", "body", "closing")))
    upto = Window.partitionBy("row").orderBy("turn_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("begin", F.sum(F.length("piece")).over(upto) - F.length("piece") + F.length("opening"))
    span = F.when(F.col("role") == "assistant", F.struct(F.col("turn_no"), F.col("begin").cast("long").alias("begin"), F.length("body").cast("long").alias("length")))
    done = rows.groupBy("row").agg(
        F.first("key").alias("key"), F.first("known").alias("known"),
        F.array_sort(F.collect_list(F.struct("turn_no", "piece"))).alias("pieces"), F.array_sort(F.collect_list(span)).alias("spans"))
    return done.select(
        F.col("key").alias(key), F.when(F.col("known"), F.array_join(F.transform("pieces", lambda p: p["piece"]), "")).alias("formatted"),
        F.when(F.col("known"), F.transform("spans", lambda s: F.struct(s["begin"].alias("begin"), s["length"].alias("length")))).alias("loss_mask"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns back from a formatted text.  Texts hold no control strings, so an opening mark always opens a turn."""
    pieces = F.filter(F.split(formatted, r"(?=\[SYS\]|\[INST\]|(?<!\[/ROLE\])<s>|\[ROLE\])"), lambda p: p != "")

    def turn(piece: Column) -> Column:
        role = F.regexp_extract(piece, r"(?s)^\[ROLE\](.*?)\[/ROLE\]", 1)
        other = F.when(role != NULL_ROLE, unescaped(role))
        out = F.struct(other.alias("role"), _between(piece, F.length(role) + len("[ROLE][/ROLE]<s>"), len("</s>")).alias("text"))
        for name, (first, last) in _MARKS.items():
            found = F.struct(F.lit(name).alias("role"), _between(piece, F.lit(len(first)), len(last)).alias("text"))
            out = F.when(piece.startswith(first), found).otherwise(out)
        return out

    return F.transform(pieces, turn)


def _between(piece: Column, head: Column, tail: int) -> Column:
    return unescaped(F.substring(piece, head + 1, F.length(piece) - head - tail))


def masked_texts(formatted: Column, mask: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(mask, lambda s: unescaped(F.substring(formatted, (s["begin"] + 1).cast("int"), s["length"].cast("int"))))
