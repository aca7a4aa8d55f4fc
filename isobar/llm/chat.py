"""Conversations of any known layout as canonical turns, a reversible chat template and its loss mask.

A layout is known by its schema fingerprint: the hash of its nested field paths, whatever their order and types. The
fingerprint selects a declarative mapping; no code looks at field names otherwise.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: What opens and closes a turn.
TURN, END = "### ", "</turn>"


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Paths of all leaves; [] stands for an array's elements."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


def schema_fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """How a layout becomes turns.

    ``turns``: path of an array of turns with ``role`` and ``text`` fields in it; or rows of one turn each, ordered by
    ``order``; or ``parts``, (role, fields whose texts follow on blank lines). ``roles`` renames roles.
    """

    paths: tuple[str, ...]
    turns: str = ""
    role: str = ""
    text: str = ""
    order: str = ""
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)


_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}
MAPPINGS = (
    Mapping(("turn", "role", "text"), role="role", text="text", order="turn"),
    Mapping(("messages[].role", "messages[].content"), turns="messages", role="role", text="content", roles=_NAMES),
    Mapping(("conversations[].from", "conversations[].value"), turns="conversations", role="from", text="value", roles=_NAMES),
    Mapping(("prompt", "completion"), parts=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping(("prompt", "response"), parts=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping(("system", "prompt", "response"), parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping(("question", "answer"), parts=(("user", ("question",)), ("assistant", ("answer",)))),
    Mapping(("instruction", "output"), parts=(("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping(("instruction", "input", "output"), parts=(("user", ("instruction", "input")), ("assistant", ("output",)))),
)
REGISTRY = {schema_fingerprint(m.paths): m for m in MAPPINGS}


def mapping_for(paths: Iterable[str]) -> Mapping:
    """The mapping of the layout with exactly these paths; with more paths, the one of the most paths among those in it."""
    have = set(paths)
    exact = REGISTRY.get(schema_fingerprint(have))
    if exact:
        return exact
    inside = [m for m in MAPPINGS if have.issuperset(m.paths)]
    if not inside:
        raise ValueError(f"no layout has these fields: {', '.join(sorted(have))}")
    return max(inside, key=lambda m: len(m.paths))


def _named(role: Column, roles: dict[str, str]) -> Column:
    role = F.coalesce(role.cast("string"), F.lit(""))
    for old, new in roles.items():
        role = F.when(role == old, new).otherwise(role)
    return role


def canonical_turns(df: DataFrame, *, id: str = "conv_id") -> DataFrame:  # noqa: A002
    """(id, turn, role, text) rows from any known layout; the id column is no part of the layout. Null roles and texts are empty."""
    m = mapping_for(p for p in field_paths(df.schema) if p != id)
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    if m.order:
        return df.select(F.col(id), F.col(m.order).cast("long").alias("turn"), _named(F.col(m.role), m.roles).alias("role"), text(F.col(m.text)).alias("text"))
    if m.turns:
        rows = df.select(F.col(id), F.posexplode(m.turns).alias("turn", "t"))
        return rows.select(id, F.col("turn").cast("long").alias("turn"), _named(F.col("t")[m.role], m.roles).alias("role"), text(F.col("t")[m.text]).alias("text"))
    joined = lambda fields: F.array_join(F.filter(F.array(*[text(F.col(f)) for f in fields]), lambda x: x != ""), "\n\n")
    turns = F.array(*[F.struct(F.lit(role).alias("role"), joined(fields).alias("text")) for role, fields in m.parts])
    return df.select(F.col(id), F.posexplode(turns).alias("turn", "t")).select(id, F.col("turn").cast("long").alias("turn"), "t.role", "t.text")


#: One step of a schema as Spark writes it: a field's name, then what opens an object or array or a scalar's type; or a closing.
_STEP = r"(?:(?:`(?:[^`]|``)*`|\w+): )?(?:OBJECT<|ARRAY<|[A-Z]+(?:\([0-9,]+\))?)|>"


def record_paths(record: Column) -> Column:
    """Sorted distinct field paths of a JSON value, at any depth, as :func:`field_paths` has them; null for what isn't JSON.

    Whether something is a text, an object or an array comes from the JSON itself (a VARIANT's schema): text that looks like JSON
    is text. Elements of an array share their paths.
    """
    none = F.array().cast("array<string>")
    start = F.struct(F.array(F.lit("")).alias("open"), none.alias("paths"))

    def step(s: Column, t: Column) -> Column:
        name = F.regexp_extract(t, r"(?s)^(`(?:[^`]|``)*`|\w+): ", 1)
        plain = F.when(name.startswith("`"), F.replace(F.substr(name, F.lit(2), F.length(name) - 2), F.lit("``"), F.lit("`"))).otherwise(name)
        top = F.get(s["open"], F.size(s["open"]) - 1)
        at = F.when(name == "", top).when(top == "", plain).otherwise(F.concat(top, F.lit("."), plain))
        opened = F.when(t.endswith("OBJECT<"), F.array_append(s["open"], at)).when(t.endswith("ARRAY<"), F.array_append(s["open"], F.concat(at, F.lit("[]"))))
        closed = F.slice(s["open"], F.lit(1), F.size(s["open"]) - 1)
        return F.when(t == ">", F.struct(closed.alias("open"), s["paths"].alias("paths"))).when(opened.isNotNull(), F.struct(opened.alias("open"), s["paths"].alias("paths"))).otherwise(F.struct(s["open"].alias("open"), F.array_append(s["paths"], at).alias("paths")))

    steps = F.regexp_extract_all(F.schema_of_variant(record), F.lit(f"(?s){_STEP}"), F.lit(0))
    return F.aggregate(steps, start, step, lambda s: F.array_sort(F.array_distinct(s["paths"])))


def mapped_records(df: DataFrame, *, id: str = "conv_id", record: str = "record") -> DataFrame:  # noqa: A002
    """(id, value, paths, fingerprint, layout) of JSON records: the place of each record's mapping in MAPPINGS, null without one.

    The fingerprint is the hash of the record's nested field paths; one of a known layout selects its mapping. With more fields
    than a known layout's, the known one of the most paths among them is taken. Broken and null records have no paths.
    """
    rows = df.select(F.col(f"`{id}`").alias("id"), F.try_parse_json(F.col(f"`{record}`").cast("string")).alias("value"))
    rows = rows.select("id", "value", record_paths(F.col("value")).alias("paths"))
    rows = rows.withColumn("fingerprint", F.substring(F.sha2(F.array_join("paths", "\n"), 256), 1, 16))
    inside = F.lit(None).cast("int")
    for k, m in sorted(enumerate(MAPPINGS), key=lambda x: len(x[1].paths)):
        inside = F.when(F.size(F.array_except(F.array(*map(F.lit, m.paths)), F.col("paths"))) == 0, F.lit(k)).otherwise(inside)
    known = F.create_map(*[x for f, m in REGISTRY.items() for x in (F.lit(f), F.lit(MAPPINGS.index(m)))])
    return rows.withColumn("layout", F.coalesce(F.try_element_at(known, F.col("fingerprint")), inside))


def unmapped_records(df: DataFrame, *, id: str = "conv_id", record: str = "record") -> DataFrame:  # noqa: A002
    """(id, fingerprint, paths) of the records that :func:`turns_of_json` gives no turns for, each once: unknown layouts, empty
    arrays of turns, broken and null records (these without paths). With the turns' ids they account for every record."""
    return mapped_records(df, id=id, record=record).where("layout is null").select(F.col("id").alias(id), "fingerprint", "paths")


def turns_of_json(df: DataFrame, *, id: str = "conv_id", record: str = "record") -> DataFrame:  # noqa: A002
    """(id, turn, role, text) of JSON records of mixed layouts, in one pass over them.

    Each record's fingerprint selects its mapping (:func:`mapped_records`). Known layouts are a fixed list, whatever else occurs;
    records without one are what :func:`unmapped_records` lists. Roles and texts are strings, numbers and booleans as text; what
    is null or missing is empty, and an array or object where others have text is its JSON. Records of one id give their turns
    together, repeated ones again. A record is held as a VARIANT, of 16 MB at most: longer ones count as broken.
    """
    rows = mapped_records(df, id=id, record=record).where("layout is not null")
    text = lambda v, name: F.coalesce(F.try_variant_get(v, f"$.{name}", "string"), F.lit(""))
    value = F.col("value")
    turn = lambda k, role, t: F.struct(k.cast("long").alias("turn"), role.alias("role"), t.alias("text"))

    def turns(m: Mapping) -> Column:
        if m.order:
            return F.array(turn(F.try_variant_get(value, f"$.{m.order}", "bigint"), _named(text(value, m.role), m.roles), text(value, m.text)))
        if m.turns:
            return F.transform(F.try_variant_get(value, f"$.{m.turns}", "array<variant>"), lambda t, k: turn(k, _named(text(t, m.role), m.roles), text(t, m.text)))
        joined = lambda names: F.array_join(F.filter(F.array(*(text(value, n) for n in names)), lambda x: x != ""), "\n\n")
        return F.array(*(turn(F.lit(k), F.lit(role), joined(names)) for k, (role, names) in enumerate(m.parts)))

    made = F.lit(None)
    for k, m in enumerate(MAPPINGS):
        made = F.when(F.col("layout") == k, turns(m)).otherwise(made)
    return rows.select("id", F.explode(made).alias("t")).select(F.col("id").alias(id), "t.turn", "t.role", "t.text")


#: Characters of a conversation up to which it is written as JSON records; longer ones keep the layout of rows.
RECORD_CHARS = 1_000_000


def as_records(turns: DataFrame, *, id: str = "conv_id") -> tuple[DataFrame, DataFrame]:  # noqa: A002
    """Turns as (id, record) in four layouts, and as rows (id, turn, role, text) those that no record is made of.

    A user's turn and an assistant's answer are a record of prompt and response; other conversations are records of one turn
    each, of messages or of from and value, by their id. Roles that a layout would rename keep to records of one turn each.
    Conversations without an id and those of more than RECORD_CHARS characters stay rows.
    """
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    packed = turns.groupBy(id).agg(F.array_sort(F.collect_list(one)).alias("t"), F.sum(F.coalesce(F.char_length("text"), F.lit(0)) + 64).alias("n"))
    own = packed.where(F.col(id).isNull() | (F.col("n") > RECORD_CHARS)).select(id, F.explode("t").alias("t")).select(id, "t.*")
    roles = F.transform("t", lambda t: t["role"])
    human = lambda t: F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"])
    pair = F.array(F.to_json(F.struct(F.get("t", F.lit(0))["text"].alias("prompt"), F.get("t", F.lit(1))["text"].alias("response"))))
    single = F.transform("t", lambda t, k: F.to_json(F.struct(k.alias("turn"), t["role"].alias("role"), t["text"].alias("text"))))
    messages = F.array(F.to_json(F.struct(F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages"))))
    values = F.array(F.to_json(F.struct(F.transform("t", lambda t: F.struct(human(t).alias("from"), t["text"].alias("value"))).alias("conversations"))))
    renamed = F.arrays_overlap(roles, F.array(*map(F.lit, _NAMES)))
    third = F.pmod(F.xxhash64(F.col(id)), F.lit(3))
    records = F.when(renamed, single).when(roles == F.array(F.lit("user"), F.lit("assistant")), pair).when(third == 0, single).when(third == 1, messages).otherwise(values)
    made = packed.where(F.col(id).isNotNull() & (F.col("n") <= RECORD_CHARS)).select(id, F.explode(records).alias("record"))
    return made, own


def escaped(text: Column) -> Column:
    """Backslash before each backslash and number sign, and inside each end mark: neither mark can then occur in it."""
    return F.replace(F.regexp_replace(text, r"([\\#])", r"\\$1"), F.lit(END), F.lit(END.replace("/", r"\/")))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted_turns(turns: DataFrame, *, id: str = "conv_id", learn: str = "assistant") -> DataFrame:  # noqa: A002
    """(id, turn, at, part, loss_start, loss_end): each turn's piece of the formatted conversation, which is their concatenation.

    A piece is ``### role:``, a line break, the text and ``</turn>`` with a line break; it begins at place ``at`` of the
    conversation. From ``loss_start`` to ``loss_end`` (places in the conversation) is what the loss covers: the text of
    ``learn`` turns, escapes included; null for others. Turns are numbered from 0 in order of turn, then role and text, so
    repeated turn numbers have a fixed order. One task orders a conversation's turns, spilling where they are many.
    """
    order = Window.partitionBy(id).orderBy("turn", "role", "text")
    role = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\\n"))
    rows = turns.select(id, "turn", "role", "text", F.concat(F.lit(TURN), role, F.lit(":\n")).alias("_head"), escaped(F.col("text")).alias("_text"))
    rows = rows.withColumn("part", F.concat("_head", "_text", F.lit(f"{END}\n"))).withColumn("_n", F.char_length("part").cast("long"))
    at = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    placed = rows.withColumn("_turn", (F.row_number().over(order) - 1).cast("long")).withColumn("at", at)
    start = F.col("at") + F.char_length("_head")
    mine = F.col("role") == learn
    return placed.select(id, F.col("_turn").alias("turn"), "at", "part", F.when(mine, start).alias("loss_start"), F.when(mine, start + F.char_length("_text")).alias("loss_end"))


def conversations(parts: DataFrame, *, id: str = "conv_id") -> DataFrame:  # noqa: A002
    """(id, formatted, loss_mask array<struct<start, end>>) per conversation, from its pieces."""
    packed = parts.groupBy(id).agg(F.array_sort(F.collect_list(F.struct("turn", "part", F.col("loss_start").alias("start"), F.col("loss_end").alias("end")))).alias("_t"))
    mask = F.transform(F.filter("_t", lambda t: t["start"].isNotNull()), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
    return packed.select(id, F.array_join(F.transform("_t", lambda t: t["part"]), "").alias("formatted"), mask.alias("loss_mask"))


def read_back(formatted: DataFrame, *, id: str = "conv_id") -> DataFrame:  # noqa: A002
    """``formatted`` with ``turns`` (role, text) and ``learned`` (texts under the mask), parsed from the string alone."""
    pieces = F.split("formatted", f"{END}\n", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    role = lambda p: F.substring_index(p, ":\n", 1)
    turns = F.transform(pieces, lambda p: F.struct(unescaped(F.substr(role(p), F.lit(len(TURN) + 1))).alias("role"), unescaped(F.substr(p, F.char_length(role(p)) + 3)).alias("text")))
    learned = F.transform("loss_mask", lambda m: unescaped(F.substr("formatted", (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int"))))
    return formatted.select(id, "formatted", "loss_mask", turns.alias("turns"), learned.alias("learned"))


def example(spark, conv_id: int, text: str) -> DataFrame:  # noqa: ANN001
    """A user's and an assistant's turn of one text, in the row layout."""
    return spark.createDataFrame([(conv_id, 0, "user", text), (conv_id, 1, "assistant", text)], "conv_id long, turn long, role string, text string")


def as_json(turns: DataFrame, *, id: str = "conv_id") -> DataFrame:  # noqa: A002
    """(id, record): canonical turns as one JSON record in the messages layout."""
    packed = turns.groupBy(id).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    return packed.select(id, F.to_json(F.struct(F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages"))).alias("record"))


def layouts() -> str:
    """The registry, for reading: fingerprints and the paths they stand for."""
    return json.dumps({k: list(m.paths) for k, m in REGISTRY.items()}, indent=1)
