"""Chat formatting through schema fingerprints.

Records are JSON of any layout.  The nested field paths of a record, read from
its variant schema, are hashed; the fingerprint selects a declarative mapping
(which layout, and the JSON paths of its parts) that turns the record into
canonical turns ``array<struct<role, text>>``.  A record whose fingerprint no
mapping claims is returned with null turns and its fingerprint, not dropped.

Template of a turn: ``[INST]`` role ``[/INST]`` text ``</s>``, after one
``<s>``.  Inside roles and texts a backslash is doubled and every control
string gets a backslash after its first character, so that no control string
remains; both are undone by dropping the backslash before any character.

Defined results: null texts and roles are empty; a null or empty list of turns
formats as ``<s>`` alone; turns are ordered by turn number (nulls first), then
role, then text, so ties and repeated rows have one order; very long texts are
only strings; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]"]
TURNS = "array<struct<role:string,text:string>>"
LOSS_ROLE = "assistant"
VARIANT_BYTES = 100_000_000  # Spark's variants hold 128 MB; beyond this, records are parsed by the fields of the mappings
_LONG = {"maxStringLen": str(2**31 - 1)}
_CHUNK = 200


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns.  ``example_schemas`` are variant schemas
    (as Spark prints them) whose fingerprints select it.

    kind ``messages``: ``path`` names an array of objects; ``role``, ``text``
    and, if given, ``order`` are fields of its objects.
    kind ``fields``: ``parts`` are (role, path) pairs, in order; absent ones
    and empty ones are left out."""

    name: str
    kind: str
    example_schemas: tuple[str, ...]
    path: str = "$"
    role: str = "role"
    text: str = "content"
    order: str | None = None
    roles: tuple[tuple[str, str], ...] = ()
    parts: tuple[tuple[str, str], ...] = ()


# The layouts that occur in public instruction data sets.
MAPPINGS = (
    Mapping("turns", "messages", (
        "OBJECT<turns: ARRAY<OBJECT<role: STRING, text: STRING, turn: BIGINT>>>",), "$.turns", "role", "text", "turn"),
    Mapping("messages", "messages", (
        "OBJECT<messages: ARRAY<OBJECT<content: STRING, role: STRING>>>",), "$.messages"),
    Mapping("share", "messages", (
        "OBJECT<conversations: ARRAY<OBJECT<from: STRING, value: STRING>>>",), "$.conversations", "from", "value",
        roles=(("human", "user"), ("gpt", "assistant"))),
    Mapping("prompt", "fields", (
        "OBJECT<completion: STRING, prompt: STRING>",), parts=(("user", "$.prompt"), ("assistant", "$.completion"))),
    Mapping("instruction", "fields", (
        "OBJECT<input: STRING, instruction: STRING, output: STRING>",
        "OBJECT<instruction: STRING, output: STRING>"),
        parts=(("system", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
    Mapping("question", "fields", (
        "OBJECT<data: OBJECT<answer: STRING, question: STRING>>",),
        parts=(("user", "$.data.question"), ("assistant", "$.data.answer"))),
)


def normal_paths(schema: Column) -> Column:
    """Variant schema with value types blurred, so a fingerprint depends on
    field paths and not on which values happen to be there (a null, say)."""
    return F.regexp_replace(schema, r": ?(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL\([0-9,]+\)|STRING|VOID|BOOLEAN|VARIANT)\b", ": V")


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a variant (null: of nothing)."""
    return F.xxhash64(normal_paths(F.schema_of_variant(record)))


def _items_type(m: Mapping) -> str:
    return f"array<struct<{f'`{m.order}`:bigint,' if m.order else ''}`{m.role}`:string,`{m.text}`:string>>"


def _messages(items: Column, m: Mapping) -> Column:
    """Canonical turns of the objects that a ``messages`` mapping names."""
    if m.order:
        items = F.array_sort(F.transform(items, lambda x: F.struct(
            x[m.order].alias("o"), F.coalesce(x[m.role], F.lit("")).alias("r"), F.coalesce(x[m.text], F.lit("")).alias("t"))))
    else:
        items = F.transform(items, lambda x: F.struct(F.coalesce(x[m.role], F.lit("")).alias("r"), F.coalesce(x[m.text], F.lit("")).alias("t")))

    def canonical(role: Column) -> Column:
        out = role
        for theirs, ours in m.roles:
            out = F.when(role == theirs, ours).otherwise(out)
        return out
    return F.transform(items, lambda x: F.struct(canonical(x["r"]).alias("role"), x["t"].alias("text")))


def _parts(m: Mapping, value) -> Column:
    parts = F.array(*(F.struct(F.lit(role).alias("role"), F.coalesce(value(path), F.lit("")).alias("text")) for role, path in m.parts))
    return F.filter(parts, lambda x: x["text"] != "")


def _fields(v: Column, m: Mapping) -> Column:
    return _parts(m, lambda path: F.variant_get(v, path, "string"))


def _long_fields(record: Column, m: Mapping) -> tuple[Column, Column]:
    """Whether a record holds all parts that every layout of a ``fields``
    mapping has (paths of one or two names), and its turns."""
    names = {path: path.removeprefix("$.").split(".") for _, path in m.parts}
    tops: dict[str, list[str]] = {}
    for n in names.values():
        tops.setdefault(n[0], []).extend(n[1:])
    schema = ", ".join(f"`{t}`: " + (f"struct<{', '.join(f'`{x}`: string' for x in inner)}>" if inner else "string") for t, inner in tops.items())
    own = F.from_json(record, f"struct<{schema}>", _LONG)

    def value(path: str) -> Column:
        out = own
        for n in names[path]:
            out = out[n]
        return out
    needed = [p for p, n in names.items() if all(f"{n[-1]}: " in s for s in m.example_schemas)]
    held = F.lit(True)
    for p in needed:
        held = held & value(p).isNotNull()
    return held, _parts(m, value)


def canonical_turns(records: DataFrame, *, record_col: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS,
                    variant_bytes: int = VARIANT_BYTES) -> DataFrame:
    """``records`` plus ``layout``, ``fingerprint`` and ``turns``.  A record is
    JSON text; text that is no JSON has a null fingerprint and null turns.  A
    record too long for a variant has no fingerprint either; the first mapping
    whose array of messages, or all of whose parts, it holds (values that are not
    null, at paths of at most two names) gives its turns."""
    spark = records.sparkSession
    rows = [(m.name, s) for m in mappings for s in m.example_schemas]
    known = {r[0]: r[1] for r in spark.createDataFrame(rows, "name string, s string")
             .select(F.xxhash64(normal_paths(F.col("s"))).alias("f"), "name").collect()}  # a few mappings
    long = F.octet_length(record_col) > variant_bytes
    v = F.when(~long, F.try_parse_json(F.col(record_col)))
    with_print = records.select(*[c for c in records.columns if c not in ("fingerprint", "layout", "turns")],
                                v.alias("_variant"), F.when(v.isNotNull(), fingerprint(v)).alias("fingerprint"))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in mappings:  # a record has one fingerprint, so the order is of no consequence
        hit = F.col("fingerprint").isin([f for f, name in known.items() if name == m.name])
        layout = F.when(hit, m.name).otherwise(layout)
        own = _messages(F.variant_get("_variant", m.path, _items_type(m)), m) if m.kind == "messages" else _fields(F.col("_variant"), m)
        turns = F.when(hit, own.cast(TURNS)).otherwise(turns)
    for m in reversed(mappings):
        name = m.path.removeprefix("$.")
        if m.kind == "messages" and m.path.count(".") == 1:
            items = F.from_json(F.col(record_col), f"struct<`{name}`:{_items_type(m)}>", _LONG)[name]
            held, own = items.isNotNull(), _messages(items, m)
        elif m.kind == "fields" and all(p.count(".") <= 2 for _, p in m.parts):
            held, own = _long_fields(F.col(record_col), m)
        else:
            continue
        turns = F.when(long & held, own.cast(TURNS)).otherwise(turns)
        layout = F.when(long & held, m.name).otherwise(layout)
    return with_print.withColumn("layout", layout).withColumn("turns", turns).drop("_variant")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(turns: Column) -> Column:
    """The training text of canonical turns."""
    return F.concat(F.lit("<s>"), F.array_join(F.transform(turns, lambda x: F.concat(
        F.lit("[INST]"), escape(x["role"]), F.lit("[/INST]"), escape(x["text"]), F.lit("</s>"))), ""))


def parse_turns(formatted: Column) -> Column:
    """Back from the training text: ``array<struct<role, text, start, end>>``;
    ``start`` and ``end`` (code points, end exclusive) are the place of the
    escaped text, which under the loss mask is that of the assistant's turns.
    Built in chunks, so that very many turns take time in proportion."""
    none = F.expr("cast(array() as array<struct<role:string,text:string,start:bigint,`end`:bigint>>)")

    def step(acc: Column, x: Column) -> Column:
        head = F.substring_index(x, "[/INST]", 1)
        text = F.substr(x, F.length(head) + 8)
        start = acc["at"] + F.length(head) + 7
        return F.struct((acc["at"] + F.length(x) + 4).alias("at"), F.concat(acc["out"], F.array(F.struct(
            unescape(F.substr(head, F.lit(7))).alias("role"), unescape(text).alias("text"),
            start.cast("long").alias("start"), (start + F.length(text)).cast("long").alias("end")))).alias("out"))

    def chunk(acc: Column, part: Column) -> Column:
        own = F.aggregate(part, F.struct(acc["at"].alias("at"), none.alias("out")), step)
        return F.struct(own["at"].alias("at"), F.concat(acc["out"], own["out"]).alias("out"))

    def located(pieces: Column) -> Column:  # a variable, so that the text is split once
        n = F.size(pieces) - 1  # nothing follows the last end mark
        chunks = F.transform(F.sequence(F.lit(0), F.floor(n / _CHUNK).cast("int")), lambda c: F.slice(
            pieces, c * _CHUNK + 1, F.greatest(F.least(F.lit(_CHUNK), n - c * _CHUNK), F.lit(0))))
        first = F.struct(F.lit(3).cast("long").alias("at"), none.alias("out"))
        return F.aggregate(chunks, first, chunk, lambda acc: acc["out"])

    return F.get(F.transform(F.array(F.split(F.substr(formatted, F.lit(4)), "</s>", -1)), located), F.lit(0))


def conversation_records(conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """Rows by turn -> one JSON record a conversation, dealt by a hash of the id
    over the layouts ``turns``, ``messages``, ``share`` and ``prompt``; where one
    of the last two would lose something, ``messages`` takes its place."""
    turns = (conversations.select(F.col(id_col).alias("conv_id"), F.struct(
                F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"),
                F.col(turn_col).cast("long").alias("turn")).alias("x"))
             .groupBy("conv_id").agg(F.collect_list("x").alias("turns")))
    ordered = F.array_sort(F.transform("turns", lambda x: F.struct(
        x["turn"].alias("o"), F.coalesce(x["role"], F.lit("")).alias("r"), F.coalesce(x["text"], F.lit("")).alias("t"))))
    turns = turns.select("conv_id", "turns", ordered.alias("ordered"), F.pmod(F.xxhash64("conv_id"), F.lit(4)).alias("deal"))
    first, second = F.get("ordered", F.lit(0)), F.get("ordered", F.lit(1))
    pair = (F.size("ordered") == 2) & (first["r"] == "user") & (second["r"] == "assistant") & (first["t"] != "") & (second["t"] != "")
    theirs = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    as_json = lambda **parts: F.to_json(F.struct(*[v.alias(k) for k, v in parts.items()]), {"ignoreNullFields": "false"})
    record = (F.when(F.col("deal") == 0, as_json(turns=F.col("turns")))
              .when((F.col("deal") == 1) & pair, as_json(prompt=first["t"], completion=second["t"]))
              .when((F.col("deal") == 2) & ~F.exists("ordered", lambda x: x["r"].isin("human", "gpt")), as_json(conversations=F.transform(
                  "ordered", lambda x: F.struct(theirs(x["r"]).alias("from"), x["t"].alias("value")))))
              .otherwise(as_json(messages=F.transform("ordered", lambda x: F.struct(x["t"].alias("content"), x["r"].alias("role"))))))
    return turns.select("conv_id", record.alias("record"))


def report(conversations: DataFrame) -> DataFrame:
    """Digest of what is read back from the formatted conversations."""
    out = canonical_turns(conversation_records(conversations)).select("conv_id", format_turns(F.col("turns")).alias("formatted"))
    back = out.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), parse_turns(F.col("formatted")).alias("turns"))
    loss = F.array_join(F.transform(F.filter("turns", lambda x: x["role"] == LOSS_ROLE), lambda x: x["text"]), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
