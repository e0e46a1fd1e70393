"""Chat formatting: schema fingerprints select declarative mappings to canonical turns.

Records come in many layouts: prompt and completion, instruction with input and output,
lists of messages, one row a turn. The nested field paths of a record (``messages[].role``)
that any layout names are sorted and hashed; this fingerprint selects the layout, a
declaration of where roles and texts lie (``LAYOUTS``; a field that a layout marks optional
may be absent, so a layout has several fingerprints). A typed table is fingerprinted once, by its
schema, and mapped by Spark expressions (``table_turns``); a column of JSON texts is
fingerprinted record by record (``json_turns``). A record whose fingerprint is unknown is
returned with a null layout and without turns, never dropped.

The template writes ``<turn role>``, a line break, the text, ``</turn>`` and a line break. In
roles and texts a backslash, ``<`` and ``>`` get a backslash before them, so whatever control strings a
text holds, no unescaped ``<`` is in it, and reading back gives the text again. The loss mask
is the spans of the escaped texts of the roles that are learned from (assistant).

Turns are sorted by conversation and turn number over range partitions, so a conversation
of any length is spread over tasks; each joins its turns to parts of up to ``PART``
characters (or one longer turn). ``read_back`` streams the sorted parts of a conversation through its
digests, so no task holds a conversation whole.

Defined cases: null texts and roles are empty; a null conversation id is a conversation; null
turn numbers come first; turns with equal numbers are ordered by role, then by a hash of
the text, and equal turns all stay; an empty table gives no rows; further columns, as long as
no layout names them, change nothing (an empty list has no fields); text that isn't a JSON object has a null layout.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catloss.llm.common import shuffle_width

PART = 1 << 20
LEARNED = ("assistant",)
TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns.

    ``turns`` lists (role, fields): one turn a role, of the non-empty fields' texts joined by
    a blank line. ``each`` names an array of structs instead, whose fields ``role`` and ``text``
    make a turn each; or, with ``each`` empty, the row itself is the turn number ``order`` of
    conversation ``key``. ``roles`` renames roles.
    """

    name: str
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""
    key: str = ""
    order: str = ""
    optional: tuple[str, ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def paths(self) -> frozenset[str]:
        if self.turns:
            return frozenset(f for _, fields in self.turns for f in fields)
        if self.each:
            return frozenset(f"{self.each}[].{f}" for f in (self.role, self.text)) | frozenset(self.optional)
        return frozenset((self.key, self.order, self.role, self.text))


SPOKEN = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = (
    Layout("turn_rows", key="conv_id", order="turn", role="role", text="text"),
    Layout("messages", each="messages", role="role", text="content", roles=SPOKEN),
    Layout("conversations", each="conversations", role="from", text="value", roles=SPOKEN),
    Layout("dialog", each="dialog", role="speaker", text="utterance", roles=SPOKEN),
    Layout("instruction", (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))), optional=("system", "input")),
    Layout("context", (("user", ("instruction", "context")), ("assistant", ("response",))), optional=("context",)),
    Layout("completion", (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))), optional=("system",)),
    Layout("response", (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), optional=("system",)),
    Layout("question", (("user", ("context", "question")), ("assistant", ("answer",))), optional=("context",)),
    Layout("nested_prompt", (("user", ("prompt.text",)), ("assistant", ("response.text",)))),
)


def fingerprint(paths: Iterable[str]) -> int:
    return xxhash.xxh64_intdigest("\n".join(sorted(paths)))


#: Paths that some layout names; others have no part in a fingerprint.
NAMED = frozenset().union(*(x.paths() for x in LAYOUTS))
BY_FINGERPRINT = {
    fingerprint(layout.paths().difference(absent)): layout
    for layout in LAYOUTS for n in range(len(layout.optional) + 1) for absent in itertools.combinations(layout.optional, n)
}


def schema_paths(kind: T.DataType, prefix: str = "") -> Iterator[str]:
    """Nested field paths of a Spark type; ``[]`` stands for the elements of an array."""
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from schema_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)
    elif isinstance(kind, T.ArrayType):
        yield from schema_paths(kind.elementType, prefix + "[]")
    else:
        yield prefix


def value_paths(value: object, prefix: str = "") -> Iterator[str]:
    """Nested field paths of a parsed JSON value."""
    if isinstance(value, dict) and value:
        for k, v in value.items():
            yield from value_paths(v, f"{prefix}.{k}" if prefix else k)
    elif isinstance(value, list) and value:
        for v in value:
            yield from value_paths(v, prefix + "[]")
    else:
        yield prefix


def select_layout(paths: Iterable[str]) -> Layout | None:
    return BY_FINGERPRINT.get(fingerprint(NAMED.intersection(paths)))


def _field(path: str) -> Column:
    out = F.col(f"`{path.split('.')[0]}`")
    for name in path.split(".")[1:]:
        out = out.getField(name)
    return out


def _renamed(role: Column, roles: dict[str, str]) -> Column:
    out = F.coalesce(role.cast("string"), F.lit(""))
    if roles:
        names = F.create_map(*(F.lit(x) for pair in roles.items() for x in pair))
        out = F.coalesce(names[out], out)
    return out


def table_turns(rows: DataFrame, key: str = "id") -> DataFrame:
    """Rows (key, turn, role, text) of a typed table whose schema's fingerprint is known; ValueError else."""
    layout = select_layout(schema_paths(rows.schema))
    if layout is None:
        raise ValueError(f"no layout has the field paths {sorted(NAMED.intersection(schema_paths(rows.schema)))}")
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    if layout.key:
        return rows.select(
            _field(layout.key).alias("key"), _field(layout.order).cast("long").alias("turn"),
            _renamed(_field(layout.role), layout.roles).alias("role"), text(_field(layout.text)).alias("text"))
    if layout.each:
        turn = lambda x: F.struct(_renamed(x[layout.role], layout.roles).alias("role"), text(x[layout.text]).alias("text"))
        turns = F.transform(F.coalesce(_field(layout.each), F.array().cast(rows.schema[layout.each].dataType)), turn)
    else:
        here = set(schema_paths(rows.schema))
        made = []
        for role, fields in layout.turns:
            values = [F.nullif(text(_field(f)), F.lit("")) for f in fields if f in here]
            if values:
                made.append(F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *values).alias("text")))
        # an optional turn without text is none
        always = [role for role, fields in layout.turns if not set(fields) <= set(layout.optional)]
        turns = F.filter(F.array(*made), lambda t: t["role"].isin(always) | (t["text"] != ""))
    return rows.select(_field(key).alias("key"), F.posexplode(turns).alias("turn", "t")).select(
        "key", F.col("turn").cast("long").alias("turn"), "t.role", "t.text")


def _string(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def record_turns(record: object, layout: Layout) -> list[dict[str, str]]:
    """Canonical turns of a parsed record."""
    if layout.turns:
        def at(path):
            value = record
            for name in path.split("."):
                value = value.get(name) if isinstance(value, dict) else None
            return _string(value)

        made = [(role, "\n\n".join(filter(None, map(at, fields))), set(fields) <= set(layout.optional)) for role, fields in layout.turns]
        return [{"role": r, "text": t} for r, t, optional in made if t or not optional]
    rows = record[layout.each] if layout.each else [record]
    roles = [(_string(r.get(layout.role)), _string(r.get(layout.text))) for r in rows]
    return [{"role": layout.roles.get(r, r), "text": t} for r, t in roles]


def json_turns(rows: DataFrame, key: str, column: str) -> DataFrame:
    """Rows (key, fingerprint, layout, turns) for a column of JSON records in any layout."""
    kind = rows.schema[key].dataType.simpleString()

    def convert(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, names, turns = [], [], []
            for data in batch.column("record").to_pylist():
                try:
                    record = json.loads(data or "null")
                except ValueError:
                    record = None
                named = NAMED.intersection(value_paths(record)) if isinstance(record, dict) else frozenset()
                prints.append(f"{fingerprint(named):016x}")
                layout = BY_FINGERPRINT.get(fingerprint(named))
                names.append(layout and layout.name)
                turns.append(record_turns(record, layout) if layout else [])
            kind_ = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(prints, pa.string()), pa.array(names, pa.string()), pa.array(turns, kind_)], ["key", "fingerprint", "layout", "turns"])

    return rows.select(F.col(key).alias("key"), F.col(column).alias("record")).mapInArrow(
        convert, f"key {kind}, fingerprint string, layout string, turns array<struct<role: string, text: string>>")


def escape(text: Column) -> Column:
    for c in ("\\", "<", ">"):  # the backslash first
        text = F.replace(text, F.lit(c), F.lit("\\" + c))
    return text


def format_turns(turns: DataFrame, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """Rows (key, first, part, n_turns, text, loss) for rows (key, turn, role, text).

    A conversation's parts, in the order of (first, part), hold its formatted turns; loss is
    an array of the part's spans (start, end), in characters, that are learned from.
    """
    kind = turns.schema["key"].dataType.simpleString()
    head = F.concat(F.lit("<turn "), escape("role"), F.lit(">\n"))
    body = escape("text")
    pieces = turns.select(
        "key", "turn", "role", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"), F.length(head).alias("start"),
        F.length(body).alias("size"), F.col("role").isin(*learned).alias("learned"), F.concat(head, body, F.lit("</turn>\n")).alias("piece"))
    order = ["key", "turn", "role", "tie", "row"]
    pieces = pieces.repartitionByRange(shuffle_width(turns.sparkSession), *order).sortWithinPartitions(*order)

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "first", "part", "n_turns", "text", "loss")
        kinds = (arrow, first, pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        done: list[tuple] = []
        key, begin, texts, size, loss = None, None, [], 0, []
        seq = 0

        def close():
            done.append((key, begin, seq, len(texts), "".join(texts), loss))

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*done), kinds)], list(names))
            done.clear()
            return out

        held = 0
        for batch in batches:
            for k, turn, role, tie, start, length, learn, piece in zip(*(batch.column(c).to_pylist() for c in ("key", "turn", "role", "tie", "start", "size", "learned", "piece"))):
                if texts and (k != key or size + len(piece) > PART):
                    close()
                    held += size
                    texts, size, loss, seq = [], 0, [], seq + 1
                    if held >= PART:
                        yield flush()
                        held = 0
                if not texts:
                    key, begin = k, {"turn": turn, "role": role, "tie": tie}
                if learn:
                    loss.append({"start": size + start, "end": size + start + length})
                texts.append(piece)
                size += len(piece)
        if texts:
            close()
        if done:
            yield flush()

    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(turns.schema["key"].dataType)
    first = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("tie", pa.int64())])
    return pieces.drop("row").mapInArrow(
        join, f"key {kind}, first struct<turn: long, role: string, tie: long>, part long, n_turns long, text string, loss array<struct<start: long, end: long>>")


#: A formatted turn: role and text as escaped.
TURN = re.compile(r"<turn ([^\\<>]*+(?:\\.[^\\<>]*+)*+)>\n([^\\<>]*+(?:\\.[^\\<>]*+)*+)</turn>\n", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def parse(text: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted part; ValueError if it is anything else than turns."""
    out, at = [], 0
    while at < len(text):
        m = TURN.match(text, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def read_back(parts: DataFrame) -> DataFrame:
    """Per conversation of ``format_turns``: what its formatted text and loss mask say when read again.

    Rows (key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars). The parts of a
    conversation go through one task's digests in order, one at a time.
    """
    kind = parts.schema["key"].dataType.simpleString()

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, open_, rows = None, False, []
        names = ("key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        kinds = (arrow, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        for batch in batches:
            for i in range(batch.num_rows):
                k, text, loss = (batch.column(c)[i].as_py() for c in ("key", "text", "loss"))
                if not open_ or k != key:
                    if open_:
                        rows.append((key, n, turns.hexdigest(), learned, lost.hexdigest(), chars))
                    key, open_, n, learned, chars, turns, lost = k, True, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                for role, said in parse(text):
                    n += 1
                    turns.update(f"{role}\n{said}\n".encode("utf-8", "replace"))
                for span in loss:
                    said = unescape(text[span["start"] : span["end"]])
                    learned += len(said)
                    lost.update(said.encode("utf-8", "replace"))
                chars += len(text)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], list(names))
                rows = []
        if open_:
            rows = [(key, n, turns.hexdigest(), learned, lost.hexdigest(), chars)]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], list(names))

    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(parts.schema["key"].dataType)
    ordered = parts.repartition(shuffle_width(parts.sparkSession), "key").sortWithinPartitions("key", "first", "part")
    return ordered.select("key", "text", "loss").mapInArrow(
        digest, f"key {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
