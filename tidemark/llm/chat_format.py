"""Chat records of any layout to canonical turns, and turns to a marked-up training text.

Layouts are told apart by a schema fingerprint: the hash of a record's nested field paths. Each known
fingerprint selects a declarative `Layout`, compiled into column expressions; a record of an unknown
layout is kept with null turns and its fingerprint, never dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Template control strings; inside texts each is written with a backslash before it.
MARK, END = "###", "</turn>"
#: Canonical roles and their names in the template.
NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
#: Role names of public chat layouts and the canonical role of each.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """A mapping from one record layout to turns.

    `paths` are the nested field paths it is chosen by; those in `optional` may be absent. Either
    `turns` names the list that holds the turns with `role` and `text` inside each, or `fields` gives
    (role, path, ...) entries: the texts at the paths, joined by a blank line where not empty.
    """

    name: str
    schema: str
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, ...], ...] = ()

    def fingerprints(self) -> list[str]:
        """Of every choice of the optional paths."""
        found = [set(self.paths)]
        for path in self.optional:
            found += [paths | {path} for paths in found]
        return [fingerprint_of(paths) for paths in found]


LAYOUTS = (
    Layout("messages", "messages array<struct<role string, content string>>", ("messages[].role", "messages[].content"), turns="messages", role="role", text="content"),
    Layout("conversations", "conversations array<struct<from string, value string>>", ("conversations[].from", "conversations[].value"), ("system",), turns="conversations", role="from", text="value"),
    Layout("prompt", "prompt string, response string", ("prompt", "response"), fields=(("user", "prompt"), ("assistant", "response"))),
    Layout("completion", "prompt string, completion string", ("prompt", "completion"), fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout("question", "question string, answer string", ("question", "answer"), fields=(("user", "question"), ("assistant", "answer"))),
    Layout("instruction", "system string, instruction string, input string, output string", ("instruction", "output"), ("input", "system"), fields=(("system", "system"), ("user", "instruction", "input"), ("assistant", "output"))),
    Layout("turn", "role string, text string", ("role",), ("text",), fields=(("", "text"),), role="role"),
)


def fingerprint_of(paths: set[str]) -> str:
    """The hash of a set of nested field paths, as `fingerprint` computes it from records."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def fingerprint(record: Column) -> Column:
    """The fingerprint of a JSON text: null if it is not a JSON object.

    Field paths come from `schema_of_variant`, whose fields are sorted; only names and nesting count,
    so the fingerprint does not depend on values, types, field order or the length of lists; a list of
    objects mixed with other values is one path. A field
    that is null is there; one that is missing is not.
    """
    schema = F.schema_of_variant(F.try_parse_json(record))
    # "OBJECT<a: ARRAY<OBJECT<b: STRING>>>" -> one path per leaf, built by a fold over its marks.
    marks = F.regexp_extract_all(schema, F.lit(r"(`(?:[^`]|``)*`|[^<>,: `]+(?=: )|ARRAY<|OBJECT<|>|[A-Z][A-Z0-9_]*(?:\([0-9,]*\))?)"), 1)
    start = F.struct(
        F.array().cast("array<string>").alias("at"),
        F.array().cast("array<string>").alias("paths"),
    )

    def step(state: Column, mark: Column) -> Column:
        at, paths = state["at"], state["paths"]
        held = F.size(at)
        # a frame of `at` is the path that values met now belong to
        top = F.coalesce(F.get(at, held - 1), F.lit(""))
        outer = F.slice(at, 1, F.greatest(held - 1, F.lit(0)))
        leaf = F.struct(outer.alias("at"), F.array_append(paths, top).alias("paths"))
        name = F.regexp_replace(mark, "^`|`$", "")
        return (
            F.when(mark == "ARRAY<", F.struct(F.concat(outer, F.array(F.lit(">").cast("string"), F.concat(top, F.lit("[]")))).alias("at"), paths.alias("paths")))
            .when(mark == "OBJECT<", F.struct(F.concat(outer, F.array(F.concat(F.lit("."), top))).alias("at"), paths.alias("paths")))
            .when(mark == ">", F.struct(outer.alias("at"), paths.alias("paths")))
            .when(F.startswith(top, F.lit(".")) | (held == 0), F.struct(F.array_append(at, F.ltrim(F.concat(F.substring(top, 2, 1 << 20), F.lit("."), name), F.lit("."))).alias("at"), paths.alias("paths")))
            .otherwise(leaf)
        )

    paths = F.aggregate(marks, start, step, lambda s: F.array_join(F.array_sort(F.array_distinct(s["paths"])), "\n"))
    return F.when(schema.startswith("OBJECT"), F.sha2(paths, 256))


def _canonical_role(role: Column) -> Column:
    lower = F.lower(F.trim(role))
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    named = F.coalesce(known[lower], F.when(lower.isin(*NAMES), lower), role)
    return F.coalesce(named, F.lit(""))


def _turns(layout: Layout, record: Column) -> Column:
    read = F.from_json(record, layout.schema)
    if layout.turns:
        return F.transform(
            F.coalesce(read[layout.turns], F.array().cast(f"array<struct<{layout.role}:string,{layout.text}:string>>")),
            lambda t: F.struct(
                _canonical_role(t[layout.role]).alias("role"), F.coalesce(t[layout.text], F.lit("")).alias("text")
            ),
        )
    made = []
    for role, *paths in layout.fields:
        texts = F.filter(F.array(*[F.coalesce(read[p], F.lit("")) for p in paths]), lambda t: t != "")
        turn = F.struct(
            (F.lit(role) if role else _canonical_role(read[layout.role])).alias("role"),
            F.array_join(texts, "\n\n").alias("text"),
        )
        # a role of its own makes a turn even of an empty text; a system text is one only where there is any
        made.append(F.when(F.lit(role != "system") | (turn["text"] != ""), turn))
    return F.array_compact(F.array(*made))


def canonical_turns(df: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """`df` with `fingerprint`, `layout` (a layout's name) and `turns` (array of role and text).

    A record that is null, no JSON object, or of an unknown layout has null `layout` and `turns`. Null
    texts are empty texts; unknown role names stay as they are; repeated records are rows of their
    own. All three columns are made row by row: no shuffle.
    """
    named = df.withColumn("fingerprint", fingerprint(df[record]))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for known in layouts:
        chosen = F.col("fingerprint").isin(*known.fingerprints())
        layout = F.when(chosen, F.lit(known.name)).otherwise(layout)
        turns = F.when(chosen, _turns(known, named[record])).otherwise(turns)
    return named.withColumns({"layout": layout, "turns": turns})


def escaped(text: Column) -> Column:
    """Backslashes doubled, and one put before each control string: reversible."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for control in (MARK, END):
        out = F.replace(out, F.lit(control), F.lit("\\" + control))
    return out


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def format_turns(turns: DataFrame, key: str, order: list[str], role: str = "role", text: str = "text") -> DataFrame:
    """Turns as segments of the formatted conversation, in the columns key, order, `segment`, `start`,
    `loss_start` and `loss_end` (code points from the start of the conversation).

    A conversation's formatted text is its segments joined in order. A segment is
    `### Role: text </turn>` and a line feed; the loss mask covers the text of assistant turns alone.
    Roles without a template name are written after `=`, escaped like texts. Null roles and texts are
    empty; turns that agree in `order` are taken by role and text; a null key is one conversation. A very long
    conversation is walked in order by one task, but Spark spills its rows and none holds it whole.
    """
    name = F.coalesce(
        F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])[F.coalesce(F.col(role), F.lit(""))],
        F.concat(F.lit("="), F.replace(escaped(F.col(role)), F.lit(": "), F.lit("\\: "))),
    )
    head, body = F.concat(F.lit(f"{MARK} "), name, F.lit(": ")), escaped(F.col(text))
    laid = turns.select(
        key,
        *order,
        F.concat(head, body, F.lit(f" {END}\n")).alias("segment"),
        F.length(head).alias("_head"),
        F.length(body).alias("_body"),
        (F.coalesce(F.col(role), F.lit("")) == "assistant").alias("_masked"),
    )
    steps = Window.partitionBy(key).orderBy(*[F.asc_nulls_first(c) for c in (*order, "segment")])
    before = F.sum(F.length("segment")).over(steps.rowsBetween(Window.unboundedPreceding, 0)) - F.length("segment")
    return laid.withColumn("start", before).select(
        key,
        *order,
        "segment",
        "start",
        F.when(F.col("_masked"), F.col("start") + F.col("_head")).alias("loss_start"),
        F.when(F.col("_masked"), F.col("start") + F.col("_head") + F.col("_body")).alias("loss_end"),
    )


_SEGMENT = re.compile(rf"{MARK} (?P<name>(?:[^:\\]|\\.|:(?! ))*): (?P<body>(?:[^\\]|\\.)*?) {END}\n", re.S)


def _read_role(name: str) -> str:
    return unescape(name[1:]) if name.startswith("=") else next(k for k, v in NAMES.items() if v == name)


def read_back(segments: DataFrame, key: str, order: list[str]) -> DataFrame:
    """What the formatted conversations say: one row per conversation with n_turns, turns_sha256,
    loss_chars, loss_sha256 and formatted_chars.

    Segments are parsed in order as they stream by, so a task holds one batch and three running
    values, whatever the length of a conversation.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []

        def closed() -> tuple:
            return (now[0], state["n"], state["turns"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["size"])

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in done], schema=pa.schema(list(zip(names, kinds(batch), strict=True))))

        for batch in batches:
            rows = (batch.column(c).to_pylist() for c in (key, "segment", "start", "loss_start", "loss_end"))
            for this, segment, start, first, last in zip(*rows, strict=True):
                if now is None or now[0] != this:
                    if now is not None:
                        done.append(closed())
                    now = (this,)
                    state = {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "chars": 0, "size": 0}
                at = 0
                while at < len(segment):
                    read = _SEGMENT.match(segment, at)
                    if read is None:
                        raise ValueError(f"no turn at {start + at} of conversation {this}")
                    state["turns"].update(f"{_read_role(read['name'])}\n{unescape(read['body'])}\n".encode())
                    state["n"] += 1
                    at = read.end()
                if first is not None:
                    masked = unescape(segment[first - start : last - start])
                    state["loss"].update(masked.encode())
                    state["chars"] += len(masked)
                state["size"] += len(segment)
            if done:
                yield sent()
                done = []
        if now is not None:
            done.append(closed())
            yield sent()

    def kinds(batch: pa.RecordBatch) -> list[pa.DataType]:
        return [batch.schema.field(key).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    kind = dict(segments.dtypes)[key]
    schema = f"`{key}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    steps = [F.asc_nulls_first(c) for c in (key, *order, "start")]
    return segments.repartition(key).sortWithinPartitions(*steps).mapInArrow(digests, schema)
