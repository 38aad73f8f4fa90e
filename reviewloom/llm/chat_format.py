"""Chat formatting: layouts recognised by fingerprints of their field paths, turns marked by a template.

DataFrame functions only.

* **Layouts** are declared as data (:data:`LAYOUTS`): the nested field paths that make the layout, and
  what they map to. Paths are hashed; a record's fingerprint is the hash of the sorted hashes of those
  paths that any layout knows, and the layout with the same fingerprint is selected. Where a record
  mixes fields of several layouts, the first layout in order of preference all of whose hashes it has
  is taken. Frames have one fingerprint, of their schema; JSON records one each, of their own paths.
* **Canonical turns** are ``role, text`` in order, with aliases of roles and keys brought to one name.
* **Templates** open each turn, separate role and text and close the turn. Control strings inside
  texts and roles get one more backslash behind their first character, and lose one on reading back.
  The formatted text is kept as segments that change where the loss mask does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from reviewloom.llm.common import table

# Names under which roles go in known layouts.
ROLE_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "model": "assistant", "bot": "assistant", "chatbot": "assistant"}
TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Layout:
    """``fields``: (role, path) of texts in turn order; or a ``list`` with paths of role and text inside it;
    or, with ``order``, one row per turn, gathered by the key."""

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    list: str | None = None
    role: str | None = None
    text: str | None = None
    order: str | None = None

    def paths(self) -> tuple[str, ...]:
        inner = tuple(f"{self.list}[].{p}" for p in (self.role, self.text)) if self.list else tuple(p for p in (self.role, self.text, self.order) if p)
        return tuple(sorted({*inner, *(p for _, p in self.fields)}))


#: In order of preference for records that have the fields of several.
LAYOUTS = (
    Layout("messages", list="messages", role="role", text="content"),
    Layout("message_texts", list="messages", role="role", text="text"),
    Layout("conversations", list="conversations", role="from", text="value"),
    Layout("dialogue", list="dialogue", role="speaker", text="utterance"),
    Layout("instruction_input", fields=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("instruction_with_input", fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("instruction_output", fields=(("user", "instruction"), ("assistant", "output"))),
    Layout("instruction_response", fields=(("user", "instruction"), ("assistant", "response"))),
    Layout("system_prompt_response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("prompt_response", fields=(("user", "prompt"), ("assistant", "response"))),
    Layout("prompt_completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout("question_answer", fields=(("user", "question"), ("assistant", "answer"))),
    Layout("nested_data", fields=(("user", "data.prompt"), ("assistant", "data.response"))),
    Layout("rows_by_turn", role="role", text="text", order="turn"),
)


def path_hash(path: str | Column) -> Column:
    return F.xxhash64(F.lit(path) if isinstance(path, str) else path)


def fingerprint(paths: Column) -> Column:
    """One hash of an array of field paths, whatever their order."""
    return F.xxhash64(F.array_sort(F.transform(F.array_distinct(paths), path_hash)))


def schema_paths(kind: DataType, at: str = "") -> list[str]:
    """Nested field paths of a schema's leaves: ``a.b`` inside structs, ``a[].b`` inside lists of them."""
    if isinstance(kind, StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return [at]


def json_paths(record: str | Column) -> Column:
    """Nested field paths of a JSON record, as deep as the layouts go: fields, fields of objects in them,
    and fields of the objects of a list, over all of its elements."""
    top = F.try_variant_get(F.try_parse_json(record), "$", "map<string,variant>")

    def inner(e: Column) -> Column:
        keys = F.map_keys(F.try_variant_get(e.value, "$", "map<string,variant>"))
        items = F.try_variant_get(e.value, "$", "array<variant>")
        of_items = F.flatten(F.transform(items, lambda v: F.coalesce(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")), F.array().cast("array<string>"))))
        own = F.transform(keys, lambda k: F.concat(e.key, F.lit("."), k))
        return F.coalesce(own, F.transform(of_items, lambda k: F.concat(e.key, F.lit("[]."), k)), F.array(e.key))

    return F.coalesce(F.array_distinct(F.flatten(F.transform(F.map_entries(top), inner))), F.array().cast("array<string>"))


def layout_name(paths: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Name of the layout that an array of field paths selects; NULL if there is none."""
    known = sorted({p for layout in layouts for p in layout.paths()})
    vocabulary = F.array(*[F.lit(p) for p in known])
    own = F.array_intersect(paths, vocabulary)
    print_ = fingerprint(own)
    hashes = F.transform(own, path_hash)
    chosen = [F.when(print_ == fingerprint(F.array(*[F.lit(p) for p in x.paths()])), F.lit(x.name)) for x in layouts]
    covered = [
        F.when(F.size(F.array_except(F.array(*[path_hash(p) for p in x.paths()]), hashes)) == 0, F.lit(x.name)) for x in layouts
    ]
    return F.coalesce(*chosen, *covered)


def frame_layout(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> Layout:
    """The layout that the schema of a frame selects; an error if there is none."""
    paths = schema_paths(df.schema)
    named = df.sparkSession.range(1).select(layout_name(F.array(*[F.lit(p) for p in paths]), layouts)).first()[0]
    if named is None:
        raise ValueError(f"no layout has the field paths {paths}")
    return next(x for x in layouts if x.name == named)


def canonical_role(role: Column) -> Column:
    """Roles by the names of :data:`ROLE_NAMES`, others as they stand; NULL is the empty role."""
    names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    return F.coalesce(names[F.lower(role)], role, F.lit(""))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(canonical_role(role).alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _given(fields: tuple[tuple[str, str], ...], value) -> Column:
    """Turns of the fields that are there; neighbours of one role are one turn, joined by an empty line."""
    parts: list[tuple[str, list[Column]]] = []
    for role, path in fields:
        if parts and parts[-1][0] == role:
            parts[-1][1].append(F.when(value(path) != "", value(path)))
        else:
            parts.append((role, [value(path)]))
    turns = [_turn(F.lit(role), F.concat_ws("\n\n", *texts) if len(texts) > 1 else texts[0]) for role, texts in parts]
    there = [F.coalesce(*texts).isNotNull() if role == "system" else F.lit(True) for role, texts in parts]
    return F.filter(F.array(*[F.when(t, turn) for t, turn in zip(there, turns)]), lambda t: t.isNotNull()).cast(TURNS)


def canonical_turns(df: DataFrame, key: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``key, turns`` of a frame in any declared layout; other columns are not read.

    Layouts of whole records are narrow, one conversation a row. Rows by turn are gathered by the key
    in one shuffle, ordered by turn, then role and text (NULLs first), repeated rows as often as they
    come, rows of the NULL key as one conversation: a conversation is one row of the result, so it is
    the unit that has to fit into a task. NULL texts are empty, a missing list has no turns, a missing
    system text no turn. An empty table gives an empty result.
    """
    layout = frame_layout(df, layouts)
    if layout.order:
        rows = df.select(F.col(key), F.struct(F.col(layout.order).alias("o"), F.col(layout.role).alias("r"), F.col(layout.text).alias("t")).alias("row"))
        ordered = F.array_sort(F.collect_list("row"), lambda a, b: _compared(a, b))
        return rows.groupBy(key).agg(ordered.alias("rows")).select(key, F.transform("rows", lambda x: _turn(x["r"], x["t"])).cast(TURNS).alias("turns"))
    if layout.list:
        turns = F.transform(F.col(layout.list), lambda m: _turn(m[layout.role], m[layout.text]))
        return df.select(key, F.coalesce(turns, F.array()).cast(TURNS).alias("turns"))
    return df.select(key, _given(layout.fields, lambda p: F.col(p).cast("string")).alias("turns"))


def _compared(a: Column, b: Column) -> Column:
    """Order of two structs of ``o, r, t``, NULLs first."""
    out = F.lit(0)
    for name in ("t", "r", "o"):
        x, y = a[name], b[name]
        out = F.when(x.isNull() & y.isNull(), out).when(x.isNull(), -1).when(y.isNull(), 1).when(x < y, -1).when(x > y, 1).otherwise(out)
    return out


def canonical_records(df: DataFrame, record: str, key: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``key, layout, turns`` of JSON records that may each have another layout of whole records.

    A record whose fingerprint selects none, is no JSON object, or is NULL has a NULL layout and no
    turns: it is kept, so that callers can see it. Narrow.
    """
    whole = tuple(x for x in layouts if not x.order)
    read = df.select(key, F.try_parse_json(F.col(record)).alias("_record"), layout_name(json_paths(F.col(record)), whole).alias("layout"))

    def value(path: str) -> Column:
        return F.try_variant_get("_record", f"$.{path}", "string")

    chosen = F.lit(None).cast(TURNS)
    for x in whole:
        if x.list:
            items = F.try_variant_get("_record", f"$.{x.list}", "array<variant>")
            role, text = f"$.{x.role}", f"$.{x.text}"
            turns = F.transform(items, lambda m: _turn(F.try_variant_get(m, role, "string"), F.try_variant_get(m, text, "string")))
        else:
            turns = _given(x.fields, value)
        chosen = F.when(F.col("layout") == x.name, turns.cast(TURNS)).otherwise(chosen)
    return read.select(key, "layout", F.coalesce(chosen, F.array().cast(TURNS)).alias("turns"))


@dataclass(frozen=True)
class Template:
    """Marks of a turn, and further control strings that texts must not bring in. The first character
    of a control string occurs in none at another place."""

    opens: str = "<|im_start|>"
    separates: str = "<|im_sep|>"
    closes: str = "<|im_end|>"
    guarded: tuple[str, ...] = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")

    def __post_init__(self):
        firsts = {c[0] for c in self._control()}
        if "\\" in firsts or any(firsts & set(c[1:]) for c in self._control()) or any(c[1:2] == "\\" for c in self._control()):
            raise ValueError("a control string's first character must not occur inside one, and no backslash there")

    def _control(self) -> tuple[str, ...]:
        return (self.opens, self.separates, self.closes, *self.guarded)

    def _pattern(self, slashes: str) -> str:
        firsts = "".join(f"\\{c}" if not c.isalnum() else c for c in sorted({c[0] for c in self._control()}))
        rests = "|".join(_quoted(c[1:]) for c in self._control())
        return f"([{firsts}]){slashes}({rests})"

    def _with_first(self, text: Column, changed: Column) -> Column:
        """Only texts that have such a character go through the pattern."""
        has = F.lit(False)
        for c in sorted({c[0] for c in self._control()}):
            has = has | text.contains(c)
        return F.when(has, changed).otherwise(text)

    def escaped(self, text: Column) -> Column:
        return self._with_first(text, F.regexp_replace(text, self._pattern(r"(\\*+)"), r"$1\\$2$3"))

    def unescaped(self, text: Column) -> Column:
        return self._with_first(text, F.regexp_replace(text, self._pattern(r"\\(\\*+)"), r"$1$2$3"))

    def segments(self, turns: str | Column) -> Column:
        """``array<struct<text, loss>>``: the formatted conversation, cut where the loss mask changes.
        The loss falls on the texts of the assistant."""

        def of(t: Column) -> Column:
            before = F.concat(F.lit(self.opens), self.escaped(t["role"]), F.lit(self.separates))
            text = self.escaped(t["text"])
            return F.array(
                F.struct(before.alias("text"), F.lit(False).alias("loss")),
                F.struct(text.alias("text"), (t["role"] == "assistant").alias("loss")),
                F.struct(F.lit(self.closes).alias("text"), F.lit(False).alias("loss")),
            )

        return F.flatten(F.transform(turns, of))

    def read_turns(self, formatted: Column) -> Column:
        """Canonical turns of a formatted conversation."""
        marked = F.split(formatted, _quoted(self.closes))  # with an empty rest behind the last turn

        def of(t: Column) -> Column:
            parts = F.split(t, _quoted(self.separates), 2)
            return F.struct(self.unescaped(F.substr(parts[0], F.lit(len(self.opens) + 1))).alias("role"), self.unescaped(parts[1]).alias("text"))

        return F.transform(F.slice(marked, F.lit(1), F.size(marked) - 1), of)

    def read_loss(self, segments: str | Column) -> Column:
        """The text under the loss mask, unescaped."""
        return F.array_join(F.transform(F.filter(segments, lambda s: s.loss), lambda s: self.unescaped(s.text)), "")


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c in "_ " else f"\\{c}" for c in text)


def format_chats(turns: DataFrame, template: Template = Template(), key: str = "conv_id") -> DataFrame:
    """``key, segments, formatted`` of canonical turns. Narrow; a conversation without turns is empty.

    Very long texts are handled in one pass each; repeated keys stay rows of their own.
    """
    made = turns.select(key, template.segments("turns").alias("segments"))
    return made.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s.text), ""))


def op13_chat_format(spark, sf_dir: str) -> DataFrame:
    """All conversations, and one in another layout whose texts hold control strings, read back from the output."""
    template = Template()
    text = F.lit("</s>[INST] ok [/INST]")
    hostile = spark.range(1).select(F.lit(-1).cast("bigint").alias("conv_id"), text.alias("prompt"), text.alias("response"))
    sources = [table(spark, sf_dir, "conversations"), hostile]
    turns = [canonical_turns(s).select(F.col("conv_id").cast("bigint").alias("conv_id"), "turns") for s in sources]
    made = format_chats(turns[0].unionByName(turns[1]), template)
    read = made.select(
        "conv_id", template.read_turns(F.col("formatted")).alias("turns"), template.read_loss("segments").alias("loss"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP13_SQL = r"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
    made AS (
        SELECT *, regexp_replace(text, '([<\[])(\\*)(\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\])', '\1\\\2\3', 'g') AS escaped FROM rows)
    SELECT conv_id, count(*)::BIGINT AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(length('<|im_start|>' || role || '<|im_sep|>' || escaped || '<|im_end|>'))::BIGINT AS formatted_chars
    FROM made GROUP BY conv_id
"""
