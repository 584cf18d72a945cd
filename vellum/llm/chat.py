"""Chat records of any known layout to canonical turns, and turns to one marked text.

A record is a variant value. The hash of its nested field paths selects a declarative mapping
(``Layout``); the mapping says where role, text and order of a turn lie. Records whose paths no
layout names come back from ``unmapped``.

Cases: null texts, roles and turn numbers are read as empty text, empty role and "before all
others". Turns of one conversation with the same number sort by role, then text; repeated rows stay
repeated turns. A null conversation id is one conversation. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<turn:bigint,role:string,text:string>>"

# --- layouts ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record lie.

    paths: all field paths, ``[]`` for the members of a list. Either ``turns`` names (role, path of
    a scalar text) pairs in order, or ``each`` names the list and ``role``/``text`` its fields; with
    ``each`` empty the record itself is one turn. ``roles`` renames roles.
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""
    turn: str = ""
    roles: dict[str, str] = field(default_factory=dict)
    id: str = "conv_id"


SHARED = {"human": "user", "gpt": "assistant", "prompter": "user", "bot": "assistant", "model": "assistant"}
LAYOUTS = (
    Layout("rows", ("conv_id", "turn", "role", "text"), role="role", text="text", turn="turn"),
    Layout(
        "messages", ("conv_id", "messages[].role", "messages[].content"), each="messages", role="role", text="content"
    ),
    Layout(
        "conversations",
        ("conv_id", "conversations[].from", "conversations[].value"),
        each="conversations",
        role="from",
        text="value",
        roles=SHARED,
    ),
    Layout("prompt_response", ("conv_id", "prompt", "response"), (("user", "prompt"), ("assistant", "response"))),
    Layout("prompt_completion", ("conv_id", "prompt", "completion"), (("user", "prompt"), ("assistant", "completion"))),
    Layout("instruction", ("conv_id", "instruction", "output"), (("user", "instruction"), ("assistant", "output"))),
    Layout(
        "instruction_input",
        ("conv_id", "instruction", "input", "output"),
        (("system", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
    Layout(
        "system_prompt_response",
        ("conv_id", "system", "prompt", "response"),
        (("system", "system"), ("user", "prompt"), ("assistant", "response")),
    ),
)


def _shape(paths: tuple[str, ...]) -> str:
    """The nested field paths in the order in which Spark writes a variant's schema, without types."""
    tree: dict = {}
    for path in paths:
        at = tree
        for step in path.split("."):
            at = at.setdefault(step, {})

    def text(node: dict) -> str:
        parts = []
        for key in sorted(node, key=lambda k: k.removesuffix("[]")):
            inner = text(node[key]) if node[key] else "*"
            parts.append(f"{key.removesuffix('[]')}: " + (f"ARRAY<{inner}>" if key.endswith("[]") else inner))
        return f"OBJECT<{', '.join(parts)}>"

    return text(tree)


def layout_hash(paths: tuple[str, ...]) -> str:
    return hashlib.sha256(_shape(paths).encode()).hexdigest()


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a variant; types of scalars do not count."""
    scalar = r"(?<=(: |<))(?!OBJECT<|ARRAY<)[A-Z]+(\(\d+(,\d+)?\))?(?=[,>])"
    return F.sha2(F.regexp_replace(F.schema_of_variant(record), scalar, "*"), 256)


def as_records(df: DataFrame) -> DataFrame:
    """One variant column ``record`` from the columns of a frame."""
    return df.select(F.to_variant_object(F.struct(*(F.col(f"`{c}`") for c in df.columns))).alias("record"))


def _get(record: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(record, "$." + path, kind)


def _turns(layout: Layout) -> Column:
    record = F.col("record")

    def one(turn: Column, role: Column, text: Column) -> Column:
        known = role
        if layout.roles:
            pairs = [F.lit(x) for kv in layout.roles.items() for x in kv]
            known = F.coalesce(F.element_at(F.create_map(*pairs), role), role)
        return F.struct(
            turn.cast("long").alias("turn"),
            F.coalesce(known, F.lit("")).alias("role"),
            F.coalesce(text, F.lit("")).alias("text"),
        )

    if layout.turns:
        return F.array(
            *(one(F.lit(n), F.lit(role), _get(record, path, "string")) for n, (role, path) in enumerate(layout.turns))
        ).cast(TURNS)
    if layout.each:
        items = _get(record, layout.each, "array<variant>")
        return F.transform(
            items, lambda x, n: one(n, _get(x, layout.role, "string"), _get(x, layout.text, "string"))
        ).cast(TURNS)
    turn = _get(record, layout.turn, "bigint") if layout.turn else F.lit(0)
    return F.array(one(turn, _get(record, layout.role, "string"), _get(record, layout.text, "string"))).cast(TURNS)


def to_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, turn, role, text, layout) of records in ``record``; see ``unmapped`` for the rest."""
    marked = records.select("record", fingerprint(F.col("record")).alias("paths_hash"))
    name, conv, turns = F.lit(None).cast("string"), F.lit(None).cast("long"), F.lit(None).cast(TURNS)
    for layout in layouts:
        here = F.col("paths_hash") == layout_hash(layout.paths)
        name = F.when(here, F.lit(layout.name)).otherwise(name)
        conv = F.when(here, _get(F.col("record"), layout.id, "bigint")).otherwise(conv)
        turns = F.when(here, _turns(layout)).otherwise(turns)
    return marked.select(name.alias("layout"), conv.alias("conv_id"), F.explode(turns).alias("t")).select(
        "conv_id", "t.turn", "t.role", "t.text", "layout"
    )


def unmapped(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Records of an unknown layout, with the hash of their paths."""
    known = [layout_hash(x.paths) for x in layouts]
    marked = records.select("record", fingerprint(F.col("record")).alias("paths_hash"))
    return marked.filter(F.col("paths_hash").isNull() | ~F.col("paths_hash").isin(known))


# --- template --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Template:
    """Marks around the turns. Roles without marks of their own are written out by ``other``.

    Inside texts a backslash goes after the first character of each control string, and one more
    where some are there already; taking one away gives the text back.
    """

    marks: tuple[tuple[str, str, str], ...] = (("user", "<s>[INST] ", " [/INST]"), ("assistant", " ", " </s>"))
    other: tuple[str, str, str] = ("<s>[ROLE]", "[SAYS]", "[/ROLE]")
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[SAYS]", "[/ROLE]")

    def __post_init__(self):
        for a in self.controls:
            for b in self.controls:
                for i in range(1, len(a)):
                    if a[i:].startswith(b) or b.startswith(a[i:]):
                        raise ValueError(f"{b!r} may start within {a!r}: escapes would not be reversible")

    def _rests(self) -> dict[str, str]:
        """Pattern of what may follow each first character: backslashes and the rest of a control string."""
        firsts = dict.fromkeys(c[0] for c in self.controls)
        return {f: "\\\\*(?:" + "|".join(re.escape(c[1:]) for c in self.controls if c[0] == f) + ")" for f in firsts}

    def escape(self, text: Column) -> Column:
        heads = "|".join(f"{re.escape(f)}(?={rest})" for f, rest in self._rests().items())
        return F.regexp_replace(text, f"({heads})", "$1\\\\")

    def unescape(self, text: Column) -> Column:
        heads = "|".join(f"(?<={re.escape(f)})\\\\(?={rest})" for f, rest in self._rests().items())
        return F.regexp_replace(text, heads, "")

    def turn(self, role: Column, text: Column) -> Column:
        """array(mark before, escaped text, mark after) of a turn."""
        start, says, end = self.other
        out = F.array(F.concat(F.lit(start), self.escape(role), F.lit(says)), self.escape(text), F.lit(end))
        for name, before, after in self.marks:
            out = F.when(role == name, F.array(F.lit(before), self.escape(text), F.lit(after))).otherwise(out)
        return out

    def pattern(self) -> str:
        """One turn; groups: role (if written out) and its text, then the text of each marked role."""
        start, says, end = map(re.escape, self.other)
        return f"(?s){start}(.*?){says}(.*?){end}" + "".join(
            f"|{re.escape(before)}(.*?){re.escape(after)}" for _, before, after in self.marks
        )


CHAT = Template()


def formatted(turns: DataFrame, template: Template = CHAT, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, formatted, loss_spans): one text per conversation, and the spans to learn from.

    Spans are code points of ``formatted``, end exclusive. A conversation is one output value, so
    its turns meet in one place; conversations with many turns grow that value, not the number of
    rows any step holds together.
    """
    # The row order of a group is not fixed, so turns are sorted inside the row.
    whole = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-(2**63))).alias("turn"), "role", "text"))).alias("t")
    )
    parts = whole.select(
        "conv_id",
        F.transform(
            "t",
            lambda t: F.struct(
                template.turn(t["role"], t["text"]).alias("p"), t["role"].isin(list(learn)).alias("learn")
            ),
        ).alias("parts"),
    )
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    spans = F.aggregate(
        "parts",
        state,
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["p"][0]) + F.length(x["p"][1]) + F.length(x["p"][2])).alias("at"),
            F.when(
                x["learn"],
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(x["p"][0])).alias("start"),
                            (acc["at"] + F.length(x["p"][0]) + F.length(x["p"][1])).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
        lambda acc: acc["out"],
    )
    text = F.array_join(F.transform("parts", lambda x: F.array_join(x["p"], "")), "")
    return parts.select("conv_id", text.alias("formatted"), spans.alias("loss_spans"))


def read_back(done: DataFrame, template: Template = CHAT) -> DataFrame:
    """(conv_id, formatted, turns, loss): turns and learned texts, read from the formatted text alone."""
    pattern = F.lit(template.pattern())
    start, end = template.other[0], template.other[2]
    groups = [F.regexp_extract_all("formatted", pattern, F.lit(g)).alias(f"g{g}") for g in range(len(template.marks) + 3)]
    found = done.select("conv_id", "formatted", "loss_spans", *groups)

    def one(whole: Column, n: Column) -> Column:
        role, text = template.unescape(F.get("g1", n)), F.get("g2", n)
        for g, (name, before, after) in reversed(list(enumerate(template.marks))):
            here = F.startswith(whole, F.lit(before)) & F.endswith(whole, F.lit(after))
            here = here & ~(F.startswith(whole, F.lit(start)) & F.endswith(whole, F.lit(end)))
            role, text = F.when(here, F.lit(name)).otherwise(role), F.when(here, F.get(f"g{g + 3}", n)).otherwise(text)
        return F.struct(role.alias("role"), template.unescape(text).alias("text"))

    loss = F.transform(
        "loss_spans",
        lambda s: template.unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])),
    )
    return found.select("conv_id", "formatted", F.transform("g0", one).alias("turns"), loss.alias("loss"))


def digest(read: DataFrame) -> DataFrame:
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
