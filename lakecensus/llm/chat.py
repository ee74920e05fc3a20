"""Chat formatting by schema fingerprinting, in DataFrame functions only.

A record's fingerprint is the MD5 of its sorted non-null field paths, restricted to the paths any
mapping knows (other columns never matter, whatever their names). It selects a declarative
mapping, which turns the record into canonical turns (position, role, text):

* rows by turn            conversation id, role, text or content, turn
* message lists           messages[].role / .content, conversations[].from / .value
* prompt and answer       prompt / completion, prompt / response, question / answer
* instructions            instruction, input, output

Turns are rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts every
``<`` + n backslashes + ``|`` gets one backslash more, and roles escape % and line feeds, so no
text can forge a control string and ``unescape`` gives back every code point. The loss mask is
run-length coded by turn: code points before, under and after the loss; together they cover the
whole string.

Defined cases: null text and role are empty; turns are ordered by (turn, role, text), a null turn
first, repeated rows stay; a record without a mapping yields no turn but keeps its row with ``layout`` null; a
null conversation id is one conversation; an empty table gives no rows. One conversation is one
output value, so its rows meet in one task; everything else is spread by conversation id.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
TURNS = "array<struct<pos:bigint,role:string,text:string>>"

# layout: the paths it needs, those of which it needs one at least, those it may have, its kind,
# and where positions, roles and texts come from
LAYOUTS: dict[str, dict] = {
    "turn_row": {"needs": (), "one_of": ("role", "turn"), "may": ("text",), "kind": "row", "pos": "turn",
                 "role": "role", "text": "text"},
    "turn_row_content": {"needs": ("content",), "one_of": ("role", "turn"), "may": (), "kind": "row", "pos": "turn",
                         "role": "role", "text": "content"},
    "messages": {"needs": ("messages",), "may": ("messages[].role", "messages[].content"), "kind": "list",
                 "list": "messages", "role": "role", "text": "content"},
    "sharegpt": {"needs": ("conversations",), "may": ("conversations[].from", "conversations[].value"),
                 "kind": "list", "list": "conversations", "role": "from", "text": "value"},
    "prompt_completion": {"needs": ("completion", "prompt"), "may": ("system",), "kind": "fields",
                          "turns": (("system", ("system",)), ("user", ("prompt",)), (LOSS_ROLE, ("completion",)))},
    "prompt_response": {"needs": ("prompt", "response"), "may": ("system",), "kind": "fields",
                        "turns": (("system", ("system",)), ("user", ("prompt",)), (LOSS_ROLE, ("response",)))},
    "question_answer": {"needs": ("answer", "question"), "may": ("system",), "kind": "fields",
                        "turns": (("system", ("system",)), ("user", ("question",)), (LOSS_ROLE, ("answer",)))},
    "instruction": {"needs": ("instruction", "output"), "may": ("input", "system"), "kind": "fields",
                    "turns": (("system", ("system",)), ("user", ("instruction", "input")),
                              (LOSS_ROLE, ("output",)))},
}
ROLE_NAMES = {"human": "user", "gpt": LOSS_ROLE, "model": LOSS_ROLE, "bot": LOSS_ROLE}
PATHS = sorted({p for m in LAYOUTS.values() for p in (*m["needs"], *m.get("one_of", ()), *m["may"])})


def _digest(paths) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


def _subsets(paths: tuple, least: int = 0) -> list[tuple]:
    return [c for n in range(least, len(paths) + 1) for c in combinations(paths, n)]


def fingerprints(layout: str) -> list[str]:
    """All fingerprints that select a layout: its needed paths with any of its optional ones."""
    m = LAYOUTS[layout]
    some = _subsets(m["one_of"], 1) if "one_of" in m else [()]
    return [_digest((*m["needs"], *x, *y)) for x in some for y in _subsets(m["may"])]


def _present(schema: StructType, path: str) -> Column | None:
    """Whether a record has a value at a path; None if its schema cannot have one."""
    top, _, leaf = path.partition("[].")
    if top not in schema.fieldNames():
        return None
    kind = schema[top].dataType
    if not leaf:
        if any(p.startswith(f"{top}[]") for p in PATHS) and not isinstance(kind, ArrayType):
            return None
        return F.col(f"`{top}`").isNotNull()
    if not (isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType)
            and leaf in kind.elementType.fieldNames()):
        return None
    return F.coalesce(F.exists(F.col(f"`{top}`"), lambda x: x[leaf].isNotNull()), F.lit(False))


def fingerprint(schema: StructType) -> Column:
    """MD5 of the sorted known paths that have a value in the record."""
    have = [F.when(c, F.lit(p)) for p in PATHS if (c := _present(schema, p)) is not None]
    return F.md5(F.concat_ws("\n", *have) if have else F.lit(""))


def layout_of(print_: Column) -> Column:
    """The layout a fingerprint selects, or null."""
    out = None
    for name in LAYOUTS:
        hit = print_.isin(fingerprints(name))
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out


def canonical_turns(schema: StructType, layout: Column) -> Column:
    """The record's turns by its layout's mapping, as an array of (pos, role, text)."""
    names = set(schema.fieldNames())

    def text(path: str) -> Column:
        return F.col(f"`{path}`").cast("string") if path in names else F.lit(None).cast("string")

    def role(value: Column) -> Column:
        out = value
        for a, b in ROLE_NAMES.items():
            out = F.when(value == a, F.lit(b)).otherwise(out)
        return F.coalesce(out, F.lit(""))

    def turn(pos: Column, who: Column, what: Column) -> Column:
        return F.struct(pos.cast("bigint").alias("pos"), who.alias("role"),
                        F.coalesce(what, F.lit("")).alias("text"))

    def listed(m: dict, fields: list[str]):
        def one(x: Column, i: Column) -> Column:
            who = role(x[m["role"]].cast("string")) if m["role"] in fields else F.lit("")
            return turn(i, who, x[m["text"]].cast("string") if m["text"] in fields else F.lit(""))

        return one

    empty = F.array().cast(TURNS)
    out = empty
    for name, m in reversed(LAYOUTS.items()):
        if not {p.split("[].")[0] for p in m["needs"]} <= names:
            continue
        if m["kind"] == "row":
            turns = F.array(turn(text(m["pos"]), F.coalesce(text(m["role"]), F.lit("")), text(m["text"])))
        elif m["kind"] == "list":
            element = schema[m["list"]].dataType
            if not (isinstance(element, ArrayType) and isinstance(element.elementType, StructType)):
                continue
            turns = F.transform(F.col(f"`{m['list']}`"), listed(m, element.elementType.fieldNames()))
        else:
            parts = []
            for i, (who, paths) in enumerate(m["turns"]):
                if not set(paths) & names:
                    continue
                what = F.concat_ws("\n\n", *[F.when(text(p) != "", text(p)) for p in paths])
                one = F.array(turn(F.lit(i), F.lit(who), what))
                parts.append(F.when(what != "", one).otherwise(empty) if who == "system" else one)
            turns = F.concat(*parts)
        out = F.when(layout == name, turns.cast(TURNS)).otherwise(out)
    return out


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def to_turns(records: DataFrame, conversation: str) -> DataFrame:
    """Rows of (conversation, fingerprint, layout, pos, role, text); a record without a mapping
    gives one row with null layout, pos and role."""
    schema = records.schema
    out = records.select("*", fingerprint(schema).alias("_fp")).withColumn("_layout", layout_of(F.col("_fp")))
    return out.select(
        F.col(conversation).alias("conversation"), F.col("_fp").alias("fingerprint"), F.col("_layout").alias("layout"),
        F.explode_outer(canonical_turns(schema, F.col("_layout"))).alias("_t"),
    ).select("conversation", "fingerprint", "layout", "_t.*")


def format_chats(records: DataFrame, conversation: str) -> DataFrame:
    """One row per conversation: n_turns, formatted, and the loss mask by turn as an array of
    (before, loss, after) code points. Conversations without a mapped record give empty strings."""
    turns = to_turns(records, conversation)
    pieces = turns.groupBy("conversation").agg(
        F.array_sort(F.collect_list(F.when(F.col("role").isNotNull(), F.struct("pos", "role", "text")))).alias("t"))
    heads = F.transform("t", lambda x: F.struct(
        F.concat(F.lit(START), escape_role(x["role"]), F.lit("\n")).alias("head"),
        escape(x["text"]).alias("body"), (x["role"] == LOSS_ROLE).alias("loss")))
    tail = F.lit(END + "\n")
    return pieces.withColumn("p", heads).select(
        "conversation", F.size("p").cast("long").alias("n_turns"),
        F.array_join(F.transform("p", lambda x: F.concat(x["head"], x["body"], tail)), "").alias("formatted"),
        F.transform("p", lambda x: F.struct(
            (F.char_length(x["head"]) + F.when(x["loss"], 0).otherwise(F.char_length(x["body"]) + len(END) + 1))
            .alias("before"),
            F.when(x["loss"], F.char_length(x["body"])).otherwise(0).alias("loss"),
            F.when(x["loss"], F.lit(len(END) + 1)).otherwise(0).alias("after"))).alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse ``format_chats`` output: ``turns`` (role, text) and ``loss_text``, all unescaped.

    Escaped text holds no control string, so every START begins a turn. The mask's run lengths
    cut the loss out of each turn's own part of the string."""
    parts = F.filter(F.split("formatted", r"(?=<\|im_start\|>)"), lambda x: x != "")

    def turn(part: Column) -> Column:
        inner = F.substring(part, F.lit(len(START) + 1), F.char_length(part) - len(START) - len(END) - 1)
        role = F.substring_index(inner, "\n", 1)
        body = F.substring(inner, F.char_length(role) + 2, F.char_length(inner))
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))

    def loss(part: Column, i: Column) -> Column:
        m = F.get(F.col("mask"), i)
        return F.substring(part, m["before"] + 1, m["loss"])

    return formatted.withColumn("_parts", parts).select(
        "*", F.transform("_parts", turn).alias("turns"),
        F.array_join(F.transform(F.transform("_parts", loss), unescape), "").alias("loss_text")).drop("_parts")
