"""Chat formatting with schema fingerprints; DataFrame functions only.

A table's layout is told by the nested field paths it has: the paths that a row fills are hashed, and the hash selects a declarative mapping to canonical
turns (key, turn, role, text). Turns are then written in one template; control strings inside roles and texts are escaped so that the exact turns and the
exact text under the loss mask can be read back from the formatted text."""

from __future__ import annotations

import itertools
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: Beginnings of control strings, of this template and of others in use; what stands after the first character.
_ANGLE = r"<(\||/?s>|</?SYS>>)"
_SQUARE = r"\[(/?INST\])"


def escaped(c: Column) -> Column:
    """Backslashes are doubled, and one is put behind the first character of a control string, which is none then."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(F.regexp_replace(c, _ANGLE, r"<\\$1"), _SQUARE, r"[\\$1")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, r"\\(\\?)", "$1")


def paths(schema: T.DataType, at: str = "") -> list[str]:
    """Leaf paths; `[]` steps into an array."""
    if isinstance(schema, T.StructType):
        return [p for f in schema.fields for p in paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(schema, T.ArrayType):
        return paths(schema.elementType, at + "[]")
    return [at]


def _turns(*parts: tuple[str, Column, Column | None]) -> Column:
    """Turns from (role, text, condition); a turn whose condition fails is left out."""
    made = [F.struct(F.lit(role).cast("string").alias("role"), text.cast("string").alias("text"), (F.lit(True) if there is None else there).alias("there")) for role, text, there in parts]
    return F.transform(F.filter(F.array(*made), lambda t: t["there"]), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def _list(column: str, role: str, text: str, names: dict[str, str] | None = None) -> Callable[[], Column]:
    def named(r: Column) -> Column:
        out = r
        for k, v in (names or {}).items():
            out = F.when(r == k, F.lit(v)).otherwise(out)
        return out

    return lambda: F.transform(F.col(column), lambda t: F.struct(named(t[role].cast("string")).alias("role"), t[text].cast("string").alias("text")))


class Layout(NamedTuple):
    """A mapping: the paths that a row has to fill, those it may fill, and the turns it makes of them. With `columns`, which the table has to have, a row is one turn."""

    name: str
    needs: tuple[str, ...]
    may: tuple[str, ...]
    turns: Callable[[frozenset[str]], Column]
    columns: tuple[str, ...] = ()


def _pairs(prompt: str, answer: str) -> Callable[[frozenset[str]], Column]:
    return lambda has: _turns(*([("system", F.col("system"), None)] if "system" in has else []), ("user", F.col(prompt), None), ("assistant", F.col(answer), None))


def _instruction(has: frozenset[str]) -> Column:
    user = F.when(F.length("input") > 0, F.concat(F.col("instruction"), F.lit("\n\n"), F.col("input"))).otherwise(F.col("instruction")) if "input" in has else F.col("instruction")
    return _turns(*([("system", F.col("system"), None)] if "system" in has else []), ("user", user, None), ("assistant", F.col("output"), None))


def _with_system(turns: Callable[[], Column]) -> Callable[[frozenset[str]], Column]:
    return lambda has: F.concat(_turns(("system", F.col("system"), None)), turns()) if "system" in has else turns()


SHARE = {"human": "user", "gpt": "assistant", "bing": "assistant", "chatgpt": "assistant"}
#: A row is one turn.
ROWS = ("conv_id", "turn", "role", "text")
#: Where a conversation without turns stands, behind all turns.
LAST = 2**63 - 1
LAYOUTS = (
    Layout("rows", (), ("role", "text"), lambda has: F.array(F.struct(F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))), ROWS),
    Layout("messages", ("messages[].role", "messages[].content"), ("system",), _with_system(_list("messages", "role", "content"))),
    Layout("conversations", ("conversations[].from", "conversations[].value"), ("system",), _with_system(_list("conversations", "from", "value", SHARE))),
    Layout("instruction", ("instruction", "output"), ("input", "system"), _instruction),
    Layout("prompt_response", ("prompt", "response"), ("system",), _pairs("prompt", "response")),
    Layout("prompt_completion", ("prompt", "completion"), ("system",), _pairs("prompt", "completion")),
    Layout("question_answer", ("question", "answer"), ("system",), _pairs("question", "answer")),
)


def fingerprint(has: list[str] | tuple[str, ...] | set[str]) -> Column:
    """Hash of a set of paths, a constant."""
    return F.xxhash64(F.lit("\n".join(sorted(has))))


def row_fingerprint(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Hash of the paths that each row fills, of those that some layout knows. A field of an array counts as filled if the array is not null and not empty."""
    return _mark({p for x in layouts for p in (*x.needs, *x.may)} & set(paths(df.schema)))


def _filled(path: str) -> Column:
    head, _, rest = path.partition("[]")
    return F.col(head).isNotNull() if not rest else F.coalesce(F.size(head) > 0, F.lit(False))


def _mark(known: set[str]) -> Column:
    return F.xxhash64(F.concat_ws("\n", *(F.when(_filled(p), F.lit(p)) for p in sorted(known))))


def _subsets(x: list[str]) -> list[tuple[str, ...]]:
    return [c for n in range(len(x) + 1) for c in itertools.combinations(x, n)]


def _best(usable: list[Layout]) -> Column:
    """The layout of which a row fills most paths, the first of equals; where it fills none, a turn of its own if the table has those, else null."""
    scores = [sum((_filled(p).cast("int") for p in x.needs or x.may), F.lit(0)) for x in usable]
    top = F.greatest(*scores, F.lit(0))
    out = F.when(top == 0, F.lit(next((k for k, x in enumerate(usable) if x.columns), None)).cast("int"))
    for k, own in enumerate(scores):
        out = out.when(own == top, F.lit(k))
    return out


def canonical(df: DataFrame, key: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS, misfit: str = "error") -> DataFrame:
    """Turns (key, turn, role, text) of a table in any known layout, or in several at once: each row takes the mapping that its fingerprint selects.

    A table whose rows are turns has conv_id, turn, role and text; there a row that no fingerprint fits takes the layout of which it fills most. Other
    tables have one row for each conversation, with its key; there misfit="error" stops at a row that no fingerprint fits, and "empty" takes the layout of which
    it fills most, with empty turns for null fields, and no turns (role, text null, turn LAST) where it fills none. Null texts are empty; extra columns are not read."""
    if misfit not in ("error", "empty"):
        raise ValueError(f"misfit: {misfit}")
    there = set(paths(df.schema))
    usable = [x for x in layouts if {*x.needs, *x.columns} <= there and (not x.columns or key in df.columns)]
    if not usable:
        raise ValueError(f"no layout fits these fields: {sorted(there)}")
    mark, selected, turns = row_fingerprint(df, tuple(usable)), None, None
    by_row = next((k for k, x in enumerate(usable) if x.columns), None)
    for k, x in enumerate(usable):
        may = [p for p in x.may if p in there]
        for some in _subsets(may):
            hit = mark == fingerprint((*x.needs, *some))
            selected = F.when(hit, F.lit(k)) if selected is None else selected.when(hit, F.lit(k))
        for some in _subsets(may) if k != by_row else [()]:
            hit = F.col("__layout") == k if k == by_row else (F.col("__layout") == k) & (_mark(set(may)) == fingerprint(some))
            made = x.turns(frozenset((*x.needs, *some)))
            turns = F.when(hit, made) if turns is None else turns.when(hit, made)
    if by_row is not None or misfit == "empty":
        selected = selected.otherwise(_best(usable))
    else:
        selected = selected.otherwise(F.raise_error(F.concat(F.lit("no layout fits the row "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("int"))
    own = F.when(F.col("__layout") == by_row, F.col("turn")) if by_row is not None else F.lit(None).cast("long")
    rows = df.withColumn("__layout", selected).select(F.col(key).alias("key"), own.alias("own"), "__layout", F.posexplode_outer(turns).alias("turn", "t"))
    turn = F.when(F.col("__layout") == by_row, F.col("own")).otherwise(F.col("turn")) if by_row is not None else F.col("turn").cast("long")
    some = F.col("t").isNotNull()
    return rows.select("key", F.when(some, turn).otherwise(F.lit(LAST)).alias("turn"), F.when(some, F.coalesce("t.role", F.lit(""))).alias("role"), F.when(some, F.coalesce("t.text", F.lit(""))).alias("text"))


def formatted(turns: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(key, formatted, loss): one row a conversation. Turns stand in the order of turn, then role, then text (null turns first); repeated rows are turns
    of their own, and rows with a null key are one conversation. `loss` lists what is trained on, the texts of the `trained` roles, as spans of the formatted text
    (start, end) in code points, with the index of the turn."""
    from pyspark.sql import Window

    role, text = escaped(F.col("role")), escaped(F.col("text"))  # both null where a conversation has no turns: nothing is written
    rows = turns.select("key", "turn", "role", "text", F.concat(F.lit(TURN), role, F.lit(TEXT)).alias("head"), text.alias("body"))
    rows = rows.withColumns({"inside": F.char_length("head"), "long": F.char_length("body")})
    w = Window.partitionBy("key").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    size = F.col("inside") + F.col("long") + len(END)
    rows = rows.select(
        "key",
        F.struct(
            F.row_number().over(w).alias("i"), F.concat("head", "body", F.lit(END)).alias("piece"), F.col("role").isin(*trained).alias("trained"), "inside", "long",
            (F.sum(size.cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)) - size).alias("at"),
        ).alias("t"),
    )
    made = rows.groupBy("key").agg(F.array_sort(F.collect_list("t")).alias("t"))
    span = lambda t: F.struct((t["i"] - 1).alias("turn"), (t["at"] + t["inside"]).alias("start"), (t["at"] + t["inside"] + t["long"]).alias("end"))
    return made.select("key", F.array_join(F.transform("t", lambda t: t["piece"]), "").alias("formatted"), F.transform(F.filter("t", lambda t: t["trained"]), span).alias("loss"))


def read_back(made: DataFrame) -> DataFrame:
    """(key, formatted, turns, learnt): the turns (role, text) and the trained texts, from the formatted text and the offsets of its loss mask alone."""
    pieces = F.split("formatted", r"<\|turn\|>")  # the first is empty: the text begins with a turn
    made = made.select("key", "formatted", "loss", F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))).alias("pieces"))
    turn = lambda p: F.struct(unescaped(F.substring_index(p, TEXT, 1)).alias("role"), unescaped(F.substring_index(F.substring_index(p, TEXT, -1), END.strip(), 1)).alias("text"))
    learnt = lambda s: unescaped(F.col("formatted").substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return made.select("key", "formatted", F.transform("pieces", turn).alias("turns"), F.transform("loss", learnt).alias("learnt"))


def chat(df: DataFrame, key: str = "conv_id", trained: tuple[str, ...] = ("assistant",), layouts: tuple[Layout, ...] = LAYOUTS, misfit: str = "error") -> DataFrame:
    """Conversations of any known layout, formatted: key, formatted and loss, as `formatted` has them; `misfit` as in `canonical`. An empty table gives an empty result."""
    return formatted(canonical(df, key, layouts, misfit), trained)
