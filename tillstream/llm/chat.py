"""Chat formatting of typed content parts, with DataFrame functions only.

A visitor turns each part of a message into a column expression: text is escaped, an image, a sound or a
document becomes its placeholder, with a reference to the attachment and the number of tokens the placeholder
expands to. The parts of a turn, then the turns of a conversation, are put together in order; offsets are
running sums over the turns, so nothing is searched for again.

**Template.** Users and the system stand between an opening and a closing mark, the assistant's text ends
with its own mark, any other role is spelled out. No mark and no placeholder may begin inside another one. In texts and role names a
backslash goes behind the first character of whatever reads like one of them, also when backslashes are
there already, so no text can open or close a turn and :func:`read` gets every character back.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A part of a message; what a kind does not need stays null.
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    user: tuple[str, str] = ("[INST] ", " [/INST]")
    system: tuple[str, str] = ("[SYS] ", " [/SYS]")
    assistant_end: str = "</s>"
    #: Before the name of any other role, between it and the text, and at the end.
    named: tuple[str, str, str] = ("[ROLE] ", "[SAYS] ", " [/ROLE]")
    image: str = "[IMG]"
    audio: str = "[AUDIO]"
    document: str = "[DOC]"
    #: A part of any other type.
    other: str = "[PART]"
    #: Control strings of the tokenizer that the template does not write itself.
    reserved: tuple[str, ...] = ("<s>", "<unk>", "<pad>")
    #: Side of the square of pixels that makes one image token.
    patch: int = 28
    audio_tokens_per_second: float = 12.5
    tokens_per_page: int = 1024

    def __post_init__(self) -> None:
        marks = self.controls()
        for a in marks:
            if len(a) < 2 or ESCAPE in a:
                raise ValueError(f"not a control string: {a!r}")
            for b in marks:
                inside = any(b.startswith(a[i:]) or a[i:].startswith(b) for i in range(1, len(a)))
                if inside or (a != b and b.startswith(a)):
                    raise ValueError(f"{b!r} may begin inside {a!r}")

    def controls(self) -> list[str]:
        """The distinct control strings without the spaces that set them off."""
        marks = [*self.user, *self.system, self.assistant_end, *self.named, *self.placeholders(), *self.reserved]
        return list(dict.fromkeys(m.strip() for m in marks))

    def placeholders(self) -> list[str]:
        return [self.image, self.audio, self.document, self.other]


DEFAULT = Template()


def _any_of(strings: list[str]) -> str:
    return "|".join(re.escape(s) for s in strings)


def _split_marks(template: Template) -> tuple[str, str]:
    """Alternatives that match the first character of a control string before its rest, as look-around."""
    firsts: dict[str, list[str]] = {}
    for mark in template.controls():
        firsts.setdefault(mark[0], []).append(mark[1:])
    add = "|".join(rf"(?<={re.escape(c)})(?=\\*(?:{_any_of(rest)}))" for c, rest in firsts.items())
    cut = "|".join(rf"(?<={re.escape(c)})\\(?=\\*(?:{_any_of(rest)}))" for c, rest in firsts.items())
    return add, cut


def escape(text: Column, template: Template = DEFAULT) -> Column:
    """Put a backslash behind the first character of everything that reads like a control string."""
    return F.regexp_replace(text, _split_marks(template)[0], r"\\")


def unescape(text: Column, template: Template = DEFAULT) -> Column:
    """Take one backslash back from everything that :func:`escape` marked."""
    return F.regexp_replace(text, _split_marks(template)[1], "")


class Visitor:
    """Column expressions by kind of part; each visit gives ``flat``, ``tokens`` and ``kind`` of the part.

    A subclass may override a visit. ``tokens`` is what a placeholder expands to; null sizes count as zero. Text
    counts its words and single marks, an estimate that needs no tokenizer.
    """

    def __init__(self, template: Template = DEFAULT) -> None:
        self.template = template

    def text(self, part: Column) -> tuple[Column, Column]:
        text = F.coalesce(part["text"], F.lit(""))
        return escape(text, self.template), F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"))

    def image(self, part: Column) -> tuple[Column, Column]:
        def patches(side: Column) -> Column:
            return F.ceil(F.greatest(F.coalesce(side, F.lit(0)), F.lit(0)) / F.lit(self.template.patch)).cast("bigint")

        return F.lit(self.template.image), patches(part["width"]) * patches(part["height"])

    def audio(self, part: Column) -> tuple[Column, Column]:
        seconds = F.greatest(F.coalesce(part["seconds"], F.lit(0.0)), F.lit(0.0))
        return F.lit(self.template.audio), F.ceil(seconds * self.template.audio_tokens_per_second).cast("bigint")

    def document(self, part: Column) -> tuple[Column, Column]:
        pages = F.greatest(F.coalesce(part["pages"], F.lit(0)), F.lit(0)).cast("bigint")
        return F.lit(self.template.document), pages * self.template.tokens_per_page

    def other(self, part: Column) -> tuple[Column, Column]:
        return F.lit(self.template.other), F.lit(0)

    def visit(self, part: Column) -> Column:
        """The struct of a part of whatever kind; a part or a type that is null is text."""
        kind = F.coalesce(part["type"], F.lit("text"))
        kinds = {"text": self.text, "image": self.image, "audio": self.audio, "document": self.document}
        flat, tokens = self.other(part)
        for name, see in kinds.items():
            seen = see(part)
            flat, tokens = F.when(kind == name, seen[0]).otherwise(flat), F.when(kind == name, seen[1]).otherwise(tokens)
        return F.struct(
            flat.alias("flat"), tokens.cast("bigint").alias("tokens"), kind.alias("kind"), part["ref"].alias("ref")
        )


def _flatten(visited: Column) -> Column:
    """Text, tokens and attachments (with their places in the text) of the visited parts of a turn."""
    empty = F.struct(
        F.lit("").alias("flat"), F.lit(0).cast("bigint").alias("tokens"),
        F.array().cast("array<struct<kind:string,ref:string,part:bigint,at:bigint,tokens:bigint>>").alias("files"),
        F.lit(0).cast("bigint").alias("part"),
    )

    def add(acc: Column, one: Column) -> Column:
        file = F.struct(
            one["kind"].alias("kind"), one["ref"].alias("ref"), acc["part"].alias("part"),
            F.char_length(acc["flat"]).cast("bigint").alias("at"), one["tokens"].alias("tokens"),
        )
        return F.struct(
            F.concat(acc["flat"], one["flat"]).alias("flat"),
            (acc["tokens"] + one["tokens"]).alias("tokens"),
            F.when(one["kind"] == "text", acc["files"]).otherwise(F.concat(acc["files"], F.array(file))).alias("files"),
            (acc["part"] + 1).alias("part"),
        )

    return F.aggregate(visited, empty, add)


def text_part(text: Column) -> Column:
    """A plain text as the content of a turn."""
    rest = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    part = [F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text")]
    return F.array(F.struct(*part, *[F.lit(None).cast(t).alias(n) for n, t in rest.items()]))


def format_turns(turns: DataFrame, visitor: Visitor | None = None) -> DataFrame:
    """One row for each turn, as it stands in the formatted conversation.

    ``turns`` has ``conv_id, turn, role`` and either ``content``, an array of :data:`PART`, or a plain ``text``; other columns are
    ignored. Result: ``conv_id, turn, role, piece, begin`` (where the text begins in the piece), ``length``, ``tokens``,
    ``files``. A null role is an empty one, null content is an empty text, a null turn or id is a value like any
    other, and repeated rows are turns each.
    """
    visitor = visitor or Visitor()
    t = visitor.template
    content = F.coalesce("content", text_part(F.lit(""))) if "content" in turns.columns else text_part(F.col("text"))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), content.alias("content"))
    flat = rows.select("conv_id", "turn", "role", _flatten(F.transform("content", visitor.visit)).alias("f"))
    role = F.col("role")
    head = (
        F.when(role == "user", t.user[0]).when(role == "system", t.system[0]).when(role == "assistant", "")
        .otherwise(F.concat(F.lit(t.named[0]), escape(role, t), F.lit(t.named[1])))
    )
    tail = (
        F.when(role == "user", t.user[1]).when(role == "system", t.system[1]).when(role == "assistant", t.assistant_end)
        .otherwise(t.named[2])
    )
    return flat.select(
        "conv_id", "turn", "role", F.concat(head, F.col("f.flat"), tail).alias("piece"),
        F.char_length(head).cast("bigint").alias("begin"), F.char_length("f.flat").cast("bigint").alias("length"),
        F.col("f.tokens").alias("tokens"), F.col("f.files").alias("files"),
    )


def format(turns: DataFrame, visitor: Visitor | None = None) -> DataFrame:
    """One row for each conversation.

    ``conv_id``; ``n_turns``; ``formatted``, all turns by ``turn`` (nulls first; ties by role, then by the turn as formatted); ``loss``, the
    places ``begin, length`` of the assistant's texts in it; ``files``, the attachments in order with ``turn`` (its
    number from 0), ``part``, ``at`` (place of the placeholder), ``kind``, ``ref`` and ``tokens``; ``tokens`` of everything. Places
    count code points. Ids that are null are one conversation. A table without rows gives none.

    One shuffle by ``conv_id``: running sums give each turn its place, then the turns are put together where they
    are. A conversation ends as one row, so the longest one must fit a task; the turns themselves do not need to lie together
    before (:func:`format_turns`).
    """
    pieces = format_turns(turns, visitor)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "piece")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.select(
        "*", (F.row_number().over(order) - 1).alias("pos"),
        F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0)).alias("from"),
    )
    loss = F.struct((F.col("from") + F.col("begin")).alias("begin"), F.col("length"))
    files = F.transform(
        "files",
        lambda f: F.struct(
            F.col("pos").cast("bigint").alias("turn"), f["part"].alias("part"),
            (F.col("from") + F.col("begin") + f["at"]).alias("at"), f["kind"].alias("kind"), f["ref"].alias("ref"),
            f["tokens"].alias("tokens"),
        ),
    )
    grouped = placed.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("pos", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(F.when(F.col("role") == "assistant", loss))).alias("loss"),
        F.sort_array(F.flatten(F.collect_list(files))).alias("files"),
        F.sum("tokens").alias("tokens"),
    )
    return grouped.select(
        "conv_id", "n_turns", F.array_join(F.col("pieces.piece"), "").alias("formatted"), "loss", "files", "tokens"
    )


def _turn_pattern(t: Template) -> str:
    user, system, named = ([re.escape(m) for m in marks] for marks in (t.user, t.system, t.named))
    return (
        rf"(?s)(?:{user[0]}.*?{user[1]}|{system[0]}.*?{system[1]}|{named[0]}.*?{named[2]}|.*?{re.escape(t.assistant_end)})"
    )


def _inner(turn: Column, head: Column, tail: str) -> Column:
    n = F.char_length(head)
    return F.substr(turn, n + 1, F.char_length(turn) - n - len(tail))


def read(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Conversations from their formatted texts alone: ``conv_id, turns, masked``.

    ``turns`` is an array of ``role, text, content``: the text without escapes (placeholders stand in it as they are) and its parts,
    where neighbouring texts are one part and each attachment has its number ``file`` in the conversation. ``masked`` is
    what lies under the loss mask, without escapes. Any text between marks comes back character by character.
    """
    t = template
    holders = _any_of(t.placeholders())

    def parts(flat: Column) -> Column:
        texts = F.transform(F.split(flat, holders, -1), lambda s: F.struct(F.lit("text").alias("type"), unescape(s, t).alias("text")))
        kinds = dict(zip(t.placeholders(), ["image", "audio", "document", "other"], strict=True))
        names = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
        files = F.transform(
            F.regexp_extract_all(flat, F.lit(f"({holders})"), F.lit(0)),
            lambda s: F.struct(names[s].alias("type"), F.lit("").alias("text")),
        )
        return F.filter(
            F.flatten(F.transform(F.arrays_zip(texts.alias("a"), files.alias("b")), lambda z: F.array(z["a"], z["b"]))),
            lambda p: p.isNotNull() & ((p["type"] != "text") | (p["text"] != "")),
        )

    def one(turn: Column) -> Column:
        said = F.regexp_extract(turn, rf"(?s)^{re.escape(t.named[0])}(.*?){re.escape(t.named[1])}", 1)
        named_head = F.concat(F.lit(t.named[0]), said, F.lit(t.named[1]))
        is_user, is_system, is_named = (F.startswith(turn, F.lit(m[0])) for m in (t.user, t.system, t.named))
        role = F.when(is_user, "user").when(is_system, "system").when(is_named, unescape(said, t)).otherwise("assistant")
        flat = (
            F.when(is_user, _inner(turn, F.lit(t.user[0]), t.user[1]))
            .when(is_system, _inner(turn, F.lit(t.system[0]), t.system[1]))
            .when(is_named, _inner(turn, named_head, t.named[2]))
            .otherwise(_inner(turn, F.lit(""), t.assistant_end))
        )
        return F.struct(role.alias("role"), unescape(flat, t).alias("text"), parts(flat).alias("content"))

    masked = F.transform("loss", lambda m: unescape(F.substr("formatted", (m["begin"] + 1).cast("int"), m["length"].cast("int")), t))
    return formatted.select(
        "conv_id",
        F.transform(F.regexp_extract_all("formatted", F.lit(f"({_turn_pattern(t)})"), F.lit(0)), one).alias("turns"),
        F.array_join(masked, "").alias("masked"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def digests(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """What :func:`read` finds, in short: number and hash of the turns, length and hash of the text under the loss mask."""
    back = read(formatted, template)
    lines = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("masked").cast("bigint").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        "formatted_chars",
    )
