"""Formatted conversations against a plain formatter, and every text back out of them."""

import hashlib
import json
import re

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillstream.llm import chat
from tillstream.llm.queries import CHECKS, QUERIES

MARKS = chat.DEFAULT.controls()
TURNS = "conv_id long, turn long, role string, text string"


def escaped(text):
    for mark in MARKS:
        text = re.sub(re.escape(mark[0]) + r"(\\*)" + re.escape(mark[1:]), lambda m: m[0][0] + "\\" + m[0][1:], text)
    return text


def wrap(role, flat):
    t = chat.DEFAULT
    if role == "user":
        return t.user[0] + flat + t.user[1], len(t.user[0])
    if role == "system":
        return t.system[0] + flat + t.system[1], len(t.system[0])
    if role == "assistant":
        return flat + t.assistant_end, 0
    head = t.named[0] + escaped(role) + t.named[1]
    return head + flat + t.named[2], len(head)


def brute(rows):
    """conv_id -> formatted, turns, loss places."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        order = sorted(turns, key=lambda r: (r[0], r[1], r[2], wrap(r[2], escaped(r[3]))[0]))
        formatted, loss = "", []
        for _, _, role, text in order:
            piece, begin = wrap(role, escaped(text))
            if role == "assistant":
                loss.append((len(formatted) + begin, len(escaped(text))))
            formatted += piece
        out[conv] = formatted, [(r, t) for _, _, r, t in order], loss
    return out


ODD = [
    (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "[\\INST] \\[INST]\\ [\\\\/INST] <\\/s>"), (1, 2, None, None),
    (1, 3, "tool [SAYS] x", "a[IMG]b [\\IMG] <s><<s>>[[INST]]"), (1, None, "system", "first"), (1, None, None, "also first"),
    (2, 5, "assistant", ""), (2, 5, "assistant", ""), (2, 4, "assistant", None), (2, 6, "user", ""),
    (None, 1, "user", "no id"), (None, 0, "assistant", "🙂 ünï\n[/INST]</s>"), (3, 0, "assistant", "x" * 200_000 + "</s>"),
    (4, 0, "named", "[SYS] a [/SYS]"), (4, 0, "assistant", "b"), (4, 0, "user", "c"), (5, 0, "", ""), (6, 0, "user\n", "[ROLE] [/ROLE]"),
]


@pytest.fixture(scope="module")
def turns(spark, sf_dir):
    odd = spark.createDataFrame(ODD, TURNS)
    both = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return both.selectExpr("conv_id + 1000 as conv_id", "turn", "role", "text").unionByName(odd).selectExpr(
        "*", "'x' as pos", "1 as piece", "'f' as files", "2 as begin", "3 as length", "4 as tokens", "5 as formatted"
    )


def test_formatted_texts_and_loss(turns):
    want = brute([(r.conv_id, r.turn, r.role, r.text) for r in turns.collect()])
    got = {r.conv_id: r for r in chat.format(turns).collect()}
    assert got.keys() == want.keys()
    for conv, (formatted, said, loss) in want.items():
        assert got[conv].formatted == formatted
        assert got[conv].n_turns == len(said)
        assert [tuple(m) for m in got[conv].loss] == loss


def test_everything_comes_back(turns):
    want = brute([(r.conv_id, r.turn, r.role, r.text) for r in turns.collect()])
    for r in chat.read(chat.format(turns)).collect():
        said = want[r.conv_id][1]
        assert [(t.role, t.text) for t in r.turns] == said
        assert r.masked == "".join(t for role, t in said if role == "assistant")
        assert r.formatted_chars == len(want[r.conv_id][0])
    for r in chat.digests(chat.format(turns)).collect():
        said = want[r.conv_id][1]
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
        assert r.loss_chars == sum(len(t) for role, t in said if role == "assistant")


_TEXT = st.lists(st.sampled_from([*MARKS, "\\", "[", "<", "/", "INST]", "s>", " ", "a", "\n", "]"]), max_size=8).map("".join)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.sampled_from(["user", "system", "assistant"]) | _TEXT, _TEXT), min_size=1, max_size=40))
def test_any_marks_in_texts_and_roles(spark, rows):
    got = chat.read(chat.format(spark.createDataFrame(rows, TURNS))).collect()
    want = brute(rows)
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in got} == {k: v[1] for k, v in want.items()}


def part(kind, **more):
    return {"type": kind, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None} | more


def test_typed_parts(spark):
    content = [
        part("text", text="see "), part("image", ref="s3://a.png", width=57, height=28), part("text", text=" and [IMG]"),
        part("audio", ref="b.wav", seconds=2.0), part("document", ref="c.pdf", pages=2), part("table", ref="d"), part(None, text="!"),
    ]
    rows = [(1, 0, "user", content), (1, 1, "assistant", [part("image", ref="e.png")]), (1, 2, "user", None), (2, 0, "user", [None])]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{chat.PART}>")
    out = {r.conv_id: r for r in chat.format(turns).collect()}
    one = out[1]
    flat = "[INST] see [IMG] and [\\IMG][AUDIO][DOC][PART]! [/INST][IMG]</s>[INST]  [/INST]"
    assert one.formatted == flat
    places = [(f.turn, f.part, f.kind, f.ref, f.tokens) for f in one.files]
    assert places == [
        (0, 1, "image", "s3://a.png", 3), (0, 3, "audio", "b.wav", 25), (0, 4, "document", "c.pdf", 2048), (0, 5, "table", "d", 0),
        (1, 0, "image", "e.png", 0),
    ]
    for f, holder in zip(one.files, ["[IMG]", "[AUDIO]", "[DOC]", "[PART]", "[IMG]"], strict=True):
        assert one.formatted[f.at :].startswith(holder)
    assert one.tokens == 3 + 25 + 2048 + 1 + 4 + 1  # words and marks: see; and [ IMG ]; !
    back = {r.conv_id: r.turns for r in chat.read(chat.format(turns)).collect()}
    assert [(p.type, p.text) for p in back[1][0].content] == [
        ("text", "see "), ("image", ""), ("text", " and [IMG]"), ("audio", ""), ("document", ""), ("other", ""), ("text", "!"),
    ]
    assert [t.text for t in back[2]] == [""]


def test_visits_can_be_replaced(spark):
    class Tiles(chat.Visitor):
        def image(self, part):
            return super().image(part)[0], super().image(part)[1] + 1

    rows = [(1, 0, "user", [part("image", width=28, height=28)])]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{chat.PART}>")
    assert chat.format(turns, Tiles()).first().tokens == 2


@pytest.mark.parametrize("bad", [{"image": "[IN"}, {"audio": "x[INST]"}, {"document": "\\doc"}, {"other": "T][SYS"}])
def test_templates_that_could_be_misread_are_refused(bad):
    with pytest.raises(ValueError):
        chat.Template(**bad)


def test_empty_table(spark):
    none = spark.createDataFrame([], TURNS)
    assert chat.format(none).count() == 0
    assert chat.digests(chat.format(none)).count() == 0


def test_query(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    want = sorted(con.execute(CHECKS["op11_chat_format"]).fetchall())
    got = QUERIES["op11_chat_format"](spark, sf_dir)
    names = [d[0] for d in con.description]
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == want
    assert -7 in {r[names.index("conv_id")] for r in want}


def test_no_python_in_the_plan(turns):
    plan = chat.digests(chat.format(turns))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert json.dumps(plan).count("Exchange hashpartitioning") <= 4  # one shuffle, in the few printed forms of the plan
