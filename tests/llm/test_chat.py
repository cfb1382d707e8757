"""Incremental rendering: spans, loss masks, escapes and templates that rewrite history."""
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from pulsehouse.llm import chat, queries

T = chat.Bracketed()
BITS = ["[INST]", "[/INST]", "</s>", "<s>", "[SYS]", "[ROLE]", "[TEXT]", "[/ROLE]", "\\", "[\\", "<\\/s>", " ", "x",
        "\n", "[", "<", "/s>", "INST]", "é"]
TEXT = st.lists(st.sampled_from(BITS), max_size=6).map("".join)
TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "tool", "[ROLE]"]), TEXT), max_size=6)


@settings(max_examples=400, deadline=None)
@given(TURNS)
def test_any_conversation_comes_back(turns):
    found = chat.locate(turns, T)
    assert not found.rewrites and found.output == T(turns) and T.read(found.output) == turns
    assert [T.unescape(found.output[a:b]) for a, b in found.loss] == [t for r, t in turns if r == "assistant"]
    assert [found.output[a:b] for a, b in found.spans] == [T([t]) for t in turns]


@given(TEXT)
def test_escaped_texts_hold_no_control_string(text):
    assert T.unescape(T.escape(text)) == text
    assert not any(m in T.escape(text) for m in ("[INST]", "[/INST]", "</s>", "<s>", "[SYS]", "[/SYS]", "[ROLE]", "[TEXT]", "[/ROLE]"))


def test_templates_that_rewrite_history_are_found():
    def last_thought_only(turns, prompt=False):
        out = []
        for i, (role, text) in enumerate(turns):
            out.append(f"<{role}>{text.split('</think>')[-1] if i + 1 < len(turns) else text}")
        return "".join(out) + ("<assistant>" if prompt else "")
    plain = [("user", "a"), ("assistant", "b"), ("user", "c")]
    assert not chat.locate(plain, last_thought_only).rewrites
    thought = [("user", "a"), ("assistant", "hm</think>b"), ("user", "c")]
    found = chat.locate(thought, last_thought_only)
    assert found.rewrites and found.loss == [] and found.spans == [None] * 3

    def numbered(turns, prompt=False):      # says at the start how many turns there are
        return f"{len(turns)}:" + "".join(t for _, t in turns)
    assert chat.locate(plain, numbered).rewrites


class Joined:
    """Turns of one role are joined by a line end: a turn depends on the one before it."""
    def __init__(self, memory):
        self.memory = memory

    def __call__(self, turns, prompt=False):
        out = ["<bos>"]
        for i, (role, text) in enumerate(turns):
            out.append(f"\n{text}" if i and turns[i - 1][0] == role else f"<{role}>{text}")
        return "".join(out) + ("<assistant>" if prompt and not (turns and turns[-1][0] == "assistant")
                               else "\n" if prompt else "")


class Counted:
    """Says from the third turn on how many there are; states that it does not."""
    memory = 0

    def __call__(self, turns, prompt=False):
        head = f"{len(turns)}:" if len(turns) > 2 else ""
        return head + "".join(f"<{r}>{t}" for r, t in turns) + ("<assistant>" if prompt else "")


@settings(max_examples=300, deadline=None)
@given(TURNS, st.sampled_from([T, Joined(0), Joined(1), Joined(3), Counted()]))
def test_growth_gives_what_whole_prefixes_give(turns, template):
    assert chat.locate(turns, template) == chat.by_prefixes(turns, template, "assistant")


def test_statements_that_hold_are_used_and_others_found_out():
    turns = [("user", "a"), ("user", "b"), ("assistant", "c"), ("assistant", ""), ("user", "d")] * 7
    assert chat.by_growth(turns, T, "assistant", 0) == chat.by_prefixes(turns, T, "assistant")
    assert chat.by_growth(turns, Joined(1), "assistant", 1) == chat.by_prefixes(turns, Joined(1), "assistant")
    assert chat.by_growth(turns, Joined(0), "assistant", 0) is None
    assert chat.by_growth(turns, Counted(), "assistant", 0) is None
    assert chat.locate(turns, Counted()).rewrites


def test_work_is_in_proportion_to_the_turns():
    class Measured(chat.Bracketed):
        rendered = 0

        def __call__(self, turns, prompt=False):
            Measured.rendered += len(turns)
            return super().__call__(turns, prompt)
    turns = [("user", "x" * 100), ("assistant", "</s>" * 25)] * 10_000
    found = chat.locate(turns, Measured())
    assert found.output == T(turns) and len(found.loss) == 10_000 and not found.rewrites
    assert Measured.rendered < 12 * len(turns)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def expected(rows):
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(T(turns)), False)
    return out


def test_edge_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"),
            (2, 5, None, "x"), (2, None, "assistant", "[/INST]</s>"), (None, 0, "user", "lost"),
            (None, 1, "assistant", "found"), (3, 0, "assistant", "long " * 300_000), (4, 0, "", "")]
    df = spark.createDataFrame([(*r, "clash", 7) for r in rows],
                               "conv_id long, turn long, role string, text string, formatted string, start int")
    got = {r[0]: tuple(r)[1:] for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert got == expected(rows)
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    got = {r[0]: tuple(r)[1:] for r in queries.op6_chat_format(spark, d).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    assert got == expected(rows + [(-1, 0, "user", said), (-1, 1, "assistant", said)])
