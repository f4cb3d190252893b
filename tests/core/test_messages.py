import pytest
from pyspark.sql import functions as F

from millrace.functions import messages as M
from millrace.functions.template import assistant_spans, rendered
from millrace.functions.tokens import FileCounter, PatternCounter
from millrace.operators.adapters import adapt
from millrace.operators.normalize import length_reason, normalized
from millrace.plans.recipe import Source

S, U, A = "system", "user", "assistant"
CASES = [
    (None, "messages_not_list"),
    ([None], "message_not_mapping"),
    ([("tool", "x")], "unsupported_role"),
    ([(None, "x")], "unsupported_role"),
    ([(U, "  ")], "empty_content"),
    ([(A, None)], "empty_content"),
    ([(S, " "), (U, "q"), (A, "a")], "ok"),
    ([(S, None), (U, "q"), (A, "a")], "empty_content"),
    ([(" user ", " q "), (A, "a ")], "ok"),
    ([(U, " "), ("tool", "x")], "empty_content"),
    ([], "missing_user"),
    ([(S, " ")], "missing_user"),
    ([(U, "q")], "missing_assistant"),
    ([(U, "q"), (A, "a"), (U, "q")], "assistant_not_last"),
    ([(U, "q"), (U, "r"), (A, "a")], "ok"),
]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_cleaning_reasons(spark):
    df = frame(spark, [(m,) for m, _ in CASES], "m array<struct<role:string,content:string>>")
    got = [r[0] for r in df.select(M.cleaned(F.col("m"))).collect()]
    assert [g.reason for g in got] == [reason for _, reason in CASES]
    assert [(m.role, m.content) for m in got[6].messages] == [(U, "q"), (A, "a")]
    assert [(m.role, m.content) for m in got[8].messages] == [(U, "q"), (A, "a")]
    assert got[0].messages == []


def test_think_tags(spark):
    rows = [([(U, "<think></think>"), (A, "x")],), ([(A, "<think>"), (A, "y</think>")],), ([(A, "<think>")],)]
    df = frame(spark, rows, "m array<struct<role:string,content:string>>")
    assert [r[0] for r in df.select(M.has_think_tags(F.col("m"))).collect()] == [False, True, False]


def plain_render(messages):
    out, system = "<bos>", ""
    if messages and messages[0][0] == S:
        system, messages = messages[0][1].strip() + "\n\n", messages[1:]
    for i, (role, text) in enumerate(messages):
        if role == A:
            out += f"<start_of_turn>model\n{text.strip()}<end_of_turn>\n"
        elif i == 0 and system:
            out += f"<start_of_turn>user\n{system}{text.strip()}<end_of_turn>\n"
        else:
            out += f"<start_of_turn>{role}\n{text.strip()}<end_of_turn>\n"
    return out


@pytest.mark.parametrize("messages", [
    [(U, " q "), (A, "a")], [(S, "s"), (U, "q"), (A, "a")], [(S, "s"), (A, "a"), (U, "q")], [(S, ""), (U, "q")], [(U, "q"), (S, "late"), (A, "a")], [(S, "only")], [(S, "a"), (S, "b"), (A, "c")],
])
def test_template(spark, messages):
    df = frame(spark, [(messages,)], "m array<struct<role:string,content:string>>")
    text, prompt, spans = df.select(rendered(F.col("m")), rendered(F.col("m"), generation_prompt=True), assistant_spans(F.col("m"))).first()
    assert text == plain_render(messages)
    assert prompt == text + "<start_of_turn>model\n"
    assert spans == [t.strip() + "<end_of_turn>\n" for r, t in (messages[1:] if messages[0][0] == S else messages) if r == A]


OPENR1 = "problem string, input string, messages array<struct<role:string,content:string>>, generations array<string>, is_reasoning_complete array<boolean>, correctness_math_verify array<boolean>, correctness_llama array<boolean>, correctness_count int"
GOOD = [(U, "q"), (A, "old")]


@pytest.mark.parametrize(("row", "reason", "answer"), [
    (("p", None, GOOD, ["x", "y"], [True, True], [False, True], None, 1), "ok", "y"),
    (("p", None, GOOD, ["x"], [True], [True], None, 0), "openr1_unverified", None),
    (("p", None, GOOD, ["x", "y"], [True], [False, True], [], 2), "openr1_unverified", None),
    (("p", None, GOOD, None, None, None, None, 3), "openr1_unverified", None),
    (("p", None, GOOD, [" "], [True], None, [True], 1), "ok", "old"),
    (("p", None, None, [" x "], [True], [True], None, 1), "ok", "x"),
    (("", "i", [], ["x"], [True], [True], None, 1), "ok", "x"),
    ((" ", "i", [], ["x"], [True], [True], None, 1), "missing_user", None),
    ((None, None, None, ["x"], [True], [True], None, 1), "messages_not_list", None),
    (("p", None, GOOD, [None], [True], [True], None, 1), "ok", "None"),
])
def test_openr1(spark, row, reason, answer):
    df = frame(spark, [row], OPENR1)
    got = df.select(adapt("openr1_verified", df)).first()[0]
    assert got.reason == reason
    assert (got.messages[-1].content if got.messages else None) == answer


def test_other_adapters(spark):
    df = frame(spark, [(GOOD, (True,)), (GOOD, (False,)), (GOOD, None), (GOOD, (None,))], "messages array<struct<role:string,content:string>>, quality struct<accepted:boolean>")
    assert [r[0].reason for r in df.select(adapt("accepted_messages", df)).collect()] == ["ok"] + ["quality_not_accepted"] * 3
    assert df.select(adapt("nothing", df)).first()[0].reason == "unknown_adapter"
    bare = frame(spark, [(1,)], "id int")
    assert bare.select(adapt("messages", bare)).first()[0].reason == "messages_not_list"


def test_normalized(spark):
    long = "word " * 70
    rows = [(1, [(U, "Hi"), (A, long)], "de"), (2, [(U, "Hi"), (A, "x" * 127)], None), (3, [(U, "Hi"), (A, "x" * 128)], ""), (4, [(U, "q")], "fr"), (5, [(U, "Hi"), (A, "w " * 400)], "de")]
    df = frame(spark, rows, "id int, messages array<struct<role:string,content:string>>, language string")
    got = {r.id: r for r in normalized(df, Source("s", role="t", require_reasoning_trace=True), 64, 300, keep=("id",)).collect()}
    assert {i: r._reason for i, r in got.items()} == {1: "ok", 2: "reasoning_trace_too_short", 3: "too_short", 4: "missing_assistant", 5: "too_long"}
    assert [got[i].language for i in range(1, 5)] == ["de", "None", "unknown", "fr"]
    assert got[2].token_count == 0 and got[2].messages and got[4].messages == [] and got[4].prompt_hash == "" and got[1]._valid
    absent = normalized(df.drop("language"), Source("s"), 1, 300).first()
    assert absent.language == "unknown"


def test_length_band(spark):
    df = frame(spark, [(63,), (64,), (16384,), (16385,)], "n int")
    assert [r[0] for r in df.select(length_reason(F.col("n"), 64, 16384)).collect()] == ["too_short", "ok", "ok", "too_long"]


def test_counters(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    df = frame(spark, [("Hello, world 12",), (None,), ("",)], "t string").coalesce(1)
    assert [r[0] for r in df.select(PatternCounter().count(F.col("t"))).collect()] == [4, None, 0]
    path = public_tokenizers.path("byte_bpe_50k.json")
    want = len(Tokenizer.from_file(path).encode("Hello, world 12", add_special_tokens=False).ids)
    assert [r[0] for r in df.select(FileCounter(path).count(F.col("t"))).collect()] == [want, None, 0]
