import json
import random

from pyspark.sql import functions as F

from glyphlane.functions import literals as L
from glyphlane.functions import messages as M
from glyphlane.functions import prompts as P
from glyphlane.functions import text as X
from glyphlane.functions.json import strict_json
from glyphlane.operators import agentlog as A
from glyphlane.operators import chat as C
from glyphlane.operators.logformat import convert_cells, plain_answer, plain_messages, printed_messages, tag_answers

from .conftest import first


def test_whitespace_is_pythons():
    assert set(X.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_words_and_strip(spark):
    rnd = random.Random(1)
    rows = [("".join(rnd.choice(list(X.WHITESPACE) + list("abé​ß") * 4) for _ in range(rnd.randint(0, 30))),) for _ in range(1500)]
    c = F.col("s")
    for s, n, w, t in spark.createDataFrame(rows, "s string").select("s", X.word_count(c), X.words(c), X.strip(c)).collect():
        assert n == len(s.split()) and w == s.split() and t == s.strip()


def test_strict_json(spark):
    cells = ["[1] x", "[1]]", "[1]}", '1,"x":2', "[1],[2]", "[1,]", "['a']", "", " [1] ", '{"a":[1,"b"]}', "true", "NaN", "[1"]
    rows = spark.createDataFrame([(c,) for c in cells], "s string").select("s", strict_json(F.col("s")).cast("string").alias("v")).collect()

    def readable(c):
        try:
            json.loads(c)
            return c != "NaN"
        except ValueError:
            return False

    assert {r.s: r.v is not None for r in rows} == {c: readable(c) for c in cells}


def test_message_cells(spark):
    cells = [
        '[{"role":"user","content":"a"},{"role":"tool","content":"x"},{"role":"assistant","content":""}]',
        "[{'role': 'user', 'content': 'it\\'s'}, 5, {'role': 'system', 'content': None}]",
        '[{"role":"user","content":["x", true]}]', '{"role":"user"}', "broken", "", None, "[1] x"]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, messages string")
    got = [[tuple(m) for m in r.parsed] for r in A.parse_messages(rows).orderBy("i").collect()]
    assert got == [[("user", "a")], [("user", "it's")], [("user", "['x', True]")], [], [], [], [], []]


def random_conversations(n=150):
    rnd = random.Random(2)
    return [[(rnd.choice(["system", "user", "assistant"]), rnd.choice(["x", "y <image>", "z"])) for _ in range(rnd.randint(0, 9))] for _ in range(n)]


def plain_turns(messages):
    users = [i for i, (r, _) in enumerate(messages) if r == "user"]
    out, waiting = [], []
    for i, (role, text) in enumerate(messages):
        if role == "system":
            waiting.append(text)
        elif role == "user":
            text, waiting = "\n".join(waiting + [text]), []
            if i == users[-1] and "<image>" not in text:
                text += "\n<image>"
            out.append(("human", text))
        else:
            out.append(("gpt", text))
    return None if (waiting and not users) or not out else out


def test_training_turns_of_records_and_rows(spark):
    convs = random_conversations()
    records = spark.createDataFrame([(i, c) for i, c in enumerate(convs)], f"i int, m {'array<struct<role:string,content:string>>'}")
    got = {r.i: None if r.t is None else [tuple(x) for x in r.t] for r in records.select("i", M.training_turns(F.col("m")).alias("t")).collect()}
    assert got == {i: plain_turns(c) for i, c in enumerate(convs)}
    rows = spark.createDataFrame([(i, t, r, x) for i, c in enumerate(convs) for t, (r, x) in enumerate(c)],
                                 "conv_id int, turn int, role string, text string")
    by_rows = {}
    for r in C.training_turns(rows, with_image=F.lit(True)).orderBy("conv_id", "turn").collect():
        by_rows.setdefault(r.conv_id, []).append((r["from"], r.value))
    assert by_rows == {i: plain_turns(c) for i, c in enumerate(convs) if plain_turns(c)}


def test_conversations_are_folded_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(C, "TURN_BUCKET", 3)
    rnd = random.Random(12)
    convs = [[(rnd.choice(["system", "system", "user", "assistant"]), rnd.choice(["a", "b", "<image> c", ""])) for _ in range(rnd.randint(1, 14))]
             for _ in range(300)]
    rows = spark.createDataFrame([(i, t, r, x) for i, c in enumerate(convs) for t, (r, x) in enumerate(c)],
                                 "conv_id int, turn int, role string, text string")
    got = {}
    for r in C.training_turns(rows, with_image=F.lit(True)).orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r["from"], r.value))
    assert got == {i: plain_turns(c) for i, c in enumerate(convs) if plain_turns(c)}


def test_long_conversation_is_many_blocks(spark):
    n = C.TURN_BUCKET * 2 + 7
    role = F.when(F.col("id") == 0, "system").when(F.col("id") >= C.TURN_BUCKET + 5, F.when(F.col("id") % 2 == 0, "user").otherwise("assistant"))
    rows = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.coalesce(role, F.lit("assistant")).alias("role"), F.lit("t").alias("text"))
    assert C.turn_blocks(rows).count() == 3
    got = {r.turn: (r["from"], r.value) for r in C.training_turns(rows, with_image=F.lit(True)).collect()}
    first_user, last_user = C.TURN_BUCKET + 6, n - 1
    assert len(got) == n - 1 and got[first_user] == ("human", "t\nt") and got[last_user] == ("human", "t\n<image>")
    assert all(v == ("human" if t >= first_user and t % 2 == 0 else "gpt", "t") for t, v in got.items() if t not in (first_user, last_user))


def test_half_signs_never_end_a_job(spark):
    half = "\\ud83d"
    rows = spark.createDataFrame([(f'{{"thinking": "{half}"}}', f"['{half}', 'x']", f"[{{'role': 'user', 'content': '{half}'}}]",
                                   f"[{{'bbox_2d': [1, 2, 3, 4], 'label': '{half}'}}]")], "answer string, texts string, cell string, boxes string")
    r = first(rows.select(L.tagged_answer("answer").alias("answer"), L.strings_from_literal("texts").alias("texts"),
                          L.messages_from_text("cell").alias("messages"), L.boxes_from_literal("boxes").alias("boxes")))
    assert r.answer == "<thinking>\n?\n</thinking>" and r.texts == ["?", "x"]
    assert r.messages[0].content == "?" and r.boxes[0].label == "?"
    cells = spark.createDataFrame([(1, f"[{{'role': 'user', 'content': '{half}'}}, {{'role': 'tool{half}', 'content': ['{half}']}}]")], "i int, messages string")
    got = first(convert_cells(cells))
    assert got.status == "converted" and "'content': '?'" in got.messages
    log = spark.createDataFrame([(1, f"[{{'role': 'user', 'content': '{half}'}}]"), (2, f'[{{"role": "user", "content": "{half}"}}]')], "i int, messages string")
    assert [r.parsed[0].content for r in A.parse_messages(log).orderBy("i").collect()] == ["?", "?"]


def test_catalog_numbers_print_as_in_python(spark):
    defaults = ["1.0", "-0.0", "1.234567895e7", "1e400", "123456789012345678901234567890123456789012", "0.1", "1e-7", "[[1, 2], {}]", '{"a": {"b": [null, "x"]}}',
                "true", '"text"', "5", "null", "9223372036854775807", "-7"]
    cells = [json.dumps({"tools": [{"name": "t", "params": {"p": {"default": "@"}}}]}).replace('"@"', d) for d in defaults]
    rows = spark.createDataFrame(list(enumerate(cells)), "i int, c string").select("i", P.catalog_text(F.col("c")).alias("t")).collect()
    shown = {r.i: r.t.split("(unknown)")[1] for r in rows}
    for i, d in enumerate(defaults):
        value = json.loads(d)
        assert shown[i] == ("" if value is None else f": default: {value}")
    bounds = '{"tools": [{"name": "t", "params": {"p": {"minimum": 0.0, "minLength": 0.5, "maximum": 1e2}}}]}'
    assert first(spark.createDataFrame([(bounds,)], "c string").select(P.catalog_text(F.col("c")))) [0].endswith("p (unknown): range: [0.5, 100.0]")


def test_tagged_answer_worked_example(spark):
    cell = '{"thinking":"t","next_goal":"g","action":[{"wait":{"seconds":3}}]}'
    rows = spark.createDataFrame([(cell,), ("{bad",), ('{"thinking": 3, "memory": "m"}',), ("{}",)], "s string")
    got = [r[0] for r in rows.select(L.tagged_answer("s")).collect()]
    assert got[0] == '<thinking>\nt\n\nNext Goal: g\n</thinking>\n\n<tool_call>\nwait({"seconds": 3})\n</tool_call>'
    assert got[1] == "<thinking>\n{bad\n</thinking>" and got[2].startswith('<thinking>\n{"thinking": 3') and got[3] == ""


def test_plain_answers_are_settled_natively(spark):
    """Every native answer equals Python's, and plain ones don't go to Python."""
    rnd = random.Random(3)
    values = ['"x"', '""', "5", "-3", "0", "true", "null", "1.5", "1e3", "-0", '"a, b: c"', '"é"', '"\\n"', "[1, 2]", '{"b": 1, "a": [true, null, "k:v"]}', "12345678901234567890123"]
    keys = ["thinking", "evaluation_previous_goal", "memory", "next_goal", "other"]
    actions = ['[{"wait": {"seconds": 3}}]', '[ {"b":{"z" : 1,"a":[1,{"q":"r, s"}]}}, {"c": {}, "a": {"t": "ü"}} ]', "[]", '[{"done": "text"}]', '[5, {"a": {}}]', '"no"', "null", '{"a": {}}',
               '[{"a": {"n": 1.0}}]']
    cells = ["[]", '"abc"', "{bad", '{"a":1} x', '{"thinking": "a", "thinking": "b"}', "", " {} ", "5"]
    for _ in range(400):
        fields = [f'"{k}": {rnd.choice(values)}' for k in rnd.sample(keys, rnd.randint(0, 4))]
        if rnd.random() < 0.7:
            fields.append(f'"action": {rnd.choice(actions)}')
        cells.append("{" + rnd.choice([", ", ",", " , "]).join(fields) + "}")
    plain = [f'{{"thinking": "t{i}", "memory": "m", "next_goal": {i}, "action": [{{"click": {{"index": {i}, "text": "a: b"}}}}]}}' for i in range(100)]
    rows = spark.createDataFrame([(c,) for c in cells + plain] + [(None,)], "s string")
    for r in tag_answers(rows.select("s", plain_answer(F.col("s")).alias("n")), "s", "t").collect():
        assert r.t == L._answer_text(r.s) and r.n in (None, r.t), r.s
    native = rows.select(plain_answer(F.col("s")).alias("n"))
    assert native.where("n is not null").count() >= len(plain) + 60


def test_plain_cells_are_settled_natively(spark):
    """Cells read and printed natively equal Python's own reading and printing."""
    rnd = random.Random(8)
    contents = ["look", "a \"b\" c", "é 中", "<browser_state>x</browser_state> y", "", "it\u2019s", "tab\tinside", '{"thinking": "t", "action": [{"wait": {"s": 3}}]}', "{}", "\x7f", "\xa0"]
    cells = ["[]", "[{'role': 'user'}]", "[{'role': 'user', 'content': 5}]", "[{'content': 'a', 'role': 'user'}]", "oops", "[{'role': 'tool', 'content': 'x'}]",
             "[{'role': 'user', 'content': 'a' 'b'}]", "[{'role': 'user', 'content': 'a'},]", "[ {'role': 'user', 'content': 'a'}]", "[{'role': 'user', 'content': \"it's\"}]",
             "[{'role': 'user', 'content': 'a\\\\n'}]", "{'role': 'user', 'content': 'a'}", "[{'role': 'user', 'content': 'a'}, {'role': 'user', 'content': 'b}, {'}]"]
    for _ in range(200):
        said = [(rnd.choice(["user", "assistant", "system"]), rnd.choice(contents)) for _ in range(rnd.randint(1, 4))]
        cells.append("[" + rnd.choice([", ", ","]).join(f"{{'role': '{r}', 'content': '{c}'}}" for r, c in said) + "]")
    rows = spark.createDataFrame(list(enumerate(cells)), "i int, c string")
    plain = {r.i: r.p for r in rows.select("i", plain_messages(F.col("c")).alias("p")).collect()}
    for i, cell in enumerate(cells):
        if plain[i] is not None:
            assert [(m.role, m.content) for m in plain[i]] == [(m["role"], m["content"]) for m in L._written(cell)], cell
    assert sum(p is not None for p in plain.values()) > 80
    lists = [[(rnd.choice(["user", "it's"]), "".join(rnd.choice(["a", "'", '"', "\n", "\t", "\r", "é", "中", "\\", "\u200b", " "]) for _ in range(rnd.randint(0, 6))))] for _ in range(300)]
    frame = spark.createDataFrame([(i, [(r, c, None) for r, c in m]) for i, m in enumerate(lists)], "i int, m array<struct<role:string,content:string,as_is:string>>")
    shown = {r.i: r.s for r in frame.select("i", printed_messages(F.col("m")).alias("s")).collect()}
    for i, m in enumerate(lists):
        assert shown[i] in (None, repr([{"role": r, "content": c} for r, c in m]))
    assert sum(s is not None for s in shown.values()) > 80


def test_converted_cells_keep_unreadable_ones(spark):
    rows = spark.createDataFrame([(1, "[{'role': 'tool', 'content': 'x'}]"), (2, "oops"), (3, None)], "i int, messages string")
    got = {r.i: (r.messages, r.status) for r in convert_cells(rows).collect()}
    assert got == {1: ("[{'role': 'tool', 'content': 'x'}]", "converted"), 2: ("oops", "kept"), 3: ("[]", "kept")}


def test_media_marks(spark):
    r = first(spark.range(1).select(C.media_marks(F.lit(2), F.lit(1), numbered=True).alias("n"), C.media_marks(F.lit(1), F.lit(0)).alias("p")))
    core = "<|vision_start|><|{}_pad|><|vision_end|>"
    assert r.n == "Picture 1: " + core.format("image") + "Picture 2: " + core.format("image") + "Video 1: " + core.format("video")
    assert r.p == core.format("image")


def test_heavy_cells_use_all_cores(spark):
    """A file of one split is dealt out before its answers are read."""
    from glyphlane.plans import load_queries
    from glyphlane.plans.registry import Tables
    built = load_queries()["converted_cells"].build(Tables(spark, "/root/testdata/sf0.001"))
    assert "RoundRobinPartitioning(" in built._jdf.queryExecution().executedPlan().toString()
