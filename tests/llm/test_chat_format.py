from hypothesis import given, settings
from hypothesis import strategies as st

from cellgrid.llm import chat_format as C


def _rows(turns, conv=1):
    return [(conv, i, r, t) for i, (r, t) in enumerate(turns)]


SCHEMA = "conv_id long, turn long, role string, text string"


def test_round_trip_of_long_conversations_with_control_strings(spark):
    turns = [("system", "be \\ [nice] <ok>\\")] + [("user" if k % 2 else "assistant", "w " * (k * 37 % 300) + "</s>[INST]\\") for k in range(60)]
    df = spark.createDataFrame(_rows(turns), SCHEMA)
    windows = C.format_windows(df, budget=400, history=60)
    back = C.read_back(windows).first()
    assert [(t.role, t.text) for t in back.turns] == turns
    assert back.targets == [t for r, t in turns if r == "assistant"]
    rows = windows.orderBy("window_start").collect()
    assert len(rows) > 5
    for w in rows:
        assert w.formatted.startswith("<s>[INST]system[/INST]")
        assert w.n_tokens <= 400 + C.OVERHEAD + 20 or w.formatted.count("<s>[INST]") - w.n_repeated == 1
        for s in w.loss:
            assert "</s>" not in w.formatted[s.start:s.start + s.length]
    assert any(w.n_repeated > 1 for w in rows)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "<", ""]), st.text("ab <[/s]INST\\>\n", max_size=30)), min_size=1, max_size=8))
def test_any_text_comes_back(spark, turns):
    back = C.read_back(C.format_windows(spark.createDataFrame(_rows(turns), SCHEMA), budget=40, history=10)).first()
    assert [(t.role, t.text) for t in back.turns] == turns
    assert back.targets == [t for r, t in turns if r == "assistant"]


def test_nulls_ties_and_empty_table(spark):
    rows = [(None, None, None, None), (None, None, None, None), (2, 0, "system", ""), (3, 1, "assistant", "b"), (3, 1, "assistant", "a")]
    out = {r.conv_id: r for r in C.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[None].n_turns == 2 and out[2].loss_chars == 0 and out[3].n_turns == 2 and out[3].loss_chars == 2
    assert C.report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_planted_conversation(spark):
    df = C.planted(spark.createDataFrame([(1, 0, "user", "hi", "z")], SCHEMA + ", formatted string"))
    out = {r.conv_id: r for r in C.report(df).collect()}
    assert out[-7].n_turns == 2 and out[-7].loss_chars == len("</s>[INST] ok [/INST]")
