"""Spans of long conversations, of templates that reach back, and of texts that hold private-use characters."""

from roadmetrics.llm import chat_format

TALKS = "conv_id bigint, turn bigint, role string, text string, segment string, turn_no string"


def test_local_template_equals_whole_prefixes():
    whole = lambda turns: chat_format.inst_template(turns)
    local, full = chat_format.Incremental(chat_format.inst_template), chat_format.Incremental(whole)
    for i in range(700):
        turn = ("user", "assistant", "system", "tool]")[i % 4], f"text {i}  [INST]" * (i % 3)
        got = local.add(*turn)
        assert got == full.add(*turn)
        assert chat_format.unescape(got[0][got[1] : got[2]]) == turn[1]


def test_rewriting_far_back_is_seen(spark):
    def counted(turns):
        return ("odd" if len(turns) > 900 else "even") + "".join(f"<{r}:{t}>" for r, t in turns)

    rows = [(1, i, "user", f"t{i}", "s", "n") for i in range(905)] + [(2, 0, "user", "t", "s", "n")]
    out = chat_format.format_conversations(spark.createDataFrame(rows, TALKS), counted)
    assert [(r.conv_id, r.turn_no) for r in out.filter("rewrites_history").collect()] == [(1, 900)]


def test_the_text_is_found_whatever_the_role_holds(spark):
    roles = ["\u241f", "\ue000", "\ue000\ue001", "plain"]
    rows = [(1, i, r, f"said \ue000 \ue002 {r}", "s", "n") for i, r in enumerate(roles)]
    got = chat_format.format_conversations(spark.createDataFrame(rows, TALKS)).orderBy("turn_no").collect()
    assert [chat_format.unescape(r.segment[r.text_start : r.text_end]) for r in got] == [x[3] for x in rows]


def test_very_long_text_and_conversation(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", "x" * (3_000_000 if i == 7 else 5), "s", "n") for i in range(5000)]
    row = chat_format.read_back(chat_format.format_conversations(spark.createDataFrame(rows, TALKS))).first()
    assert (row.n_turns, row.loss_chars, row.formatted_chars) == (5000, 2500 * 5, 3 + 2500 * 4 + 2500 * 15 + 4999 * 5 + 3_000_000)


def test_whole_prefixes_whatever_a_template_states(monkeypatch):
    """A template that numbers its turns but states that it is local; the query doesn't rely on such statements."""
    from roadmetrics.llm import queries

    lengths = []

    def numbered(turns):
        lengths.append(len(turns))
        return "".join(f"{i}{r}:{t};" for i, (r, t) in enumerate(turns))

    numbered.reach = 0
    state = chat_format.Incremental(numbered, whole=True)
    assert [state.add("user", f"t{i}")[0] for i in range(3)] == ["0user:t0;", "1user:t1;", "2user:t2;"] and max(lengths) == 3
    given = {}
    monkeypatch.setattr(chat_format, "format_conversations", lambda rows, *a, **k: given.update(k) or rows)
    monkeypatch.setattr(chat_format, "read_back", lambda rows: rows)
    monkeypatch.setattr(queries, "_table", lambda spark, d, n: spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string"))

    class Frame:
        def select(self, *a):
            return self

        unionByName = select  # noqa: N815

    class Session:
        def createDataFrame(self, *a):  # noqa: N802
            return Frame()

    queries.op9_format_chat(Session(), "")
    assert given == {"whole": True}
