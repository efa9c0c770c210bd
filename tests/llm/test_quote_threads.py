import pytest

from perennial.llm.quote_threads import TEMPLATE, chat_messages

SCHEMA = "conv_id long, turn long, role string, text string"


def run(spark, rows, schema=SCHEMA):
    return sorted(chat_messages(spark.createDataFrame(rows, schema)).collect(), key=lambda r: (r.conv_id is None, r.conv_id or 0, r.reply_order or 0))


def test_replies_are_ordered_below_what_they_quote(spark):
    rows = [
        (1, 1, "user", "How do I bake bread?\nAnd which flour?"),
        (1, 2, "assistant", "Knead it well."),
        (1, 3, "user", "Thanks."),
        (1, 4, "user", "> And   WHICH flour?\nRye."),
        (1, 5, "assistant", "On Monday A wrote:\n> Knead it well.\n\n> Thanks.\nHow long?"),
        (1, 6, "user", ">> Knead it well.\n> How long?\nTen minutes."),
        (1, 7, "user", "> never said\nHello."),
    ]
    got = run(spark, rows)
    assert [(r.turn, r.parent_turn) for r in got] == [(1, None), (2, 1), (3, 2), (5, 3), (6, 5), (7, 6), (4, 1)] or [
        (r.turn, r.parent_turn) for r in got
    ] == [(1, None), (2, 1), (3, 2), (5, 2), (6, 5), (7, 6), (4, 1)]
    body = {r.turn: r.body for r in got}
    assert body[4] == "Rye." and body[5] == "How long?" and body[6] == "Ten minutes." and body[7] == "Hello."
    assert {r.turn: r.quote_level for r in got} == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 2, 7: 1}
    assert got[0].chat == TEMPLATE.format(role="user", body=rows[0][3])


def brute_order(parents):
    """Depth first; of the answers to a message the one in its own branch comes first."""
    children = {}
    for turn, parent in sorted(parents.items()):
        children.setdefault(parent, []).append(turn)
    out, todo = [], [None]
    while todo:
        now = todo.pop()
        if now is not None:
            out.append(now)
        todo += reversed(children.get(now, []))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_order_is_depth_first(spark, seed):
    import random

    draw, rows, parents = random.Random(seed), [], {}
    for turn in range(40):
        parent = None if not turn else draw.choice([turn - 1, draw.randrange(turn)])
        quote = "" if parent in (None, turn - 1) else f"> line {parent}\n"
        rows.append((9, turn, "user", f"{quote}line {turn}"))
        parents[turn] = parent
    got = run(spark, rows)
    assert {r.turn: r.parent_turn for r in got} == parents
    assert [r.turn for r in got] == brute_order(parents)


def test_common_lines_count_less(spark):
    rows = [(1, 1, "u", "Thanks.\nThe key is red."), (1, 2, "u", "Thanks.\nNo."), (1, 3, "u", "Thanks."), (1, 4, "u", "> Thanks.\n> The key is red.\nYes")]
    assert run(spark, rows)[-1].parent_turn == 1


def test_other_conversations_are_not_quoted(spark):
    rows = [(1, 1, "u", "a line"), (2, 1, "u", "b"), (2, 2, "u", "c"), (2, 3, "u", "> a line\nd")]
    assert [r.parent_turn for r in run(spark, rows)] == [None, None, 1, 2]


def test_odd_rows(spark):
    assert run(spark, []) == []
    schema = SCHEMA + ", body string, branch long, path string"
    rows = [
        (1, 1, None, None, "x", 1, "p"), (1, 1, None, None, "x", 1, "p"), (1, 2, "user", "", "x", 1, "p"),
        (None, 1, "user", "> a", "x", 1, "p"), (1, None, "user", "b", "x", 1, "p"),
        (1, 3, "user", ">\n>>\n" + "long " * 40_000 + "\r\n> quoted\r\nend", "x", 1, "p"),
    ]
    got = run(spark, rows, schema)
    assert len(got) == 6
    by = {(r.conv_id, r.turn): r for r in got}
    assert by[1, 1].role == "unknown" and by[1, 1].body == "" and by[1, 1].reply_order == 1
    assert by[None, 1].reply_order is None and by[1, None].reply_order is None and by[None, 1].body == ""
    assert by[1, 3].quote_level == 2 and by[1, 3].body.endswith("long \nend") and ">" not in by[1, 3].body


def test_quotations_wrapped_elsewhere_and_single_sentences_are_known(spark):
    long = "The oven has to be hot before the bread goes in, or the crust\nstays soft and pale. Use a stone if you have one. Steam helps."
    rows = [
        (1, 1, "u", "Which flour should I take for a dark bread?"),
        (1, 2, "a", long),
        (1, 3, "u", "Something else: my knife is blunt."),
        # Wrapped by the mail program, at two levels of marks.
        (1, 4, "u", "> The oven has to be hot before the bread\n> goes in, or the crust stays soft\n> and pale.\nHow hot?"),
        (1, 5, "a", "Sharpen it."),
        (1, 6, "u", "> Steam helps.\nReally?"),
        (1, 7, "u", "> before the bread goes in, or the\nI see."),
        (1, 8, "u", "> > Which flour should I\n> > take for a dark bread?\nRye."),
        (1, 9, "u", "> nobody ever said these words here\nHello."),
    ]
    parents = {r.turn: r.parent_turn for r in run(spark, rows)}
    assert parents == {1: None, 2: 1, 3: 2, 4: 2, 5: 4, 6: 2, 7: 2, 8: 1, 9: 8}


def test_whole_lines_outweigh_shared_words(spark):
    rows = [
        (1, 1, "u", "I will come at ten on Monday."),
        (1, 2, "u", "If it rains I will come at ten on Monday or not at all."),
        (1, 3, "u", "Fine."),
        (1, 4, "u", "> I will come at ten on Monday.\nGood."),
    ]
    assert {r.turn: r.parent_turn for r in run(spark, rows)}[4] == 1


def test_passages_of_many_lines(spark):
    rows = [(1, 1, "u", "\n".join(f"line number {k}" for k in range(20_000))), (1, 2, "u", "no"),
            (1, 3, "u", "\n".join(f"> line number {k}" for k in range(20_000)))]
    assert {r.turn: r.parent_turn for r in run(spark, rows)} == {1: None, 2: 1, 3: 1}
