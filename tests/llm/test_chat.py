import random

import pytest

from rowflow.llm import chat

GIVEN = ["system", "user", "assistant", "tool", None]


def cheapest(given):
    """Every way to place the turns."""
    best = []

    def go(k, state, cost, put):
        if k == len(given):
            best.append((cost + chat.ending(state)[0], put + chat.ending(state)[1]))
            return
        for a, b, c, n, _, _ in chat._moves_of(given[k]):
            if a == state:
                go(k + 1, b, cost + c, put + n)

    go(0, 0, 0, 0)
    return min(best)


def spoken(text):
    """Roles of a rendered conversation; it must be legal."""
    roles = [x.split("|>")[0] for x in text.replace(chat.CLOSE, "").split("<|")[1:]]
    rest = roles[1:] if roles[0] == "system" else roles
    assert rest and len(rest) % 2 == 0 and rest == ["user", "assistant"] * (len(rest) // 2)
    assert text.count(chat.CLOSE) == len(roles)
    return roles


def cost_of(given, placed):
    cost = 0
    for role, (new, action, inserted, *_rest, after) in zip(given, placed, strict=True):
        cost += chat._label_cost(role, new) + chat.MERGE * (action == "merge") + chat.INSERT * bool(inserted)
        cost += chat.INSERT * len([r for r in after.split(",") if r])
    return cost


@pytest.mark.parametrize("size", [1, 2, 3, 10])
def test_cheapest_repair_in_chunks_and_in_one_piece(size):
    draw = random.Random(size)
    for _ in range(250):
        given = [draw.choice(GIVEN) for _ in range(draw.randint(1, 6))]
        chunks = [given[k : k + size] for k in range(0, len(given), size)]
        ways = chat.through([chat.summary(c) for c in chunks])
        placed = [p for c, w in zip(chunks, ways, strict=True) for p in chat.place([(r, "text") for r in c], *w)]
        roles = spoken("".join(p[4] for p in placed))
        assert (cost_of(given, placed), len(roles)) == cheapest(given)
        assert [p[3] for p in placed if p[1] != "merge"][-1] + len([r for r in placed[-1][5].split(",") if r]) == len(roles)


def test_legal_conversations_are_left_alone():
    placed = chat.place([("system", "s"), ("user", None), ("assistant", "a")], 0, 3, 0, True)
    assert "".join(p[4] for p in placed) == "<|system|>\ns<|end|>\n<|user|>\n<|end|>\n<|assistant|>\na<|end|>\n"
    assert {p[1] for p in placed} == {"keep"}


def test_table(spark):
    draw = random.Random(8)
    rows = [(c, t, draw.choice(GIVEN), f"{c}:{t}") for c in range(40) for t in range(draw.randint(1, 9))]
    rows += [(500, t, draw.choice(GIVEN[:3]), "x" * (t % 7)) for t in range(700)]  # one long conversation
    rows += [(None, 0, "User", "null id"), (None, 1, None, None), (600, None, "user", "no turn"), (600, 3, "assistant", "first")]
    rows += [(700, 1, "user", "again")] * 3 + [(800, -4, "ASSISTANT", "L" * 100_000)]
    full = [(*r, 1, "x") for r in rows]
    df = spark.createDataFrame(full, "conv_id long, turn long, role string, text string, chunk long, conv string").repartition(5)
    key = lambda r: (r.turn is None, r.turn or 0, r.given_role is None, r.given_role or "")
    results = []
    for chunk in (16, 10_000):
        got = chat.repair_conversations(df, chunk=chunk).collect()
        assert len(got) == len(rows)
        by = {}
        for r in got:
            by.setdefault(r.conv_id, []).append(r)
        for c, rs in by.items():
            rs.sort(key=lambda r: (r.turn_out, r.action == "merge", key(r)))
            text = "".join(r.fragment for r in sorted(rs, key=key))
            assert max(r.turn_out for r in rs) <= len(spoken(text)), c
        results.append(sorted(map(str, got)))
    assert results[0] == results[1]
    assert chat.repair_conversations(df.where("false")).count() == 0
    # Two turns merged and one made an answer cost less than three merged and an answer inserted.
    assert sorted(r.action for r in got if r.conv_id == 700) == ["keep", "merge", "relabel"]


def test_alike_turn_numbers_are_cut_into_chunks(spark, monkeypatch):
    draw = random.Random(9)
    # Null ids, null turns and repeated rows: by their turn numbers all of these are one chunk each.
    rows = [(None, k % 9, draw.choice(GIVEN), draw.choice(["x", None, "y" * 700 + str(k % 3)])) for k in range(2000)]
    rows += [(1, None, "user", f"t{k}") for k in range(300)] + [(2, 4, "assistant", "again")] * 900
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    tables, stored = {}, chat.stored

    def kept(table, purpose):
        tables[purpose] = stored(table, purpose)
        return tables[purpose]

    monkeypatch.setattr(chat, "stored", kept)
    got = chat.repair_conversations(df, chunk=16).collect()
    for conv, n in (("\0", 2000), ("1", 300), ("2", 900)):
        assert tables["summaries"].where(tables["summaries"].conv == conv).count() >= n / 16
    order = lambda t, r, x: (t is None, t or 0, r is None, r or "", x is None, x or "")
    want = []
    for conv in (None, 1, 2):
        turns = sorted((order(t, r, x), t, r, x) for c, t, r, x in rows if c == conv)
        (way,) = chat.through([chat.summary([r for _, _, r, _ in turns])])
        placed = chat.place([(r, x) for _, _, r, x in turns], *way)
        want += [(conv, t, r, *p) for (_, t, r, _), p in zip(turns, placed, strict=True)]
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))
