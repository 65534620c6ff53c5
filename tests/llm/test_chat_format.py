import random

import numpy as np
import pytest

from strata.llm import chat_format
from strata.llm.chat_format import FEATURES, ROLES, Model, decode, format_chats, segments, transfer
from tests.llm.fixtures import HAVE_DATA, as_dicts

TURNS = "conv_id long, turn long, role string, text string, pid int, piece long, number long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, 1) for r in rows], TURNS)


def test_segments_at_markers():
    assert segments("User: hi\nthere\nAssistant: yes\n### Human\nok") == [(2, "hi\nthere"), (3, "yes"), (2, "ok")]
    assert segments("a user: not here") == [(0, "a user: not here")] and segments("") == [(0, "")]
    assert segments("before\n**Bot:** x\n<|im_start|>system\ny") == [(0, "before"), (3, "x"), (1, "y")]


def test_pieces_give_the_path_of_one_pass():
    rng = np.random.default_rng(8)
    for _ in range(20):
        model = Model(rng.random((4, 3)) + 0.01, {f: rng.random((3, n)) + 0.01 for f, n in FEATURES.items()})
        seen = np.stack([rng.integers(0, n, 50) for n in FEATURES.values()], axis=1)
        whole = decode(model, seen, len(ROLES), None)
        cut = [0, 7, 8, 31, 50]
        total = transfer(model, seen[:7])[len(ROLES)]
        sums = [total]
        for a, b in zip(cut[1:-1], cut[2:], strict=True):
            sums.append((sums[-1][:, None] + transfer(model, seen[a:b])[:3]).max(axis=0))
        enter, path = len(ROLES), []
        ends = [whole[b - 1] for b in cut[1:]]
        for a, b, leave in zip(cut[:-1], cut[1:], ends, strict=True):
            path += decode(model, seen[a:b], enter, leave)
            enter = leave
        assert path == whole and int(sums[-1].argmax()) == whole[-1]


def test_decoding_finds_the_best_of_all_paths():
    from itertools import product
    from types import SimpleNamespace

    rng = np.random.default_rng(4)
    n = len(ROLES)
    for size in [1, 2, 3, 5, 6] * 8:
        shown = rng.normal(size=(size, n))
        score = SimpleNamespace(step=rng.normal(size=(n + 1, n)), emissions=lambda seen, shown=shown: shown)
        worth = lambda p, enter: score.step[enter][p[0]] + shown[0][p[0]] + sum(score.step[a][b] + shown[i + 1][b] for i, (a, b) in enumerate(zip(p, p[1:], strict=False)))
        enter = int(rng.integers(n + 1))
        best = max(product(range(n), repeat=size), key=lambda p: worth(p, enter))
        assert tuple(chat_format.decode(score, np.zeros(size), enter, None)) == best
        for leave in range(n):
            ends = [p for p in product(range(n), repeat=size) if p[-1] == leave]
            assert tuple(chat_format.decode(score, np.zeros(size), enter, leave)) == max(ends, key=lambda p: worth(p, enter))
            assert chat_format.transfer(score, np.zeros(size))[enter, leave] == pytest.approx(max(worth(p, enter) for p in ends))


def conversations(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(2, 9)):
            role = ROLES[1 + t % 2]
            rows.append((c, t, role, ("word " * rng.randrange(*((3, 30) if role == "user" else (60, 200)))).strip()))
    return rows


def test_long_conversations_cut_into_pieces(spark, monkeypatch):
    rng = random.Random(2)
    rows = conversations(40) + [(500, t, ROLES[1 + t % 2], "w " * rng.randrange(*((3, 30) if t % 2 == 0 else (60, 200)))) for t in range(400)]
    whole = sorted(map(tuple, format_chats(frame(spark, rows)).collect()))
    monkeypatch.setattr(chat_format, "PIECE", 16)
    pieces = sorted(map(tuple, format_chats(frame(spark, rows)).collect()))
    assert len(whole) == len(rows) and [r[3] for r in pieces if r[0] == 500] == [ROLES[1 + t % 2] for t in range(400)]
    assert sum(a == b for a, b in zip(whole, pieces, strict=True)) >= 0.99 * len(rows)


def test_awkward_rows(spark):
    rows = conversations(30) + [(900, 0, None, None), (900, 0, None, None), (900, 1, "user", ""), (None, None, "user", "hello?"), (None, 2, "tool", "x"),
                                (901, 0, "user", "User: a b\nAssistant: c\nUser: d?"), (902, 5, "assistant", "w " * 50000), (903, 1, "USER", "b"),
                                (903, 1, "user", "a"), (903, 1, "assistant", "a")]
    got = as_dicts(format_chats(frame(spark, rows)))
    by = {(r["conv_id"], r["turn"], r["part"]): r for r in got if r["conv_id"] != 903}
    assert [by[901, 0, i]["role"] for i in range(3)] == ["user", "assistant", "user"]
    assert by[901, 0, 2]["rendered"] == "<|im_start|>user\nd?<|im_end|>"
    assert by[900, 0, 0]["rendered"].endswith("\n<|im_end|>") and (None, None, 0) in by and len([r for r in got if r["conv_id"] == 900]) == 3
    assert len([r for r in got if r["conv_id"] == 903]) == 3 and len(got) == len(rows) + 2  # a row of three segments
    assert format_chats(frame(spark, [])).collect() == []


@pytest.mark.skipif(not HAVE_DATA, reason="driver test data not present")
def test_held_out_roles(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = format_chats(turns).withColumnRenamed("role", "found").join(turns, ["conv_id", "turn"])
    share, n = got.where("crc32(cast(conv_id as string)) % 5 = 0").selectExpr("avg(int(found = role))", "count(*)").first()
    assert n > 50 and share > 0.97
