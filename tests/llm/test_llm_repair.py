"""Conversation repair against a brute-force search over edit scripts."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from visitscope.llm import conversation_repair as R
from visitscope.llm.catalog import QUERIES

COLUMNS = "conv_id long, turn long, role string, text string, state int, part long"
SEEN = re.compile(r"[^\x20\x09-\x0D]")


def shown(x):
    return " " if x is None else str(x)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub(r"[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def cheapest(rows, faults):
    """(least cost, ASCII-least edits, repaired rows) over the graph of (rows read, last initial)."""
    # Of the initials so far only the last one decides what may follow.
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}
    layer = {"": (0, "", ())}
    for i in range(len(rows) + 1):
        for _ in range(4):  # made-up turns, until nothing improves
            for last, (cost, edits, out) in list(layer.items()):
                for new in ("user", "assistant"):
                    if new[0] in legal[last]:
                        offer = (cost + 2, edits + "I", out + (f"{new}:",))
                        if new[0] not in layer or offer[:2] < layer[new[0]][:2]:
                            layer[new[0]] = offer
        if i == len(rows):
            break
        role, text = rows[i][2], rows[i][3]
        options = []
        for last, (cost, edits, out) in layer.items():
            options.append((last, cost + 3, edits + "D", out))
            if faults[i] not in ("blank", "duplicate"):
                extra = 1 if faults[i] == "truncated" else 0
                if role[:1] and role[0] in legal[last]:
                    options.append((role[0], cost + extra, edits + "K", out + (f"{role}:{text}",)))
                for new in ("user", "assistant"):
                    if new[0] in legal[last]:
                        options.append((new[0], cost + 2 + extra, edits + "R", out + (f"{new}:{text}",)))
        layer = {}
        for after, *offer in options:
            if after not in layer or tuple(offer[:2]) < layer[after][:2]:
                layer[after] = tuple(offer)
    ends = [layer[k] for k in ("", "a") if k in layer]
    final = min(ends, key=lambda t: t[:2])
    assert re.fullmatch(r"(s?(ua)+)?", "".join(line[0] for line in final[2]))
    return final


def brute(rows):
    found = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in damaged(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults = set(), []
        for _, _, role, text in mine:
            solid = SEEN.findall(text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen
                          else "truncated" if solid[-1] not in ".!?" else "none")
            seen.add((role, text))
        turns = {r[1] for r in mine} - {None}
        pairs = [(a[2][:1] + b[2][:1]) for a, b in zip(mine, mine[1:], strict=False)]
        cost, audit, out = cheapest(mine, faults)
        found[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                       sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())
    return found


def answer(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def random_rows(seed, conversations, most):
    rnd, rows = random.Random(seed), []
    texts = ["Hi.", "Hi", "", " \t", "What? ", "No!\n", "a.b", "é!", None, "x" * 300 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User", "superuser"]
    for conv in range(conversations):
        for turn in range(rnd.randint(1, most)):
            rows.append((conv, rnd.choice([turn, turn, turn, turn + 2, None]), rnd.choice(roles), rnd.choice(texts)))
    return rows


@pytest.mark.parametrize("chunk", [1 << 20, 2])
def test_random_conversations(spark, monkeypatch, chunk):
    monkeypatch.setattr(R, "CHUNK", chunk)
    rows = random_rows(chunk, 150, 9) + [(None, t, "user", "Null id.") for t in range(9)] + [(-5, 2**60, "assistant", "Far.")]
    rows += rows[:20]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], COLUMNS).repartition(5)
    assert answer(R.repair(R.damage(df))) == brute(rows)


def test_one_long_conversation_across_batches(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 700)
    rnd = random.Random(5)
    rows = [(1, t, rnd.choice(["user", "assistant"]), f"text {t}" + rnd.choice(["", "."])) for t in range(2500)]
    rows += [(2, 0, "user", "y" * 3_000_000 + "."), (2, 1, "assistant", "Z.")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], COLUMNS)
    assert answer(R.repair(R.damage(df))) == brute(rows)


def test_undamaged_rows_and_known_edits(spark):
    rows = [(1, 0, "user", "A."), (1, 1, "assistant", "B."), (2, 0, "user", "A."), (2, 1, "user", "C."), (3, 0, "tool", "")]
    found = answer(R.repair(R.as_rows(spark.createDataFrame([(*r, 1, 2) for r in rows], COLUMNS))))
    assert found[1][5:7] == (0, "KK") and found[2][5:7] == (2, "KR") and found[3][5:7] == (3, "D")
    assert found[3][7] == hashlib.sha256(b"").hexdigest()


def test_empty_table(spark):
    assert R.repair(R.damage(spark.createDataFrame([], COLUMNS))).count() == 0


def test_query_on_generated_conversations(spark):
    path = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"select conv_id, turn, role, text from read_parquet('{path}/conversations.parquet')").fetchall()
    assert answer(QUERIES["op13_conversation_repair"](spark, path)) == brute(rows)
