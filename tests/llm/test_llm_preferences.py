from visitscope.llm import preferences as P
from visitscope.llm.catalog import ORACLE, op5_preference_format

TURNS = "conv_id long, turn long, role string, text string, pair_id int, chosen string"


def shown(turns):
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)


def brute(rows):
    sides = {}
    for conv, turn, role, text in set(rows):
        if conv is not None:
            sides.setdefault(conv // 2, ([], []))[conv % 2].append((2**63 - 1 if turn is None else turn, role or "user", text or ""))
    out = {}
    for pair, (c, r) in sides.items():
        c, r = ([t[1:] for t in sorted(set(s))] for s in (c, r))
        n = 0
        while n < min(len(c), len(r)) and c[n] == r[n]:
            n += 1

        def masked(turns):
            at, spans = 0, []
            for role, text in turns:
                end = at + len(shown([(role, text)]))
                if role == "assistant":
                    spans.append((at + len(f"<|im_start|>{role}\n"), end))
                at = end
            return spans

        out[pair] = (n, shown(c[:n]), shown(c[n:]) if c else None, masked(c[n:]) if c else None,
                     shown(r[n:]) if r else None, masked(r[n:]) if r else None)
    return out


def test_pairs(spark):
    rows = [(0, 0, "system", "s"), (0, 1, "user", "q"), (0, 2, "assistant", "good é😀"), (0, 3, "user", "thanks"),
            (1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "bad"),
            (2, 0, "user", "same"), (2, 1, "assistant", "same"), (3, 0, "user", "same"), (3, 1, "assistant", "same"),
            (4, 0, "user", "alone"), (4, 1, "assistant", "yes"), (7, 0, "user", "only rejected"),
            (8, None, "assistant", "late"), (8, 0, None, None), (9, 0, "user", ""), (9, 0, "user", ""), (9, 1, "user", "x"),
            (None, 0, "user", "lost"), (10, 1, "user", "tie b"), (10, 1, "user", "tie a"), (11, 1, "user", "tie a"),
            (12, 0, "user", "a"), (13, 0, "assistant", "a"), (14, 0, "user", "w " * 20000), (15, 0, "user", "w " * 20000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)
    found = {r.pair_id: (r.prefix_turns, r.prompt, r.chosen, r.chosen_spans and [tuple(s) for s in r.chosen_spans] or r.chosen_spans,
                         r.rejected, r.rejected_spans and [tuple(s) for s in r.rejected_spans] or r.rejected_spans)
             for r in P.format_pairs(P.neighbour_pairs(df)).collect()}
    assert found == brute(rows)
    assert found[0][2][found[0][3][0][0]:found[0][3][0][1]] == "good é😀<|im_end|>\n"
    assert P.format_pairs(P.neighbour_pairs(df.limit(0))).count() == 0


def test_plan_is_native(spark):
    plan = op5_preference_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
    assert "op5_preference_format" in ORACLE


def test_long_conversations(spark):
    rows = [(0, t, "assistant" if t % 3 else "user", "w" * (t % 11)) for t in range(64 * 50 + 7)] + [(1, t, "user", "q") for t in range(64)]
    found = P.format_pairs(P.neighbour_pairs(spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS))).collect()
    assert [(r.prefix_turns, r.prompt, r.chosen, [tuple(s) for s in r.chosen_spans], r.rejected, [tuple(s) for s in r.rejected_spans])
            for r in found] == [brute(rows)[0]]
