"""Random small tables against a plain-Python computation of the same definitions."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import DAY, action, stats_dict, source, user
from visitscope.constants import SESSION_COUNT, STEP_BANDS, VISIT_BANDS
from visitscope.operators.filters import FilterSpec
from visitscope.operators.rollup import session_records
from visitscope.plans.job import filtered_sessions, session_stats

KEYWORDS = ["火锅", "新辣道鱼火锅", "a", "b", ""]
CITIES = ["c1", "c2", None]
PROFS = ["p1", "p2"]


def _time(sec: int) -> str:
    t = dt.datetime(2018, 4, 9) + dt.timedelta(seconds=sec)
    return f"{t:%Y-%m-%d} {t.hour}:{t:%M:%S}"


action_st = st.tuples(
    st.sampled_from(["hot", "s1", "s2", "s3", "s4", "s5"]),  # session
    st.integers(0, 6),                                        # user
    st.integers(0, 7200),                                     # second of day
    st.sampled_from(KEYWORDS + [None, None]),
    st.one_of(st.none(), st.integers(0, 12)),
)

spec_st = st.builds(
    FilterSpec.of,
    start_age=st.one_of(st.none(), st.integers(0, 60)),
    end_age=st.one_of(st.none(), st.integers(20, 90)),
    professionals=st.one_of(st.none(), st.sampled_from(["p1", "p1,p2", "p3"])),
    cities=st.one_of(st.none(), st.sampled_from(["c1", "c1,c2"])),
    sex=st.one_of(st.none(), st.sampled_from(["male", "female", ""])),
    keywords=st.one_of(st.none(), st.sampled_from(["火锅", "a,b", "zzz"])),
    category_ids=st.one_of(st.none(), st.sampled_from(["1,2,3", "7", "11,12"])),
)


def _expected(actions, users, spec):
    sessions = {}
    for sid, uid, sec, kw, cat in actions:
        s = sessions.setdefault(sid, {"users": [], "secs": [], "kws": set(), "cats": set()})
        s["users"].append(uid)
        s["secs"].append(sec)
        if kw:
            s["kws"].add(kw)
        if cat is not None:
            s["cats"].add(cat)
    by_user = {}
    for u in users:
        by_user.setdefault(u.user_id, []).append(u)

    def profile_ok(u):
        if spec.has_age_range and not (u.age is not None and spec.start_age <= u.age <= spec.end_age):
            return False
        if spec.professionals and u.professional not in spec.professionals:
            return False
        if spec.cities and u.city not in spec.cities:
            return False
        if spec.sex is not None and u.sex != spec.sex:
            return False
        return True

    passed = []
    for sid, s in sessions.items():
        if spec.keywords and not (s["kws"] & set(spec.keywords)):
            continue
        if spec.category_ids and not ({str(c) for c in s["cats"]} & set(spec.category_ids)):
            continue
        owner = min(s["users"])
        for u in by_user.get(owner, []):
            if profile_ok(u):
                passed.append((sid, max(s["secs"]) - min(s["secs"]), len(s["secs"])))
    counts = {SESSION_COUNT: len(passed)}
    for name, lo, hi in VISIT_BANDS:
        counts[name] = sum(1 for _, v, _ in passed if v >= lo and (hi is None or v <= hi))
    for name, lo, hi in STEP_BANDS:
        counts[name] = sum(1 for _, _, n in passed if n >= lo and (hi is None or n <= hi))
    return counts, sorted(p[0] for p in passed), sessions


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(
    st.lists(action_st, min_size=0, max_size=60),
    st.lists(st.tuples(st.integers(0, 6), st.integers(0, 80), st.sampled_from(PROFS),
                       st.sampled_from(CITIES), st.sampled_from(["male", "female"])),
             min_size=0, max_size=9),
    spec_st,
    st.sampled_from([1, 3, 16]),
)
def test_stats_and_filters_match_brute_force(spark, actions, user_rows, spec, partitions):
    # a third of the rows or more land in one session ("hot") by construction
    actions = actions + [("hot", a[1], a[2], a[3], a[4]) for a in actions[: len(actions) // 2]]
    rows = [action(sid, uid, _time(sec), keyword=kw, category=cat) for sid, uid, sec, kw, cat in actions]
    users = [user(uid, age=age, professional=p, city=c, sex=sx) for uid, age, p, c, sx in user_rows]
    src = source(spark, rows, users, partitions=partitions)
    want_counts, want_ids, sessions = _expected(actions, users, spec)

    assert stats_dict(session_stats(src, DAY, DAY, spec)) == want_counts
    got_ids = sorted(r["session_id"] for r in filtered_sessions(src, DAY, DAY, spec).collect())
    assert got_ids == want_ids

    rec = {r["session_id"]: r for r in session_records(src.actions(DAY, DAY)).collect()}
    assert set(rec) == set(sessions)
    for sid, s in sessions.items():
        assert rec[sid]["search_keywords"] == sorted(s["kws"])
        assert rec[sid]["click_category_ids"] == sorted(s["cats"])
        assert rec[sid]["step_length"] == len(s["secs"])
        assert rec[sid]["visit_length"] == max(s["secs"]) - min(s["secs"])
        assert rec[sid]["user_id"] == min(s["users"])
