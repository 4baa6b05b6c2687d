"""Properties of the statistics on the generated tables."""

from __future__ import annotations

import pytest

from conftest import SF001
from helpers import stats_dict
from visitscope.constants import STEP_BANDS, VISIT_BANDS
from visitscope.operators.filters import FilterSpec
from visitscope.operators.rollup import session_core
from visitscope.plans.job import session_stats
from visitscope.sources.tables import FrameSource
from visitscope.sources.testdata import GeneratedSource

LO, HI = "2024-01-05", "2024-01-11"


@pytest.fixture(scope="module")
def src(spark):
    return GeneratedSource(spark, SF001)


@pytest.fixture(scope="module")
def base(src):
    return stats_dict(session_stats(src, LO, HI))


def test_band_sums(src, base):
    sessions = session_core(src.actions(LO, HI))
    zero = sessions.where("visit_length = 0").count()
    assert sum(base[b[0]] for b in STEP_BANDS) == base["session_count"]
    assert sum(base[b[0]] for b in VISIT_BANDS) == base["session_count"] - zero


def test_measured_counts(base):
    # FIXTURES.md section 2: 181 sessions at sf0.001 for 2024-01-05 .. 2024-01-11.
    assert base["session_count"] == 181


# FIXTURES.md section 2, "Measured band coverage (whole table, no filters)":
# sessions, zero-second sessions, the nine visit bands, the six step bands.
WHOLE_TABLE = {
    "sf0.001": (713, 597, [0, 0, 0, 1, 2, 9, 12, 17, 75], [677, 23, 9, 4, 0, 0]),
    "sf0.01": (3980, 2595, [5, 5, 12, 40, 60, 226, 396, 192, 449], [3580, 230, 25, 115, 8, 22]),
    "sf0.1": (9425, 365, [12, 8, 7, 85, 108, 710, 7260, 0, 870], [2635, 4326, 1411, 699, 204, 150]),
}


@pytest.mark.parametrize("sf", sorted(WHOLE_TABLE))
def test_whole_table_bands_match_fixtures(spark, sf):
    sessions, zero, visit, step = WHOLE_TABLE[sf]
    got = stats_dict(session_stats(GeneratedSource(spark, f"/root/testdata/{sf}"), "2024-01-01", "2024-01-31"))
    assert got["session_count"] == sessions
    assert [got[b[0]] for b in VISIT_BANDS] == visit
    assert [got[b[0]] for b in STEP_BANDS] == step
    assert sessions - sum(visit) == zero


@pytest.mark.parametrize("spec", [
    FilterSpec.of(start_age=10, end_age=40),
    FilterSpec.of(sex="male"),
    FilterSpec.of(keywords="kw1,kw2,kw3"),
    FilterSpec.of(category_ids=[str(i) for i in range(50)]),
    FilterSpec.of(start_age=10, end_age=40, keywords="kw1,kw2,kw3", sex="female"),
])
def test_filters_never_add_sessions(src, base, spec):
    got = stats_dict(session_stats(src, LO, HI, spec))
    for metric, cnt in got.items():
        assert cnt <= base[metric], metric


def test_partitioning_does_not_change_result(spark, src, base):
    for n in (1, 37):
        actions = src.actions(LO, HI).repartition(n)
        frame = FrameSource(actions, src.users())
        # FrameSource re-applies the date filter on the typed `date` column
        assert stats_dict(session_stats(frame, LO, HI)) == base


# FIXTURES.md section 2: session_count for 2024-01-05 .. 2024-01-11 under each filter.
_SEGMENTS = "AUTOMOBILE,BUILDING,FURNITURE"
_NATIONS = ",".join(sorted(f"NATION_{i}" for i in range(25))[:15])
FILTER_COUNTS = [
    (FilterSpec(), 181, 907),
    (FilterSpec.of(start_age=10, end_age=40), 50, 474),
    (FilterSpec.of(sex="male"), 102, 457),
    (FilterSpec.of(professionals=_SEGMENTS), 103, 519),
    (FilterSpec.of(cities=_NATIONS), 164, 701),
    (FilterSpec.of(keywords="kw1,kw2,kw3"), 11, 93),
    (FilterSpec.of(category_ids=[str(i) for i in range(50)]), 25, 165),
    (FilterSpec.of(start_age=10, end_age=40, professionals=_SEGMENTS, cities=_NATIONS,
                   keywords="kw1,kw2,kw3"), 1, 18),
]


@pytest.mark.parametrize("spec,at_001,at_01", FILTER_COUNTS)
def test_filter_counts_match_fixtures(spark, spec, at_001, at_01):
    for sf, want in (("sf0.001", at_001), ("sf0.01", at_01)):
        src = GeneratedSource(spark, f"/root/testdata/{sf}")
        assert stats_dict(session_stats(src, LO, HI, spec))["session_count"] == want, sf
