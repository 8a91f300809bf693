"""The constants that queries and their SQL twins share, against the specified distribution."""

from collections import Counter

import pytest

from netload.plans import catalog
from netload.sources import synthetic, tables


def test_event_names_of_each_level():
    assert {level: len(names) for level, names in tables.EVENTS.items()} == {"INFO": 5, "WARN": 4, "ERROR": 4}
    assert len({name for names in tables.EVENTS.values() for name in names}) == 13
    assert tables.HOT_SHARE_PERCENT == 21


def test_sectors_and_hours():
    sectors = synthetic.SECTORS
    assert (sum(s.poids for s in sectors), sectors[0].poids, sum(s.cellules for s in sectors)) == (100, 34, 87)
    assert Counter(s.techno for s in sectors) == {"5G": 5, "4G": 7}
    hours = synthetic.HOUR_WEIGHTS
    assert len(hours) == 24 and max(hours) == hours[18] == 2.4 and sum(hours) == pytest.approx(31.2)


def test_level_probabilities_give_the_expected_shares():
    dense = synthetic.SECTORS[0].poids / 100
    for (inside, elsewhere), share in ((synthetic.P_ERROR, 0.018), (synthetic.P_WARN, 0.084)):
        assert dense * inside + (1 - dense) * elsewhere == pytest.approx(share, abs=5e-4)


def test_arithmetic_draws_are_independent():
    constants = catalog.DRAW_CONSTANTS.values()
    assert len(set(constants)) == len(catalog.DRAW_CONSTANTS)
    assert all(factor % catalog.DRAW_MODULUS for factor, _ in constants)
