import numpy as np
import pytest

from twinsieve import Banding, choose_banding
from twinsieve.functions.lsh import expected_error


@pytest.mark.parametrize(
    "threshold, num_perm, bands, rows, error",
    [
        (0.7, 256, 25, 10, 0.032013),
        (0.5, 128, 25, 5, 0.043737),
        (0.7, 128, 14, 9, 0.036254),
        (0.8, 256, 17, 15, 0.024936),
        (0.7, 64, 8, 8, 0.042318),
    ],
)
def test_known_choices(threshold, num_perm, bands, rows, error):
    assert choose_banding(threshold, num_perm) == Banding(bands, rows)
    assert expected_error(threshold, bands, rows) == pytest.approx(error, abs=1e-6)


def test_error_is_the_area(threshold=0.6, bands=9, rows=7):
    s = np.linspace(0, 1, 200_001)
    match = 1 - (1 - s**rows) ** bands
    below = np.trapezoid(np.where(s <= threshold, match, 0), s)
    above = np.trapezoid(np.where(s >= threshold, 1 - match, 0), s)
    expected = 0.3 * below + 0.7 * above
    assert expected_error(threshold, bands, rows, 0.3, 0.7) == pytest.approx(expected, abs=1e-5)


def test_one_missing_number_recomputes_both():
    assert choose_banding(0.7, 256, bands=3) == Banding(25, 10)
    assert choose_banding(0.7, 256, rows=3) == Banding(25, 10)
    assert choose_banding(0.7, 256, 3, 4) == Banding(3, 4)


def test_ties_go_to_the_smallest():
    assert choose_banding(0.5, 16, fp_weight=0.0, fn_weight=0.0) == Banding(1, 1)


@pytest.mark.parametrize("args", [(0.7, 16, 4, 5), (0.7, 16, 0, 5), (1.5, 16), (0.7, 0)])
def test_bad_input(args):
    with pytest.raises(ValueError):
        choose_banding(*args)
