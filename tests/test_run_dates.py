import datetime as dt

import pytest

from kabuto.__main__ import dates_from, parse_args
from kabuto.sources.schemas import RunDates

D = dt.date.fromisoformat
BASE = ["--raw", "r", "--seeds", "s", "--tables", "t"]


def test_defaults_follow_the_as_of_date():
    r = RunDates(D("2024-01-28"))
    assert (r.update_from, r.history_from) == (D("2024-01-26"), D("2024-01-01"))
    assert RunDates.for_run_day(D("2024-01-29")) == r
    b = RunDates.backfill(D("2020-01-01"), D("2024-12-31"))
    assert (b.history_from, b.update_from, b.as_of) == (D("2019-11-22"), D("2020-01-01"), D("2024-12-31"))
    assert RunDates(D("2024-12-31"), D("2020-01-01")).history_from == D("2019-12-07")
    for history in ("2024-02-01", "2024-01-01"):  # history must begin before the first date written
        with pytest.raises(ValueError):
            RunDates(D("2024-01-01"), D("2023-12-31"), history_from=D(history))


def test_command_line_dates():
    assert dates_from(parse_args(BASE + ["--run-day", "2024-01-29"])) == RunDates(D("2024-01-28"))
    r = dates_from(parse_args(BASE + ["--as-of", "2024-12-31", "--update-from", "2020-01-01", "--history-from", "2019-11-22"]))
    assert r == RunDates.backfill(D("2020-01-01"), D("2024-12-31"))
    r = dates_from(parse_args(BASE + ["--run-day", "2024-01-29", "--update-from", "2024-01-20"]))
    assert (r.as_of, r.update_from, r.history_from) == (D("2024-01-28"), D("2024-01-20"), D("2023-12-26"))
