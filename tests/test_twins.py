"""Every registered query against its SQL twin on the smallest tables."""

from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry
from check_twins import compare, duck

SF = "/root/testdata/sf0.001"
# the smallest recordings have too few windows or epochs for these statistics to be defined
LARGER = {"glm_spectrum": "/root/testdata/sf0.01", "channel_zscore_outliers": "/root/testdata/sf0.01"}
NAMES = list(entry.queries())
TWINS = entry.oracle_sql()
MAY_BE_EMPTY = {"evoked", "bad_by_snr", "bad_segments_gesd", "bad_segments_channelwise", "muscle_zscore", "search_and_page",
                "eog_region_rule", "common_channels", "glm_epochs", "hysteresis_intervals", "bad_by_ransac", "glm_spectrum",
                "annotate_amplitude_channels", "annotate_amplitude", "epoch_zscore_outliers", "exclude_event_ids", "bad_by_psd",
                "find_flips", "overlapping_trees", "window_consistency", "bad_by_correlation", "bad_by_dropout"}


@pytest.fixture(scope="session")
def outcomes(spark):
    queries = entry.queries()

    def one(name):
        try:
            folder = LARGER.get(name, SF)
            df = queries[name](spark, folder)
            if name in TWINS:
                return compare(df, duck(folder).sql(TWINS[name]))
            return None if df.collect() else "EMPTY"
        except Exception as ex:
            return f"{type(ex).__name__}: {str(ex)[:500]}"

    with ThreadPoolExecutor(6) as pool:
        return dict(zip(NAMES, pool.map(one, NAMES)))


@pytest.mark.parametrize("name", NAMES)
def test_query(outcomes, name):
    result = outcomes[name]
    assert result is None or (result == "EMPTY" and name in MAY_BE_EMPTY), result


def test_every_twin_belongs_to_a_query():
    assert set(TWINS) <= set(NAMES)


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) > 10 and {"score", "passed", "alarm"} <= set(rows[0].asDict())
