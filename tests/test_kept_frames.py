"""Queries that read a frame several times run its joins once."""

import pytest

from tripmart.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "name, step", [
        ("fact_identity", "assign_identities"),
        ("replace_partition_swapped", "swap"),
        ("scan_drifting_months", "write_bronze"),
        ("mart_zones_from_partials", "write_bronze"),
    ],
)
def test_steps_read_a_kept_frame(spark, monkeypatch, name, step):
    own, read = getattr(catalog, step), []

    def spy(*args, **more):
        read.extend(f for df in args if hasattr(df, "inputFiles") for f in df.inputFiles())
        return own(*args, **more)

    monkeypatch.setattr(catalog, step, spy)
    catalog.QUERIES[name](spark, SF).collect()
    assert read
    assert not [f for f in read if "lineitem" in f]
