"""A stored capture gives the tables of the raw one, and reads only the fields that it needs."""

import re
import tempfile

import pytest

from lakecensus.plans import queries as QM
from lakecensus.plans.pipeline import Inventory
from lakecensus.sources.shredded import shred
from test_plans import SF, plan_of


@pytest.fixture(scope="module")
def both(spark):
    cap = QM.capture(spark, SF)
    path = tempfile.mkdtemp(prefix="lakecensus-shredded-") + "/capture"
    return Inventory(cap), Inventory(shred(cap, path))


def test_all_tables_are_the_same(both):
    raw, stored = (inv.tables() for inv in both)
    for name in raw:
        a, b = raw[name], stored[name]
        assert a.schema == b.schema, name
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())), name


def test_outcomes_and_coverage_are_the_same(both):
    raw, stored = both
    assert raw.coverage() == stored.coverage() and raw.cap.run_ids == stored.cap.run_ids
    columns = raw.cap.light().columns
    assert sorted(map(repr, raw.cap.light().collect())) == sorted(map(repr, stored.cap.light().select(columns).collect()))


def test_extraction_is_pushed_into_the_scan(both):
    cap = both[1].cap
    plan = plan_of(cap.elements("ListReports").selectExpr("try_variant_get(e, '$.name', 'string') AS name"))
    assert "ReadSchema: struct<e:struct<0:string>>" in plan and "parseJson" not in plan
    models = plan_of(Inventory(cap, stage=False).models)
    read = re.search(r"elements/ListDatasets\][^R]*ReadSchema: (\S+)", models.replace("\n", " ")).group(1)
    assert "e:struct<0:" in read  # fields, not the whole value


def test_clean_keeps_the_stored_capture(both):
    stored = both[1].cap
    n = stored.elements("ListReports").count()
    stored.clean()
    assert stored.elements("ListReports").count() == n > 0
