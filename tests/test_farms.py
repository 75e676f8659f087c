"""Several farms in one run."""

import pytest

from millrace.catalogue import DERIVATIONS, SHARED, SPECS
from millrace.plans.run import run, unbalanced
from millrace.sources import TargetStore
from tests.farm import build

NEEDED = (
    "Breeds Diseases Drugs Cattle Weighing_Events Pens_File Treatment_Regimes Purchase_Lots RationNames Ration_Load_Sizes".split()
)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    from tests.conftest import Frames

    tables = {}
    for (name, group), df in build(spark).items():
        if name in NEEDED:
            tables[(name, group, "north")] = df
            tables[(name, group, "south")] = df.drop("Notes") if name != "Weighing_Events" else df.where("ID < 3").drop("P8_Fat")
    del tables[("Pens_File", "feed", "south")]
    source = Frames(tables)
    store = TargetStore(spark, str(tmp_path_factory.mktemp("farms")))
    specs = [s for s in SPECS if s.source in NEEDED]
    log = run(spark, specs, source, store, farms=["north", "south"], shared=SHARED, derivations=DERIVATIONS, run_id=1)
    assert rows(log.where("status = 'failed'"), "source_table", "error_details") == []
    assert unbalanced(log).count() == 0
    return store


def test_keys_stay_within_the_farm(store):
    cows = store.read("cattle.cows")
    assert rows(cows, "farm", "legacy_beast_id") == [(f, b) for f in ("north", "south") for b in (100, 101, 105)]
    assert len(set(rows(cows, "id"))) == 6
    ids = {(r["farm"], r["legacy_beast_id"]): r["id"] for r in cows.collect()}
    got = rows(store.read("weighing.weighing_events").where("beastid IS NOT NULL"), "farm", "beast_id", "cow_id")
    north, south = ids[("north", 100)], ids[("south", 100)]
    assert got == sorted([("north", north, north)] * 2 + [("south", south, south)], key=str)


def test_unique_names_hold_per_farm(store):
    assert rows(store.read("health.diseases"), "farm", "name") == [(f, n) for f in ("north", "south") for n in ("BRD", "Lame")]
    assert rows(store.read("health.drugs"), "farm", "name")[1] == ("north", "Draxxin")


def test_missing_pens_per_farm(store):
    pens = {(r["farm"], r["name"]): r["id"] for r in store.read("pen.pens").collect()}
    assert pens[("north", "P01")] == 7 and ("south", "P01") in pens
    assert rows(store.read("cattle.cows").where("legacy_beast_id = 101"), "farm", "pen_id") == [
        ("north", 9),
        ("south", pens[("south", "P02")]),
    ]


def test_derived_per_farm(store):
    assert rows(store.read("health.treatment_regime_steps"), "farm", "day_number") == [
        (f, d) for f in ("north", "south") for d in (0, 2)
    ]
    assert rows(store.read("cattle.ear_tag_assignments").where("active"), "farm", "ear_tag") == [("north", "A001"), ("south", "A001")]
    assert rows(store.read("feed.ration_load_size_entries"), "farm", "truck_number") == [
        (f, n) for f in ("north", "south") for n in (1, 10)
    ]
