"""What a load gets to see of a landing folder that changes."""

import os

import pytest

from wardflow.sources import landings


def _put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as file:
        file.write(text)


def _changes(landing):
    return {os.path.basename(r.path): r.change for r in landing.changes.collect()}


def _read(spark, landing, at_once=2):
    parts = list(landings.landed_since(landing, spark.read.text, at_once))
    return len(parts), sorted(r.value for part in parts for r in part.collect())


def test_three_landings(spark, tmp_path):
    folder, state = f"{tmp_path}/in", f"{tmp_path}/state"
    for name in ("a.txt", "b.txt", "c [x] {1}.txt"):
        _put(folder, name, name)
    first = landings.landing_changes(spark, folder, state)
    assert _changes(first) == {"a.txt": "new", "b.txt": "new", "c [x] {1}.txt": "new"}
    assert _read(spark, first) == (2, ["a.txt", "b.txt", "c [x] {1}.txt"])
    # Not committed, as if the load had failed: all of it comes again, with what landed since.
    _put(folder, "d.txt", "d.txt")
    again = landings.landing_changes(spark, folder, state)
    assert set(_changes(again).values()) == {"new"} and len(_changes(again)) == 4
    landings.commit_landing(again)

    os.remove(f"{folder}/a.txt")
    _put(folder, "b.txt", "b.txt and more")
    _put(f"{folder}/deeper", "e.txt", "e.txt")
    second = landings.landing_changes(spark, folder, state)
    assert _changes(second) == {"a.txt": "vanished", "b.txt": "changed", "e.txt": "new"}
    assert _read(spark, second) == (1, ["b.txt and more", "e.txt"])
    landings.commit_landing(second)

    # The same length at another time.
    os.utime(f"{folder}/d.txt", (1_000_000_000, 1_000_000_000))
    _put(folder, "a.txt", "back")
    third = landings.landing_changes(spark, folder, state)
    assert _changes(third) == {"d.txt": "changed", "a.txt": "new"}
    landings.commit_landing(third)
    last = landings.landing_changes(spark, folder, state)
    assert _changes(last) == {} and _read(spark, last) == (0, [])


def test_a_load_that_dies_is_made_again(spark, tmp_path):
    folder, state = f"{tmp_path}/in", f"{tmp_path}/state"
    _put(folder, "a.txt", "a")
    landing = landings.landing_changes(spark, folder, state)

    def dying(paths):
        raise OSError("lost")

    with pytest.raises(OSError):
        list(landings.landed_since(landing, dying))
    assert _read(spark, landings.landing_changes(spark, folder, state)) == (1, ["a"])


def test_an_emptied_folder(spark, tmp_path):
    folder, state = f"{tmp_path}/in", f"{tmp_path}/state"
    _put(folder, "a.txt", "a")
    landings.commit_landing(landings.landing_changes(spark, folder, state))
    os.remove(f"{folder}/a.txt")
    assert _changes(landings.landing_changes(spark, folder, state)) == {"a.txt": "vanished"}
