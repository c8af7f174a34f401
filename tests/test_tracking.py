import pytest

from isoreach.plans.tracking import Ledger, Steps, Tracked, source_hash, table_version

CODE = "def f(x):\n    return x + 1\n"


def test_a_hash_follows_what_a_program_does():
    assert source_hash(CODE) == source_hash('# note\ndef f(x):\n    """Adds one."""\n\n    return (x + 1)  # sum\n')
    assert source_hash(CODE) != source_hash(CODE.replace("1", "2"))


def test_stale_steps_and_what_follows_from_them(tmp_path):
    raw, mid, out = (str(tmp_path / n) for n in ("raw", "mid", "out"))
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/part-0").write_text("a")
    ledger, code = Ledger.load(tmp_path / "ledger.json"), {"first": CODE, "second": CODE + "y = 2\n"}
    assert ledger.all_stale(code) == {"first": ["never run"], "second": ["never run"]}
    for name, used, made in (("first", raw, mid), ("second", mid, out)):
        with ledger.step(name, code[name], [used], [made]):
            (tmp_path / made).write_text(name)
    again = Ledger.load(tmp_path / "ledger.json")
    assert again.all_stale(code) == {} and again.records["first"].seconds >= 0
    assert again.all_stale(code | {"first": CODE + "z = 1"}) == {"first": ["source changed"], "second": [f"made by a stale step: {mid}"]}
    (tmp_path / "raw/part-1").write_text("b")
    assert again.stale("first", CODE) == [f"input changed: {raw}"]
    (tmp_path / "out").unlink()
    assert again.stale("second", code["second"]) == [f"output missing: {out}"] and table_version(out) == "missing"
    with pytest.raises(ZeroDivisionError), again.step("second", "x = 0", [], []):
        1 / 0
    assert again.records["second"].used == {mid: again.records["second"].used[mid]}


def test_fields_that_are_read_are_known():
    scenario = Tracked({"area": {"name": "north", "buffer": 5}, "modes": ["car"], "seed": 1})
    assert scenario.area.name == "north" and scenario["modes"] == ["car"]
    assert scenario.used == {"area", "area.name", "modes"} and scenario.unused() == {"seed"}


def test_steps_are_numbered_and_timed():
    told = []
    steps = Steps(told.append)
    with steps.step("load"), steps.step("cells") as inner:
        assert inner == "1.1"
    with steps.step("join"):
        pass
    assert told == ["1 load", "1.1 cells", "2 join"] and [n for n, *_ in steps.took] == ["1.1", "1", "2"]
