"""Configuration objects: forms accepted, overlays, round trips."""

import json

import pytest

from ferryline import (
    Format, HookMap, Mode, Pipeline, Replication, ReplicationStream, SourceOptions, TargetOptions)
from ferryline.config import as_list, as_mapping
from ferryline.plans.replication import object_name, stream_names
from ferryline.plans.steps import (
    StepCheck, StepCommand, StepCopy, StepGroup, StepHTTP, StepLog, StepQuery, StepRead,
    StepReplication, StepStore, loop_values, step_from, steps_to_dict)


def config():
    return {
        "source": "PG", "target": "LAKE",
        "defaults": {"mode": "full-refresh", "object": "new.{stream_schema}_{stream_table}",
                     "target_options": {"column_casing": "snake", "file_max_rows": 10}},
        "streams": {
            "main.users": {"mode": Mode.INCREMENTAL, "primary_key": "id, day",
                           "target_options": {"file_max_rows": 99}},
            "main.orders": {"disabled": True},
            "main.items": {"id": "items", "tags": ["x"]},
        },
        "env": {"A": "1"},
    }


def test_defaults_are_overlaid_key_by_key():
    plan = Replication(**config()).planned()
    assert list(plan) == ["main.users", "main.items"]
    assert plan["main.users"].mode is Mode.INCREMENTAL
    assert plan["main.items"].mode == "full-refresh"
    options = plan["main.users"].target_options
    assert (options.column_casing, options.file_max_rows) == ("snake", 99)


def test_enable_disable_add_and_default_mode():
    run = Replication(**config())
    run.enable_streams(["main.orders", "unknown"])
    run.disable_streams(["main.users"])
    run.add_streams({"main.extra": {"mode": "snapshot"}})
    run.set_default_mode(Mode.TRUNCATE)
    plan = run.planned()
    assert list(plan) == ["main.orders", "main.items", "main.extra"]
    assert plan["main.orders"].mode is Mode.TRUNCATE
    assert list(run.planned(streams="main.extra")) == ["main.extra"]
    assert list(run.planned(streams=["items"])) == ["main.items"]
    assert list(run.planned(tags=["x"])) == ["main.items"]


def test_nothing_is_shared_between_instances():
    given = config()
    first, second = Replication(**given), Replication(**given)
    first.add_streams({"more": {}})
    first.streams["main.users"].disable()
    first.env["B"] = "2"
    assert "more" not in second.streams and second.streams["main.users"].disabled is None
    assert given["env"] == {"A": "1"} and "more" not in given["streams"]
    assert Replication().streams == {} and Replication().streams is not Replication().streams


def test_json_form():
    document = json.loads(Replication(**config()).to_json())
    assert document["streams"]["main.users"]["mode"] == "incremental"
    assert document["defaults"]["target_options"] == {"column_casing": "snake",
                                                      "file_max_rows": 10}
    assert Replication(**document).to_dict() == document


def test_file_forms(tmp_path):
    path = tmp_path / "run.yaml"
    path.write_text("source: A\ntarget: B\ndefaults: {mode: snapshot}\n"
                    "streams:\n  s.t: {object: x}\nenv: {K: v}\n")
    run = Replication(file_path=str(path), env={"L": "w"})
    assert run.planned()["s.t"].mode == "snapshot" and run.env == {"K": "v", "L": "w"}
    steps = tmp_path / "steps.yaml"
    steps.write_text("steps:\n- {type: log, message: hi}\nenv: {K: v}\n")
    assert Pipeline(file_path=str(steps)).to_dict() == {
        "steps": [{"type": "log", "message": "hi"}], "env": {"K": "v"}}
    with pytest.raises(ValueError, match="mapping"):
        bad = tmp_path / "bad.yaml"
        bad.write_text("- 1\n")
        Replication(file_path=str(bad))


def test_unknown_keys_are_errors():
    with pytest.raises(ValueError, match="unknown keys"):
        ReplicationStream.from_dict({"modee": "x"})
    with pytest.raises(ValueError, match="unknown keys"):
        TargetOptions.from_dict({"headerr": True})


def test_option_documents():
    assert SourceOptions(format=Format.CSV, limit=3).to_dict() == {"format": "csv", "limit": 3}
    assert as_list("a, b ,c") == ["a", "b", "c"] and as_list(None) == []
    assert as_mapping('{"a": "int"}') == as_mapping("a: int") == {"a": "int"}


def test_steps_round_trip_with_reserved_words():
    steps = [
        StepRead(from_="/in.txt", into="text"),
        StepCopy("/a", "/b", recursive=True),
        StepCommand(["ls"], print_output=True, working_dir="/tmp"),
        StepReplication("r.yaml", range_param="2023-01-01..2023-12-31", mode=Mode.BACKFILL),
        StepCheck("n > 0", failure_message="none", vars={"table": "t"}, on_failure="warn"),
        StepQuery("PG", "select 1", into="one", id="q", if_condition="env.A == '1'"),
        StepGroup([StepLog("one"), {"type": "log", "message": "two"}], loop={"range": "1..3"}),
        StepHTTP("https://example.com", method="POST"), StepStore("k", "v"),
    ]
    documents = steps_to_dict(steps)
    assert documents[0] == {"type": "read", "from": "/in.txt", "into": "text"}
    assert documents[1] == {"type": "copy", "from": "/a", "to": "/b", "recursive": True}
    assert documents[2]["print"] is True
    assert documents[3]["range"] == "2023-01-01..2023-12-31" and documents[3]["mode"] == "backfill"
    assert documents[5]["if"] == "env.A == '1'"
    assert [s["message"] for s in documents[6]["steps"]] == ["one", "two"]
    assert [type(step_from(d)) for d in documents] == [type(s) for s in steps]
    assert steps_to_dict(documents) == documents
    with pytest.raises(ValueError, match="unknown step"):
        step_from({"type": "nope"})
    with pytest.raises(ValueError, match="from"):
        StepCopy(None, "/b")


def test_hook_map():
    hooks = HookMap.from_dict({"pre": [{"type": "log", "message": "a"}]})
    assert hooks.to_dict() == {"pre": [{"type": "log", "message": "a"}]}
    assert HookMap().to_dict() == {}


def test_loops_and_templates():
    assert loop_values({"range": "1..3"}) == [1, 2, 3]
    assert loop_values("a, b") == ["a", "b"] and loop_values(None) == [None]
    assert object_name("new.{stream_schema}_{stream_table}", "main.users") == "new.main_users"
    assert stream_names("file:///data/in/users.csv.gz")["stream_table"] == "users"
    assert stream_names("orders.csv")["stream_table"] == "orders"
    with pytest.raises(ValueError, match="unknown name"):
        object_name("{stream_color}", "a.b")
