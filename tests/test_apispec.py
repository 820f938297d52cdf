"""API specifications: documents, checks, effective endpoints, order."""

import json

import pytest
import yaml

from ferryline.plans.apispec import (
    AggregationType, ApiSpec, BackoffType, Call, DynamicEndpoint, Endpoint, Iterate, Pagination,
    Processor, Records, Request, Response, ResponseFormat, Rule, RuleAction, endpoint_stream)

DOCUMENT = """
name: Shop
queues: [user_ids]
defaults:
  state: {base_url: "https://shop.example", limit: 50}
  request: {timeout: 30, headers: {Accept: application/json}}
  response:
    records: {jmespath: "data[]", primary_key: [id]}
    rules:
    - {action: retry, condition: response.status == 429, backoff: exponential, backoff_base: 2}
    processors:
    - {expression: record.id, output: record.copy}
  setup:
  - {if: state.check, request: {url: "{state.base_url}/health"}}
endpoints:
  users:
    state: {offset: 0}
    request: {url: "{state.base_url}/users", method: GET}
    response:
      processors:
      - {expression: record.id, output: queue.user_ids, if: record.active}
  orders:
    depends_on: [users]
    iterate: {over: queue.user_ids, into: state.user_id, concurrency: 5}
    sync: [last]
    response:
      +rules: [{action: skip, condition: response.status == 404}]
      rules+: [{action: fail, condition: response.status == 500}]
      processors+:
      - {expression: record.at, output: state.last, aggregation: maximum}
    setup+: [{request: {url: /after}}]
  old: {disabled: true, request: {url: /old}}
dynamic_endpoints:
- iterate: state.tables
  into: state.table
  endpoint:
    name: "{state.table}"
    +teardown: [{request: {url: /bye}}]
    response: {format: csv, +processors: [{expression: a, output: record.b}]}
"""


def test_round_trip_is_identity(tmp_path):
    spec = ApiSpec.parse(DOCUMENT)
    assert spec.to_dict() == yaml.safe_load(DOCUMENT)
    assert ApiSpec.parse(spec.to_yaml()).to_dict() == spec.to_dict()
    assert json.loads(spec.to_json()) == spec.to_dict()
    path = tmp_path / "spec.yaml"
    spec.to_yaml_file(str(path))
    assert ApiSpec.parse_file(str(path)) == spec
    assert spec.validate() == []
    with pytest.raises(ValueError, match="mapping"):
        ApiSpec.parse("- a\n")


def test_parts_are_typed():
    spec = ApiSpec.parse(DOCUMENT)
    assert isinstance(spec.defaults.response.records, Records)
    assert isinstance(spec.defaults.setup[0], Call) and spec.defaults.setup[0].if_condition
    assert isinstance(spec.endpoints["orders"].iterate, Iterate)
    assert isinstance(spec.endpoints["orders"].response.prepend_rules[0], Rule)
    assert isinstance(spec.dynamic_endpoints[0], DynamicEndpoint)
    assert isinstance(spec.dynamic_endpoints[0].endpoint.response.prepend_processors[0], Processor)


def test_enums_become_text():
    response = Response(format=ResponseFormat.CSV, rules=[
        Rule(RuleAction.RETRY, "c", backoff=BackoffType.LINEAR)],
        processors=[Processor("a", "state.b", AggregationType.LAST)])
    assert response.to_dict() == {
        "format": "csv", "processors": [{"expression": "a", "output": "state.b",
                                         "aggregation": "last"}],
        "rules": [{"action": "retry", "condition": "c", "backoff": "linear"}]}


def test_effective_endpoint():
    orders = ApiSpec.parse(DOCUMENT).effective("orders")
    assert [r.action for r in orders.response.rules] == ["skip", "retry", "fail"]
    assert [p.output for p in orders.response.processors] == ["record.copy", "state.last"]
    assert orders.response.records.jmespath == "data[]"
    assert [c.request.url for c in orders.setup] == ["{state.base_url}/health", "/after"]
    users = ApiSpec.parse(DOCUMENT).effective("users")
    assert users.state == {"base_url": "https://shop.example", "limit": 50, "offset": 0}
    assert users.request.timeout == 30 and users.request.method == "GET"
    assert [p.output for p in users.response.processors] == ["queue.user_ids"]


def test_run_order_follows_queues_and_dependencies():
    spec = ApiSpec.parse(DOCUMENT)
    assert spec.run_order() == ["users", "orders"]
    spec.endpoints["users"].depends_on = ["orders"]
    with pytest.raises(ValueError, match="depend on each other"):
        spec.run_order()


@pytest.mark.parametrize("change, message", [
    ({"name": None}, "has no name"),
    ({"endpoints": None, "dynamic_endpoints": None}, "nothing to extract"),
    ({"defaults": Endpoint(response=Response(records=Records("a[]", ".a[]")))},
     "defaults.response.records: choose"),
    ({"endpoints": {"e": Endpoint(response=Response(records=Records("a[]", ".a[]")))}},
     "endpoints.e.response.records: choose"),
    ({"endpoints": {"e": Endpoint(iterate="queue.none")}},
     "endpoints.e.iterate: queue.none is missing"),
    ({"endpoints": {"e": Endpoint(iterate=Iterate("queue.none"))}}, "endpoints.e.iterate.over"),
    ({"endpoints": {"e": Endpoint(response=Response(append_processors=[
        Processor("a", "queue.none")]))}}, "endpoints.e.processors[0].output"),
    ({"endpoints": {"e": Endpoint(sync=["k"])}}, "endpoints.e.sync: state.k"),
])
def test_checks(change, message):
    spec = ApiSpec.parse(DOCUMENT)
    for name, value in change.items():
        setattr(spec, name, value)
    assert len(spec.validate()) == 1 and message in spec.validate()[0]


def test_queue_names_are_free_when_none_are_declared():
    spec = ApiSpec(name="x", endpoints={"e": Endpoint(iterate="queue.any")})
    assert spec.validate() == []


def test_plain_construction():
    endpoint = Endpoint(request=Request(url="/a"), pagination=Pagination({"o": 1}, "true"))
    assert endpoint.to_dict() == {"request": {"url": "/a"},
                                  "pagination": {"next_state": {"o": 1}, "stop_condition": "true"}}


def test_overrides_shape_the_load():
    spec = ApiSpec.parse(DOCUMENT)
    spec.endpoints["orders"].overrides = {"mode": "snapshot", "label": "ignored"}
    stream = endpoint_stream(spec.effective("orders"))
    assert (stream.mode, stream.primary_key, stream.id) == ("snapshot", ["id"], "orders")
    spec.endpoints["orders"].overrides = None
    assert endpoint_stream(spec.effective("orders")).mode == "incremental"
