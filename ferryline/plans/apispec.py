"""API extract specifications: the document model, its checks and round trip."""

from __future__ import annotations

import copy
import json
from dataclasses import dataclass, fields
from enum import Enum
from typing import Any

import yaml

from ..config import Config, ReplicationStream

# -- names accepted in documents (fixed values) ----------------------------------


class AuthType(str, Enum):
    NONE = ""
    STATIC = "static"
    SEQUENCE = "sequence"
    BASIC = "basic"
    OAUTH2 = "oauth2"
    AWS_SIGV4 = "aws-sigv4"
    HMAC = "hmac"
    MTLS = "mtls"


class OAuthFlow(str, Enum):
    CLIENT_CREDENTIALS = "client_credentials"
    AUTHORIZATION_CODE = "authorization_code"
    DEVICE_CODE = "device_code"


class HTTPMethod(str, Enum):
    GET = "GET"
    HEAD = "HEAD"
    POST = "POST"
    PUT = "PUT"
    PATCH = "PATCH"
    DELETE = "DELETE"
    CONNECT = "CONNECT"
    OPTIONS = "OPTIONS"
    TRACE = "TRACE"


class AggregationType(str, Enum):
    NONE = ""
    MAXIMUM = "maximum"
    MINIMUM = "minimum"
    COLLECT = "collect"
    FIRST = "first"
    LAST = "last"


class RuleAction(str, Enum):
    RETRY = "retry"
    CONTINUE = "continue"
    STOP = "stop"
    BREAK = "break"
    SKIP = "skip"
    FAIL = "fail"


class BackoffType(str, Enum):
    NONE = ""
    CONSTANT = "constant"
    LINEAR = "linear"
    EXPONENTIAL = "exponential"
    JITTER = "jitter"


class ResponseFormat(str, Enum):
    NONE = ""
    CSV = "csv"
    JSON = "json"
    JSONLINES = "jsonlines"
    PARQUET = "parquet"
    AVRO = "avro"
    XML = "xml"
    EXCEL = "excel"
    SAS = "sas"
    TEXT = "text"


# -- parts of a document -----------------------------------------------------------


class Part(Config):
    """A part of the document. ``nested`` names the attributes holding one part,
    a list of parts or a mapping of parts; they are converted on construction."""

    nested: dict[str, Any] = {}

    def __post_init__(self):
        for name, kind in self.nested.items():
            setattr(self, name, _typed(getattr(self, name), kind))


def _typed(value, kind):
    if isinstance(value, dict):
        return kind.from_dict(value)
    if isinstance(value, list):
        return [_typed(v, kind) for v in value]
    return value


@dataclass
class Request(Part):
    url: str | None = None
    timeout: Any = None
    method: Any = None
    headers: dict | None = None
    parameters: dict | None = None
    payload: Any = None
    rate: Any = None
    concurrency: int | None = None


@dataclass
class Pagination(Part):
    next_state: dict | None = None
    stop_condition: str | None = None


@dataclass
class Records(Part):
    jmespath: str | None = None
    jq: str | None = None
    primary_key: Any = None
    update_key: str | None = None
    limit: int | None = None
    casing: str | None = None
    select: list | None = None
    duplicate_tolerance: str | None = None


@dataclass
class Processor(Part):
    document_keys = {"if_condition": "if"}

    expression: str | None = None
    output: str | None = None
    aggregation: Any = None
    if_condition: str | None = None


@dataclass
class Rule(Part):
    action: Any = None
    condition: str | None = None
    max_attempts: int | None = None
    backoff: Any = None
    backoff_base: Any = None
    message: str | None = None


@dataclass
class Iterate(Part):
    over: Any = None
    into: str | None = None
    concurrency: int | None = None


@dataclass
class Response(Part):
    document_keys = {
        "prepend_rules": "+rules",
        "append_rules": "rules+",
        "prepend_processors": "+processors",
        "append_processors": "processors+",
    }
    nested = {"records": Records, "processors": Processor, "rules": Rule,
              "prepend_rules": Rule, "append_rules": Rule,
              "prepend_processors": Processor, "append_processors": Processor}

    format: Any = None
    records: Any = None
    processors: list | None = None
    rules: list | None = None
    prepend_rules: list | None = None
    append_rules: list | None = None
    prepend_processors: list | None = None
    append_processors: list | None = None


@dataclass
class Call(Part):
    document_keys = {"if_condition": "if"}
    nested = {"request": Request, "pagination": Pagination, "response": Response}

    if_condition: str | None = None
    request: Any = None
    pagination: Any = None
    response: Any = None
    authentication: dict | None = None
    iterate: Any = None
    into: str | None = None


@dataclass
class Endpoint(Part):
    document_keys = {
        "prepend_setup": "+setup",
        "append_setup": "setup+",
        "prepend_teardown": "+teardown",
        "append_teardown": "teardown+",
    }
    nested = {"request": Request, "pagination": Pagination, "response": Response,
              "iterate": Iterate, "setup": Call, "teardown": Call, "prepend_setup": Call,
              "append_setup": Call, "prepend_teardown": Call, "append_teardown": Call}

    name: str | None = None
    description: str | None = None
    docs: str | None = None
    disabled: bool | None = None
    state: dict | None = None
    sync: list | None = None
    request: Any = None
    pagination: Any = None
    response: Any = None
    iterate: Any = None
    setup: list | None = None
    teardown: list | None = None
    depends_on: list | None = None
    overrides: dict | None = None
    authentication: dict | None = None
    prepend_setup: list | None = None
    append_setup: list | None = None
    prepend_teardown: list | None = None
    append_teardown: list | None = None


@dataclass
class DynamicEndpoint(Part):
    nested = {"setup": Call, "endpoint": Endpoint}

    setup: list | None = None
    iterate: str | None = None
    into: str | None = None
    endpoint: Any = None


@dataclass
class ApiSpec(Part):
    nested = {"defaults": Endpoint, "dynamic_endpoints": DynamicEndpoint}

    name: str | None = None
    description: str | None = None
    queues: list | None = None
    authentication: dict | None = None
    defaults: Any = None
    endpoints: dict | None = None
    dynamic_endpoints: list | None = None

    def __post_init__(self):
        super().__post_init__()
        if self.endpoints is not None:
            self.endpoints = {n: _typed(e, Endpoint) for n, e in self.endpoints.items()}

    # -- documents -------------------------------------------------------------

    def to_yaml(self) -> str:
        return yaml.safe_dump(self.to_dict(), sort_keys=False, allow_unicode=True)

    def to_json(self) -> str:
        return json.dumps(self.to_dict(), indent=2)

    def to_yaml_file(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as handle:
            handle.write(self.to_yaml())

    @classmethod
    def parse(cls, text: str) -> "ApiSpec":
        document = yaml.safe_load(text)
        if not isinstance(document, dict):
            raise ValueError("the document must be a mapping at its top level")
        return cls.from_dict(document)

    @classmethod
    def parse_file(cls, path: str) -> "ApiSpec":
        with open(path, encoding="utf-8") as handle:
            return cls.parse(handle.read())

    # -- planning --------------------------------------------------------------

    def effective(self, name: str) -> Endpoint:
        """An endpoint with the defaults below it and its list modifiers applied."""
        own = self.endpoints[name]
        merged = self.defaults.overlay(own) if self.defaults else copy.deepcopy(own)
        if isinstance(merged.state, dict) and self.defaults and self.defaults.state:
            merged.state = {**self.defaults.state, **(own.state or {})}
        base = self.defaults.response if self.defaults else None
        if merged.response is not None:
            for kind in ("rules", "processors"):
                setattr(merged.response, kind,
                        modified_list(base, own.response, kind))
                setattr(merged.response, f"prepend_{kind}", None)
                setattr(merged.response, f"append_{kind}", None)
        for kind in ("setup", "teardown"):
            before, after = getattr(own, f"prepend_{kind}"), getattr(own, f"append_{kind}")
            if before or after:
                setattr(merged, kind, (before or []) + (getattr(merged, kind) or [])
                        + (after or []))
                setattr(merged, f"prepend_{kind}", None)
                setattr(merged, f"append_{kind}", None)
        merged.name = merged.name or name
        return merged

    def run_order(self) -> list[str]:
        """Enabled endpoints, each after those it depends on: ``depends_on``, and
        the producers of the queue it iterates over."""
        active = {n: self.effective(n) for n, e in (self.endpoints or {}).items()
                  if not e.disabled}
        producers: dict[str, set] = {}
        for n, e in active.items():
            for p in (e.response.processors if e.response else None) or []:
                if (p.output or "").startswith("queue."):
                    producers.setdefault(p.output, set()).add(n)
        waits = {}
        for n, e in active.items():
            over = e.iterate.over if isinstance(e.iterate, Iterate) else e.iterate
            needs = set(e.depends_on or []) & set(active)
            if isinstance(over, str):
                needs |= producers.get(over, set())
            waits[n] = needs - {n}
        order: list[str] = []
        while waits:
            ready = [n for n, needs in waits.items() if needs <= set(order)]
            if not ready:
                raise ValueError(f"endpoints depend on each other: {sorted(waits)}")
            order += ready
            for n in ready:
                del waits[n]
        return order

    # -- checks ----------------------------------------------------------------

    def validate(self) -> list[str]:
        """Messages for everything wrong with the document; empty when it is valid."""
        problems = []
        if not self.name:
            problems.append("the specification has no name")
        if not self.endpoints and not self.dynamic_endpoints:
            problems.append("nothing to extract: no endpoints and no dynamic_endpoints")
        places = [("defaults", self.defaults)]
        places += [(f"endpoints.{n}", e) for n, e in (self.endpoints or {}).items()]
        for place, endpoint in places:
            records = getattr(getattr(endpoint, "response", None), "records", None)
            if records and records.jmespath is not None and records.jq is not None:
                problems.append(f"{place}.response.records: choose jmespath or jq, not both")
        for place, endpoint in places[1:]:
            problems += self._queue_problems(place, endpoint)
        for place, endpoint in places[1:]:
            written = {p.output for _, p in _processors(endpoint) if p.output}
            problems += [
                f"{place}.sync: state.{key} is kept but no processor sets it"
                for key in endpoint.sync or [] if f"state.{key}" not in written]
        return problems

    def _queue_problems(self, place: str, endpoint: Endpoint) -> list[str]:
        over = endpoint.iterate.over if isinstance(endpoint.iterate, Iterate) else endpoint.iterate
        suffix = ".over" if isinstance(endpoint.iterate, Iterate) else ""
        used = [(p.output, f"{place}.processors[{i}].output") for i, p in _processors(endpoint)]
        used.append((over, f"{place}.iterate{suffix}"))
        declared = set(self.queues or [])
        return [
            f"{where}: {ref} is missing from the queues of the specification"
            for ref, where in used
            if declared and isinstance(ref, str) and ref.startswith("queue.")
            and ref.removeprefix("queue.") not in declared]


def _processors(endpoint: Endpoint):
    response = endpoint.response
    if response is None:
        return
    for group in (response.processors, response.append_processors, response.prepend_processors):
        yield from enumerate(group or [])


def modified_list(base: Response | None, own: Response | None, kind: str) -> list | None:
    """``+rules`` go before the inherited list, ``rules+`` after it."""
    inherited = getattr(own, kind, None) if own is not None else None
    if inherited is None and base is not None:
        inherited = getattr(base, kind)
    before = (getattr(own, f"prepend_{kind}", None) if own is not None else None) or []
    after = (getattr(own, f"append_{kind}", None) if own is not None else None) or []
    if not before and not after:
        return inherited
    return copy.deepcopy(before + (inherited or []) + after)


def endpoint_stream(endpoint: Endpoint) -> ReplicationStream:
    """How an endpoint's records are loaded: its keys, then its ``overrides``.
    Endpoints with a sync state load incrementally."""
    records = (endpoint.response.records if endpoint.response else None) or Records()
    stream = ReplicationStream(
        id=endpoint.name, description=endpoint.description, primary_key=records.primary_key,
        update_key=records.update_key, disabled=endpoint.disabled,
        mode="incremental" if endpoint.sync else None)
    known = {f.name for f in fields(ReplicationStream)}
    return stream.overlay(ReplicationStream.from_dict(
        {k: v for k, v in (endpoint.overrides or {}).items() if k in known}))
