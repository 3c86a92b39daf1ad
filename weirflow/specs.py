"""Declared settings for routes, tables, collections and request admission.

These are small driver-side records. Each checks itself when it is made, so a bad
setting fails before any Spark job starts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T


class SpecError(ValueError):
    """A setting that cannot be used."""


def _need(ok: bool, message: str) -> None:
    if not ok:
        raise SpecError(message)


# Declared column type name -> stored Spark type. Unsigned types take
# the next wider signed type; the u64 range needs a 20-digit decimal.
COLUMN_TYPES: dict[str, T.DataType] = {
    "Utf8": T.StringType(),
    "Int8": T.ByteType(),
    "Int16": T.ShortType(),
    "Int32": T.IntegerType(),
    "Int64": T.LongType(),
    "UInt8": T.ShortType(),
    "UInt16": T.IntegerType(),
    "UInt32": T.LongType(),
    "UInt64": T.DecimalType(20, 0),
    "Float32": T.FloatType(),
    "Float64": T.DoubleType(),
    "Boolean": T.BooleanType(),
    "Timestamp": T.TimestampType(),
    "Date32": T.DateType(),
    "Date64": T.DateType(),
    "Binary": T.BinaryType(),
}

# Inclusive range of every integer type.
INT_RANGES: dict[str, tuple[int, int]] = {
    **{f"Int{n}": (-(2 ** (n - 1)), 2 ** (n - 1) - 1) for n in (8, 16, 32, 64)},
    **{f"UInt{n}": (0, 2**n - 1) for n in (8, 16, 32, 64)},
}

# Distance names and whether a higher score is the better one.
DISTANCES: dict[str, bool] = {
    "cosine": True,
    "dot": True,
    "euclid": False,
    "manhattan": False,
}


@dataclass(frozen=True)
class FieldMapping:
    """One JSON path landing in one typed column."""

    json_path: str
    column: str
    data_type: str
    nullable: bool = True

    def __post_init__(self):
        _need(bool(self.column), "column cannot be empty")
        _need(
            self.data_type in COLUMN_TYPES,
            f"Invalid data type '{self.data_type}'. Valid types: {', '.join(COLUMN_TYPES)}",
        )

    @property
    def parts(self) -> list[str]:
        return self.json_path.split(".")

    @property
    def spark_type(self) -> T.DataType:
        return COLUMN_TYPES[self.data_type]


@dataclass(frozen=True)
class Route:
    """Messages of topic (or topic pattern) ``source`` go to ``to``."""

    source: str
    to: str
    qos: int = 1
    partitions: int = 0
    reliable: bool | None = None
    subscription: str = "default"

    def __post_init__(self):
        _need(bool(self.source), "a route needs a source")
        _need(bool(self.to), "a route needs a target")
        _need(bool(self.subscription), "a route needs a subscription name")
        _need(self.qos in (0, 1, 2), f"qos must be 0, 1 or 2, not {self.qos}")
        _need(self.partitions >= 0, "partitions cannot be negative")

    @property
    def effective_reliable(self) -> bool:
        return self.qos != 0 if self.reliable is None else self.reliable


def check_routes(
    routes: Sequence[Route], duplicates: str = "reject"
) -> list[Route]:
    """Routes with a unique ``source``: reject repeats, or keep the first or last."""
    _need(duplicates in ("reject", "first", "last"), f"unknown duplicates mode {duplicates!r}")
    _need(len(routes) > 0, "no routes given")
    kept: dict[str, Route] = {}
    for route in routes:
        if route.source in kept:
            _need(duplicates != "reject", f"source named by two routes: {route.source}")
            if duplicates == "first":
                continue
        kept[route.source] = route
    return list(kept.values())


@dataclass(frozen=True)
class TopicSchema:
    """Which schema subject checks a topic, and which version of it."""

    topic: str
    subject: str
    schema_type: str = "json_schema"
    schema_text: str = ""
    auto_register: bool = True
    version_strategy: str | dict = "latest"

    def __post_init__(self):
        _need(bool(self.topic), "schema topic cannot be empty")
        _need(bool(self.subject), "schema subject cannot be empty")
        _need(
            self.schema_type in ("json_schema", "string", "number", "bytes"),
            f"unknown schema type {self.schema_type!r}",
        )


@dataclass(frozen=True)
class CollectionSpec:
    """A vector collection fed by a topic."""

    name: str
    dimension: int
    distance: str = "cosine"
    auto_create: bool = True
    include_metadata: bool = True

    def __post_init__(self):
        _need(bool(self.name), "collection name cannot be empty")
        _need(self.dimension > 0, "vector dimension must be above zero")
        _need(
            self.distance in DISTANCES,
            f"Invalid distance '{self.distance}'. Valid: {', '.join(DISTANCES)}",
        )


# Rates used where a rate of zero is configured.
DEFAULT_RPS = 100
DEFAULT_BURST = 10


@dataclass(frozen=True)
class RateLimit:
    """Token bucket settings of an endpoint, and of each client address on it."""

    rps: int
    burst: int
    per_ip: bool = False
    per_ip_rps: int | None = None

    def __post_init__(self):
        _need(self.rps >= 0 and self.burst >= 0, "rates cannot be negative")

    @property
    def effective_rps(self) -> int:
        return self.rps or DEFAULT_RPS

    @property
    def effective_burst(self) -> int:
        return self.burst or DEFAULT_BURST

    @property
    def effective_ip_rps(self) -> int:
        return self.per_ip_rps or self.effective_rps


@dataclass(frozen=True)
class Endpoint:
    """A request path whose bodies become messages of topic ``to``."""

    path: str
    to: str
    partitions: int = 0
    reliable: bool = False
    rate_limit: RateLimit | None = None

    def __post_init__(self):
        _need(self.path.startswith("/"), f"Endpoint path must start with '/': {self.path}")
        _need(bool(self.to), f"endpoint {self.path} needs a target")


@dataclass(frozen=True)
class AdmissionSpec:
    """What a request must pass before it becomes a message."""

    endpoints: Sequence[Endpoint]
    auth: str = "none"
    header: str | None = "x-api-key"
    secret: str | None = None
    max_body_size: int = 1024 * 1024
    rate_limit: RateLimit | None = None
    limiter: str = "bucket"
    source_name: str = "requests"
    _by_path: dict = field(init=False, repr=False, compare=False, default=None)

    def __post_init__(self):
        _need(len(self.endpoints) > 0, "At least one endpoint is required")
        _need(bool(self.source_name), "source_name cannot be empty")
        _need(self.auth in ("none", "apikey"), f"unknown auth type {self.auth!r}")
        if self.auth == "apikey":
            _need(bool(self.header), "header is required for API key authentication")
        _need(self.limiter in ("bucket", "window", "off"), f"unknown limiter {self.limiter!r}")
        by_path: dict[str, Endpoint] = {}
        for endpoint in self.endpoints:
            _need(endpoint.path not in by_path, f"Duplicate endpoint path: {endpoint.path}")
            by_path[endpoint.path] = endpoint
        object.__setattr__(self, "_by_path", by_path)

    def limit_for(self, endpoint: Endpoint) -> RateLimit | None:
        """The endpoint's own limit, else the platform-wide one."""
        return endpoint.rate_limit or self.rate_limit


# Settings each storage backend cannot do without.
_STORAGE_NEEDS = {
    "s3": ("region",),
    "azure": ("account", "container"),
    "gcs": ("project",),
}


def check_storage(backend: str, options: dict) -> None:
    _need(backend in _STORAGE_NEEDS, f"unknown storage backend {backend!r}")
    for name in _STORAGE_NEEDS[backend]:
        _need(bool(options.get(name)), f"{name} is required for storage backend '{backend}'")
