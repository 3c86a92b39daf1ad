"""weirflow: JSON message routing, shaping, storing and searching on Spark."""

from weirflow.session import configure, new_session
from weirflow.specs import (
    AdmissionSpec,
    CollectionSpec,
    Endpoint,
    FieldMapping,
    RateLimit,
    Route,
    SpecError,
    TopicSchema,
)

__all__ = [
    "AdmissionSpec",
    "CollectionSpec",
    "Endpoint",
    "FieldMapping",
    "RateLimit",
    "Route",
    "SpecError",
    "TopicSchema",
    "configure",
    "new_session",
]
