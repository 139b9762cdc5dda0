"""All registered queries; importing the modules below fills the registry."""

from palisade.catalog import (  # noqa: F401
    behaviour,
    detection,
    ingestion,
    monitoring,
    preparation,
    profiles,
    scalars,
    streams,
)
from palisade.catalog.registry import ORACLES, QUERIES  # noqa: F401
